"""The given star-schema tables read as trip, weather and zone inputs.

Trips are order lines with their order, customer and supplier; weather is orders per day; zones are
nations with their region.  Whole tables are used.  Faults are added so that the operators have
something to do: some amounts and codes are null, one order in 97 appears twice, weather of every
29th has no readable date, and one zone has no readable id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.sources.readers import with_source_file
from tripmart.sources.scope import Scope

# Wider than the given tables (1995-2001): as a scope should, it removes only impossible dates.
DEFAULT_SCOPE = Scope.of("1990-01-01", "2009-12-31")
# For the queries that show what a scope leaves out.
NARROW_SCOPE = Scope.of("1997-01-01", "1999-12-31")
# Money is rounded in whole cents and percents, so that the result does not hang on binary fractions.
_CENTS = "CAST(round(l_extendedprice * 100) AS bigint)"
_TAX = "CAST(round(l_tax * 100) AS bigint)"
_DISCOUNT = "CAST(round(l_discount * 100) AS bigint)"

TRIP_VALUES = {
    "vendorid": "l_suppkey % 2 + 1",
    "tpep_pickup_datetime": "o_orderdate",
    "tpep_dropoff_datetime": "l_shipdate",
    "passenger_count": "CASE WHEN l_partkey % 40 <> 0 THEN l_linenumber END",
    "trip_distance": "l_quantity",
    "ratecodeid": "l_orderkey % 6 + 1",
    "store_and_fwd_flag": "concat(' ', l_linestatus, ' ')",
    "pulocationid": "c_nationkey",
    "dolocationid": "s_nationkey",
    "payment_type": "CASE WHEN l_orderkey % 50 <> 0 THEN (l_linenumber + l_partkey) % 9 - 1 END",
    "fare_amount": "l_extendedprice",
    "extra": "l_discount * 10",
    "mta_tax": "CASE WHEN l_partkey % 20 <> 0 THEN 0.5 END",
    "tip_amount": f"(({_CENTS} * {_TAX} + 50) div 100) / 100",
    "tolls_amount": "CASE WHEN l_tax <> 0 THEN round(l_tax * 10, 2) END",
    "improvement_surcharge": "1.0",
    "total_amount": "CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_extendedprice ELSE"
    f" (({_CENTS} * (100 - {_DISCOUNT}) * (100 + {_TAX}) + 5000) div 10000) / 100 END",
    "congestion_surcharge": "CASE WHEN l_suppkey % 3 <> 0 THEN 2.5 END",
    "airport_fee": "NULL",
}

SUPPLIERS_BOUND = 1_000_000  # sent to every executor, a key and a nation each

INPUTS = ["lineitem", "orders", "customer", "supplier", "nation", "region"]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trips_raw(
    spark: SparkSession,
    folder: str,
    lineage: bool = True,
    early: Sequence[str] = (),
    few_suppliers: bool = False,
) -> DataFrame:
    """Typed raw trips with ``source_file`` (null, and never read, without ``lineage``).

    Customers join orders before lines come in, so the wide line rows move once, on the order key.
    ``early`` names values made of line columns only: they are worked out before the lines move, which
    spares readers of few columns what the values are made of.  ``few_suppliers`` counts the suppliers
    by their footers: up to ``SUPPLIERS_BOUND`` are broadcast, so that trips do not move on their key too.
    """
    c = F.col
    lines = read(spark, folder, "lineitem")
    if lineage:
        lines = with_source_file(lines)
    else:
        lines = lines.withColumn("source_file", F.lit(None).cast("string"))
    values = {f.name: f"CAST({TRIP_VALUES[f.name]} AS {f.type})" for f in S.TRIPS_RAW}
    for name in early:
        lines = lines.withColumn(f"_{name}", F.expr(values[name]))
        values[name] = f"_{name}"
    orders = read(spark, folder, "orders").join(
        read(spark, folder, "customer"), c("o_custkey") == c("c_custkey")
    )
    suppliers = read(spark, folder, "supplier")
    if few_suppliers and suppliers.count() <= SUPPLIERS_BOUND:
        suppliers = F.broadcast(suppliers)
    rows = lines.join(orders, c("l_orderkey") == c("o_orderkey")).join(
        suppliers, c("l_suppkey") == c("s_suppkey")
    )
    return rows.selectExpr(
        *[f"{value} AS {name}" for name, value in values.items()],
        "source_file",
        "explode(array_repeat(1, CASE WHEN l_orderkey % 97 = 0 THEN 2 ELSE 1 END)) AS _copy",
    ).drop("_copy")


def as_text(df: DataFrame, names: list[str]) -> DataFrame:
    """The same rows as a text file would hold them: the named fields as strings."""
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def trips_text(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(trips_raw(spark, folder), S.TRIPS_RAW.names)


def weather_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Daily weather.  The mean is taken over whole cents, so it is exact."""
    day = F.to_date("o_orderdate")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    daily = (
        read(spark, folder, "orders")
        .groupBy(F.when(F.dayofmonth(day) != 29, day).alias("date"))
        .agg(
            (F.max("o_totalprice") / 10000).alias("temperature_2m_max"),
            (F.min("o_totalprice") / 10000).alias("temperature_2m_min"),
            (F.sum(cents) / (F.count("*") * F.lit(1e6))).alias("temperature_2m_mean"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT")
            .cast("double")
            .alias("precipitation_sum"),
            F.count_if(F.col("o_orderstatus") == "P").cast("double").alias("snowfall_sum"),
        )
    )
    return daily.withColumn("source_file", F.lit(f"{folder}/orders.parquet"))


def weather_text(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(weather_raw(spark, folder), S.WEATHER_RAW.names)


def zones_raw(spark: SparkSession, folder: str) -> DataFrame:
    c = F.col
    nations = with_source_file(read(spark, folder, "nation"))
    return nations.join(
        read(spark, folder, "region"), c("n_regionkey") == c("r_regionkey")
    ).select(
        F.when(c("n_nationkey") != 24, c("n_nationkey")).cast("string").alias("LocationID"),
        c("r_name").alias("Borough"),
        F.concat(F.lit(" "), c("n_name"), F.lit(" ")).alias("Zone"),
        F.when(c("n_regionkey") < 2, "Yellow Zone").otherwise("Boro Zone").alias("service_zone"),
        "source_file",
    )
