"""The registered queries: every operator and report over the given tables.

``(spark, folder) -> DataFrame``.  Layer queries are one plan from the inputs.  Reports over several
layers read the stored layer tables.  Load times and file paths are left out and floating sums
rounded, so results can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import bindings, schemas as S
from tripmart.functions import keys, parsing
from tripmart.functions.calendar import calendar_attributes, minutes_between
from tripmart.operators import aggregates as A
from tripmart.operators import columns as C
from tripmart.operators.dedupe import dedupe_by_key, dedupe_few_copies
from tripmart.operators.lookups import keyset_difference, keyset_differences, missing_keys, orphan_rows
from tripmart.plans import audit as R
from tripmart.plans import bronze, dashboards as D, silver
from tripmart.plans import checks as K
from tripmart.sources import readers, writers
from tripmart.sources.scope import in_months
from tripmart.sources.tables import VersionedTable, month_partitions
from tripmart.store import LANDED, Layers

Query = Callable[[Layers], DataFrame]
_REGISTRY: dict[str, Query] = {}

MARTS = ["mart_daily_demand", "mart_daily_payment_mix", "mart_weather_impact", "mart_zone_demand"]
SILVER = ["silver_trips", "silver_weather", "silver_zones"]
GOLD = ["dim_date", "dim_zone", "dim_weather", "fact_trips"]
MONTH_FOLDER = r"/month=(\d{4}-\d{2})/"
BACKFILL = "1997-02, 1998-07,1997-02,1999-12"


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query):
        return lambda spark, folder: fn(Layers(spark, str(folder)))

    return {name: bind(fn) for name, fn in _REGISTRY.items()}


def steady(name: str):
    """About six decimals, cut rather than rounded.

    A quotient often lies exactly halfway between two decimals, where the last bit of a floating
    sum would decide; the odd offset puts the cut where no short decimal lies.
    """
    return (F.floor(F.col(name) * 1e6 + 0.2123) / F.lit(1e6)).alias(name)


def comparable(df: DataFrame) -> DataFrame:
    """Without lineage; totals to cents, averages and shares to about six places."""
    kept = [c for c in df.columns if not c.endswith("_loaded_at") and c != "source_file"]
    out = []
    for name in kept:
        if name.startswith(("total_", "daily_revenue")) and _is_double(df, name):
            out.append(F.round(name, 2).alias(name))
        elif name.startswith("avg_") or name.endswith("_share_pct"):
            out.append(steady(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def _is_double(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.simpleString() == "double"


def _tables(layers: Layers, names: list[str]) -> dict[str, DataFrame]:
    return {n: layers.table(n) for n in names}


def _given(layers: Layers, name: str) -> DataFrame:
    return bindings.read(layers.spark, layers.folder, name)


def _trips(layers: Layers, **narrow) -> DataFrame:
    """Raw trips for queries that never look at file paths."""
    return bindings.trips_raw(layers.spark, layers.folder, lineage=False, **narrow)


def _bronze(layers: Layers, **narrow) -> DataFrame:
    return bronze.bronze_trips(_trips(layers, **narrow))


def _raw_zones(layers: Layers) -> DataFrame:
    """The zone input under its load contract."""
    return C.conform(layers.zones_raw().withColumnsRenamed(S.ZONE_RENAMES), S.ZONES_RAW)


# -- sources ---------------------------------------------------------------------------------


@query
def scan_csv_trips(x: Layers) -> DataFrame:
    rows = readers.read_trips_csv(x.spark, x.landing("trips"), pattern=LANDED)
    return comparable_rows(bronze.bronze_trips(rows))


@query
def scan_csv_weather(x: Layers) -> DataFrame:
    rows = readers.read_weather_csv(x.spark, x.landing("weather"), pattern=LANDED)
    return comparable_rows(bronze.bronze_weather(rows))


@query
def scan_csv_zones(x: Layers) -> DataFrame:
    rows = readers.read_zones_csv(x.spark, x.landing("zones"), pattern=LANDED)
    return comparable_rows(bronze.bronze_zones(rows))


def comparable_rows(df: DataFrame) -> DataFrame:
    return df.drop("source_file", *[c for c in df.columns if c.endswith("_loaded_at")])


@query
def scan_csv_untyped_count(x: Layers) -> DataFrame:
    return R.labelled_counts({n: x.landed(n) for n in ("trips", "weather", "zones")})


@query
def scan_csv_glob(x: Layers) -> DataFrame:
    """All month folders below one root, found recursively."""
    rows = readers.read_csv(x.spark, x.landing("trips"), pattern=LANDED, label="trips")
    files = rows.groupBy("source_file").agg(F.count("*").alias("n"))
    months = readers.month_of_file(files, MONTH_FOLDER)
    return months.groupBy("file_month").agg(F.sum("n").alias("row_count"))


@query
def month_from_filename(x: Layers) -> DataFrame:
    """Does the month named by a file's path agree with the rows in the file?"""
    rows = readers.read_trips_csv(x.spark, x.landing("trips"), pattern=LANDED)
    month = F.substring("tpep_pickup_datetime", 1, 7).alias("month")
    files = rows.groupBy("source_file", month).agg(F.count("*").alias("n"))
    other = F.when(F.col("month") != F.col("file_month"), F.col("n")).otherwise(0)
    return (
        readers.month_of_file(files, MONTH_FOLDER)
        .groupBy("file_month")
        .agg(F.sum("n").alias("row_count"), F.sum(other).alias("rows_of_other_months"))
    )


@query
def scan_parquet_partitioned(x: Layers) -> DataFrame:
    stored = readers.read_stored(x.spark, x.stored_path("silver_trips"), "silver_trips")
    return stored.groupBy("pickup_year", "pickup_month").agg(F.count("*").alias("row_count"))


@query
def view_parquet_hive(x: Layers) -> DataFrame:
    names = ["silver_trips", "silver_weather"]
    readers.register_views(x.spark, {f"v_{n}": x.stored_path(n) for n in names})
    return x.spark.sql("""
        SELECT t.pickup_year, t.pickup_month, COUNT(*) AS trip_count,
               COUNT(w.weather_date) AS trips_with_weather
        FROM v_silver_trips t LEFT JOIN v_silver_weather w ON t.pickup_date = w.weather_date
        GROUP BY t.pickup_year, t.pickup_month
    """)


@query
def view_csv_inferred(x: Layers) -> DataFrame:
    """Types come from the data: sums and date ranges only work if inference found them."""
    weather = readers.read_csv(
        x.spark, x.landing("weather"), pattern=LANDED, infer=True, lineage=False
    )
    weather.createOrReplaceTempView("v_weather_csv")
    return x.spark.sql("""
        SELECT YEAR(date) AS weather_year, COUNT(*) AS row_count, MIN(date) AS min_date,
               MAX(date) AS max_date, SUM(precipitation_sum) AS precipitation_total
        FROM v_weather_csv GROUP BY YEAR(date)
    """)


@query
def normalize_trip_source(x: Layers) -> DataFrame:
    """Monthly files use other capitals and lack the optional fee."""
    capitals = {"vendorid": "VendorID", "ratecodeid": "RatecodeID",
                "pulocationid": "PULocationID", "dolocationid": "DOLocationID"}
    monthly = _trips(x).drop("airport_fee", "source_file").withColumnsRenamed(capitals)
    return readers.normalize_trip_source(monthly)


def _weather_documents(x: Layers) -> DataFrame:
    """One JSON document of parallel arrays per month; every February lacks its last snowfall."""
    weather = x.weather_raw().filter(F.col("date").isNotNull())
    fields = S.WEATHER_RAW.names[1:]
    month = F.date_format("date", "yyyy-MM").alias("month")
    days = F.sort_array(F.collect_list(F.struct(F.col("date").cast("string").alias("time"), *fields)))
    docs = weather.groupBy(month).agg(days.alias("days"))

    def values(f: str):
        array = F.col(f"days.{f}")
        if f != "snowfall_sum":
            return array.alias(f)
        short = F.slice(array, 1, F.size(array) - 1)
        return F.when(F.col("month").endswith("-02"), short).otherwise(array).alias(f)

    body = F.struct(F.struct(*[values(f) for f in ["time", *fields]]).alias("daily"))
    text = docs.select("month", F.to_json(body).alias("document"))
    parsed = F.from_json("document", readers.daily_schema())
    return text.select("month", parsed["daily"].alias("daily"))


@query
def flatten_parallel_arrays(x: Layers) -> DataFrame:
    return readers.flatten_parallel_arrays(
        _weather_documents(x), ["month"], S.WEATHER_RAW.names[1:]
    )


@query
def check_parallel_array_lengths(x: Layers) -> DataFrame:
    return readers.parallel_array_report(_weather_documents(x), ["month"], S.WEATHER_RAW.names[1:])


@query
def lineage_file_counts(x: Layers) -> DataFrame:
    """Rows per input table file or folder."""
    files = R.rows_per_file(bronze.bronze_trips(x.trips_raw()))
    name = F.regexp_extract("source_file", r"([^/]+\.parquet)", 1).alias("source_file")
    return files.groupBy(name).agg(F.sum("row_count").alias("row_count"))


@query
def check_source_headers(x: Layers) -> DataFrame:
    expected = {
        "trips": (S.TRIPS_RAW.names, False),
        "weather": (S.WEATHER_RAW.names, False),
        "zones": (["locationid", "borough", "zone", "service_zone"], True),
    }
    parts = []
    for name, (names, sanitized) in expected.items():
        report = readers.header_report(
            x.spark, x.landing(name), names, sanitized, pattern=LANDED
        )
        parts.append(
            report.agg(
                F.lit(name).alias("dataset"),
                F.bool_and("header_ok").alias("headers_ok"),
                F.sum("data_rows").alias("data_rows"),
            )
        )
    return A.stacked(parts)


@query
def month_scope_backfill(x: Layers) -> DataFrame:
    """Only the requested months are read from the partitioned table."""
    trips = x.table("silver_trips")
    wanted = in_months(F.col("pickup_year"), F.col("pickup_month"), BACKFILL)
    return (
        trips.filter(wanted)
        .groupBy("pickup_year", "pickup_month")
        .agg(F.count("*").alias("trip_count"), F.max("pickup_date").alias("last_date"))
    )


# -- sinks -----------------------------------------------------------------------------------


@query
def sink_overwrite_roundtrip(x: Layers) -> DataFrame:
    """Written twice; the second write replaces the first."""
    path = x.scratch("dim_weather")
    dim = x.table("dim_weather")
    writers.write_table(dim.unionByName(dim), path)
    writers.write_table(dim, path)
    return comparable_rows(readers.read_stored(x.spark, path, "dim_weather"))


@query
def sink_dynamic_partition_overwrite(x: Layers) -> DataFrame:
    """The last year is written again with other counts; earlier years stay as they were."""
    path = x.scratch("mart_daily_demand")
    by = S.PARTITIONS["mart_daily_demand"]
    mart = x.table("mart_daily_demand").select("pickup_date", *by, "trip_count")
    writers.write_table(mart, path, by)
    last = mart.join(mart.agg(F.max("pickup_year").alias("pickup_year")), "pickup_year", "left_semi")
    writers.write_table(last.withColumn("trip_count", F.col("trip_count") + 1000), path, by)
    stored = x.spark.read.schema(mart.schema).parquet(path)
    return stored.select("pickup_date", *by, "trip_count")


@query
def sink_flat_export(x: Layers) -> DataFrame:
    name, path = "mart_zone_demand", x.scratch("export")
    writers.export_flat(x.table(name), path, S.CONTRACTS[name], S.EXPORT_FILES[name])
    return comparable(x.spark.read.parquet(path))


@query
def export_rowcount_reconcile(x: Layers) -> DataFrame:
    parts = []
    for name in MARTS:
        report = writers.export_flat(
            x.table(name), x.scratch(f"export_{name}"), S.CONTRACTS[name], S.EXPORT_FILES[name]
        )
        parts.append(report.withColumn("dataset", F.lit(name)))
    return A.stacked(parts)


@query
def sink_truncate_once_append(x: Layers) -> DataFrame:
    """Batches of one run add up; an earlier run's rows are gone."""
    path = x.scratch("weather_load")
    raw = x.weather_raw().drop("source_file")
    inside = x.scope.has_day(F.col("date"))
    writers.RunLoader(x.spark).load(raw, path, S.WEATHER_RAW)
    run = writers.RunLoader(x.spark)
    run.load(raw.filter(inside), path, S.WEATHER_RAW)
    run.load(raw.filter(~inside | F.col("date").isNull()), path, S.WEATHER_RAW)
    return run.read(path, S.WEATHER_RAW)


@query
def sink_months_in_one_commit(x: Layers) -> DataFrame:
    """The last year is written again with other counts and the first month is emptied, in one step."""
    by = S.PARTITIONS["mart_daily_demand"]
    mart = x.table("mart_daily_demand").select("pickup_date", *by, "trip_count")
    table = VersionedTable(x.spark, x.scratch("mart_daily_demand_versions"), by)
    table.replace(mart)
    found = mart.agg(F.min(F.struct(*by)).alias("first"), F.max(F.struct(*by)).alias("last")).first()
    again = mart.filter(F.col("pickup_year") == found.last.pickup_year)
    month = f"{found.first.pickup_year:04d}-{found.first.pickup_month:02d}"
    table.replace_partitions(
        again.withColumn("trip_count", F.col("trip_count") + 1000), month_partitions([month], by)
    )
    return table.read()


@query
def sink_batches_resumed(x: Layers) -> DataFrame:
    """A loader that is started again passes over what its run has loaded; an earlier run's rows are gone."""
    path = x.scratch("weather_batches")
    raw = x.weather_raw().drop("source_file")
    inside = x.scope.has_day(F.col("date"))
    batches = {"inside": raw.filter(inside), "outside": raw.filter(~inside | F.col("date").isNull())}
    writers.RunLoader(x.spark, run="earlier").load(raw, path, S.WEATHER_RAW, name="all")
    writers.RunLoader(x.spark, run="load").load(batches["inside"], path, S.WEATHER_RAW, name="inside")
    again = writers.RunLoader(x.spark, run="load")
    for name, batch in batches.items():
        again.load(batch, path, S.WEATHER_RAW, name=name)
    return again.read(path, S.WEATHER_RAW)


@query
def sink_commit_row_counts(x: Layers) -> DataFrame:
    """Rows by month as the commit of a stored table has them."""
    by = S.PARTITIONS["silver_trips"]
    table = VersionedTable(x.spark, x.scratch("silver_trips_versions"), by)
    table.replace_partitions(x.table("silver_trips").select("trip_id", *by))
    return table.row_counts().select("partition", "row_count")


@query
def conform_contract(x: Layers) -> DataFrame:
    text = bindings.as_text(_trips(x).drop("source_file"), S.TRIPS_RAW.names)
    return C.conform(text, S.TRIPS_RAW)


@query
def conform_rejects(x: Layers) -> DataFrame:
    """Distances of trips without payment type are no numbers here; every column is counted."""
    text = bindings.as_text(_trips(x).drop("source_file"), S.TRIPS_RAW.names)
    broken = F.when(F.col("payment_type").isNull(), "n/a").otherwise(F.col("trip_distance"))
    text = text.withColumn("trip_distance", broken)
    return K.violations(text, "trips", C.rejections(text, S.TRIPS_RAW))


@query
def load_clean_blanks(x: Layers) -> DataFrame:
    """Open orders come with a blank priority, pending ones with an empty one."""
    raw = F.when(F.col("o_orderstatus") == "O", "   ").when(F.col("o_orderstatus") == "P", "")
    orders = _given(x, "orders").withColumn("text", raw.otherwise(F.col("o_orderpriority")))
    cleaned = orders.select("o_orderstatus", parsing.blank_to_null(F.col("text")).alias("priority"))
    return cleaned.groupBy("o_orderstatus", "priority").agg(F.count("*").alias("row_count"))


@query
def load_clean_truncate(x: Layers) -> DataFrame:
    limits = S.Contract.of("c_custkey bigint\nc_name varchar(12)\nc_mktsegment varchar(5)")
    return C.conform(_given(x, "customer"), limits)


# -- projections and filters -----------------------------------------------------------------


@query
def ensure_columns(x: Layers) -> DataFrame:
    names = ["o_orderpriority", "o_orderkey", "o_comment", "o_orderstatus"]
    return C.ensure_columns(_given(x, "orders"), names)


@query
def rename_map(x: Layers) -> DataFrame:
    return silver.rename_trips(_bronze(x)).select(*S.TRIP_RENAMES.values())


@query
def cast_bronze_types(x: Layers) -> DataFrame:
    """Text trips in which some distances are not numbers and places carry a decimal point."""
    text = bindings.as_text(_trips(x).drop("source_file"), S.TRIPS_RAW.names).withColumns(
        {
            "trip_distance": F.when(F.col("payment_type").isNull(), "n/a").otherwise(
                F.col("trip_distance")
            ),
            "pulocationid": F.concat("pulocationid", F.lit(".0")),
        }
    )
    return C.retype(text, S.TRIPS_RAW.types)


@query
def cast_silver_types(x: Layers) -> DataFrame:
    narrow = silver.narrow_trips(silver.rename_trips(_bronze(x)))
    return narrow.select(
        "vendor_id", "passenger_count", "rate_code_id", "pickup_location_id",
        "dropoff_location_id", "payment_type_code", "trip_distance", "total_amount",
    )


@query
def sanitize_identifiers(x: Layers) -> DataFrame:
    raw = F.concat_ws(" ", F.col("c_custkey"), F.lit("--"), F.col("c_mktsegment"), F.lit("(%) "))
    return _given(x, "customer").select(
        "c_custkey",
        parsing.sanitize_identifier(F.col("c_name")).alias("name_identifier"),
        parsing.sanitize_identifier(raw).alias("mixed_identifier"),
    )


@query
def bronze_trips(x: Layers) -> DataFrame:
    return comparable_rows(_bronze(x))


@query
def bronze_weather(x: Layers) -> DataFrame:
    return comparable_rows(bronze.bronze_weather(bindings.weather_text(x.spark, x.folder)))


@query
def bronze_zones(x: Layers) -> DataFrame:
    return comparable_rows(x.plan("bronze_zones"))


@query
def filter_trip_quality(x: Layers) -> DataFrame:
    trips = silver.derive_trip_columns(silver.narrow_trips(silver.rename_trips(_bronze(x))))
    return (
        trips.filter(silver.trip_quality())
        .groupBy("pickup_year", "pickup_month")
        .agg(F.count("*").alias("kept_rows"), F.min("trip_duration_minutes").alias("min_minutes"))
    )


@query
def filter_date_scope(x: Layers) -> DataFrame:
    trips = _bronze(x).filter(bindings.NARROW_SCOPE.has_day(F.col("pickup_date")))
    return trips.groupBy("pickup_date").agg(F.count("*").alias("row_count"))


@query
def partition_scope_violations(x: Layers) -> DataFrame:
    return R.scope_summary(
        _bronze(x), "bronze_trips", bindings.NARROW_SCOPE, ["pickup_date"],
        ["pickup_year", "pickup_month"],
    )


@query
def preview_rows(x: Layers) -> DataFrame:
    rows = comparable_rows(_bronze(x))
    return rows.orderBy(*rows.columns).limit(5)


@query
def describe_schema(x: Layers) -> DataFrame:
    return A.stacked(
        [R.describe_schema(comparable_rows(x.table(n)), n) for n in ["bronze_weather", *MARTS]]
    )


@query
def dataset_overview(x: Layers) -> DataFrame:
    names = ["bronze_weather", "bronze_zones", *SILVER, "dim_date", *MARTS]
    return R.dataset_overview(_tables(x, names)).select("dataset_name", "row_count", "column_count")


# -- scalar functions ------------------------------------------------------------------------


@query
def parse_timestamps(x: Layers) -> DataFrame:
    """Event times as text; errors carry a short date and signups a thirteenth month."""
    text = F.substring(F.col("ts").cast("string"), 1, 19)
    kind = F.col("event_type")
    broken = F.when(kind == "error", F.substring(text, 1, 10)).when(
        kind == "signup", F.regexp_replace(text, "-\\d{2}-", "-13-")
    )
    return _given(x, "events").select(
        "event_id", parsing.parse_timestamp(F.coalesce(broken, text)).alias("parsed_ts")
    )


@query
def parse_dates(x: Layers) -> DataFrame:
    """Order dates as text; pending orders use slashes, open ones carry a time as well."""
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    spelled = F.when(status == "P", F.translate(text, "-", "/")).when(
        status == "O", F.concat(text, F.lit(" 00:00:00"))
    )
    return _given(x, "orders").select(
        "o_orderkey", parsing.parse_date(F.coalesce(spelled, text)).alias("parsed_date")
    )


@query
def date_parts(x: Layers) -> DataFrame:
    parts = calendar_attributes(F.to_date("ts"))
    return _given(x, "events").select(
        "event_id",
        F.hour("ts").alias("hour_num"),
        *[c.alias(n) for n, c in parts.items()],
    )


@query
def trip_duration(x: Layers) -> DataFrame:
    """Minutes per line between order and shipping, negative ones included."""
    minutes = minutes_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("minutes")
    lines = _given(x, "lineitem").join(
        _given(x, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return lines.select("l_orderkey", "l_linenumber", minutes)


@query
def trim_text(x: Layers) -> DataFrame:
    zones = C.trim_columns(x.zones_raw(), ["Borough", "Zone", "service_zone"])
    return zones.select("LocationID", "Borough", "Zone", "service_zone")


@query
def fill_optional_amounts(x: Layers) -> DataFrame:
    trips = C.fill_zero(silver.rename_trips(_bronze(x)), S.OPTIONAL_AMOUNTS)
    return trips.groupBy("pickup_year", "pickup_month").agg(
        *[F.count(c).alias(f"{c}_filled") for c in S.OPTIONAL_AMOUNTS],
        *[F.round(F.sum(c), 2).alias(f"{c}_sum") for c in S.OPTIONAL_AMOUNTS],
    )


@query
def surrogate_key(x: Layers) -> DataFrame:
    trips = silver.narrow_trips(silver.rename_trips(_bronze(x)))
    return trips.select(keys.surrogate_key(S.TRIP_KEY).alias("trip_id"), *S.TRIP_KEY)


@query
def payment_type_label(x: Layers) -> DataFrame:
    label = keys.payment_label(F.col("payment_type")).alias("payment_type_name")
    return (
        _trips(x).groupBy("payment_type", label).agg(F.count("*").alias("trip_count"))
    )


@query
def weather_flags(x: Layers) -> DataFrame:
    days = x.plan("silver_weather")
    return days.select("weather_date", "precipitation_sum", "snowfall_sum", "is_rainy_day",
                       "is_snowy_day")


# -- layers ----------------------------------------------------------------------------------


@query
def silver_trips(x: Layers) -> DataFrame:
    return comparable_rows(silver.silver_trips(_bronze(x), x.scope, lineage=False))


@query
def silver_weather(x: Layers) -> DataFrame:
    return comparable_rows(x.plan("silver_weather"))


@query
def silver_zones(x: Layers) -> DataFrame:
    return comparable_rows(x.plan("silver_zones"))


@query
def dim_date(x: Layers) -> DataFrame:
    return comparable_rows(x.plan("dim_date"))


@query
def dim_zone(x: Layers) -> DataFrame:
    return comparable_rows(x.plan("dim_zone"))


@query
def dim_weather(x: Layers) -> DataFrame:
    return comparable_rows(x.plan("dim_weather"))


@query
def fact_trips(x: Layers) -> DataFrame:
    return comparable_rows(x.plan("fact_trips"))


@query
def mart_daily_demand(x: Layers) -> DataFrame:
    return comparable(x.plan("mart_daily_demand"))


@query
def mart_daily_payment_mix(x: Layers) -> DataFrame:
    return comparable(x.plan("mart_daily_payment_mix"))


@query
def mart_weather_impact(x: Layers) -> DataFrame:
    return comparable(x.plan("mart_weather_impact"))


@query
def mart_zone_demand(x: Layers) -> DataFrame:
    return comparable(x.plan("mart_zone_demand"))


# -- joins and set operations ----------------------------------------------------------------


@query
def join_role_playing_zone(x: Layers) -> DataFrame:
    return R.zone_coverage(x.table("silver_trips"), x.table("silver_zones"))


@query
def fk_orphans(x: Layers) -> DataFrame:
    """Fact keys without a dimension row, with the fact rows that hold them."""
    fact = x.table("fact_trips")
    roles = {
        "date": ("pickup_date", x.table("dim_date"), "date_day"),
        "pickup_zone": ("pickup_location_id", x.table("dim_zone"), "location_id"),
        "dropoff_zone": ("dropoff_location_id", x.table("dim_zone"), "location_id"),
        "weather": ("weather_date", x.table("dim_weather"), "weather_date"),
    }
    parts = []
    for role, (column, table, key) in roles.items():
        groups = fact.groupBy(column).agg(F.count("*").alias("row_count"))
        parts.append(
            orphan_rows(groups, table, {column: key}).select(
                F.lit(role).alias("role"), F.col(column).cast("string").alias("key"), "row_count"
            )
        )
    return A.stacked(parts)


@query
def keyset_diff_anti(x: Layers) -> DataFrame:
    """Trip dates without weather and weather dates without trips."""
    trips = x.table("silver_trips").select(F.col("pickup_date").alias("day"))
    weather = x.table("silver_weather").select(F.col("weather_date").alias("day"))
    return A.stacked(
        [
            missing_keys(weather, trips, ["day"]).withColumn("missing_in", F.lit("weather")),
            missing_keys(trips, weather, ["day"]).withColumn("missing_in", F.lit("trips")),
        ]
    )


@query
def keyset_diff_except(x: Layers) -> DataFrame:
    """Bronze trips have keys that the fact lost to the quality rules and the scope."""
    trips = _bronze(x, early=["total_amount"], few_suppliers=True)  # the key has few other columns of a line
    bronze_keys = silver.narrow_trips(silver.rename_trips(trips)).select(
        keys.surrogate_key(S.TRIP_KEY).alias("trip_id")
    )
    return R.except_counts(
        bronze_keys, x.table("fact_trips"), "trip_id", "trip_ids_missing_in_fact",
        "unexpected_trip_ids_in_fact",
    )


def _faulty_fact(x: Layers) -> DataFrame:
    """The fact without the trips of the first of a month, those of the second under other keys."""
    fact, day = x.table("fact_trips"), F.dayofmonth("pickup_date")
    other = F.concat(F.lit("x"), F.substring("trip_id", 2, 63))
    return fact.filter(day != 1).withColumn("trip_id", F.when(day == 2, other).otherwise(F.col("trip_id")))


@query
def keyset_diff_one_pass(x: Layers) -> DataFrame:
    trips = x.table("silver_trips")
    facts = {"fact_trips": x.table("fact_trips"), "fact_trips_faulty": _faulty_fact(x)}
    return A.stacked(
        [
            keyset_difference(trips, fact, ["trip_id"]).withColumn("dataset", F.lit(n))
            for n, fact in facts.items()
        ]
    )


@query
def keyset_diff_digests(x: Layers) -> DataFrame:
    """As in one pass, but keys are exchanged only where the digests of a month's buckets differ."""
    trips = x.table("silver_trips")
    facts = {"fact_trips": x.table("fact_trips"), "fact_trips_faulty": _faulty_fact(x)}
    return A.stacked(
        [
            keyset_differences(trips, fact, ["trip_id"], S.PARTITIONS["fact_trips"]).withColumn("dataset", F.lit(n))
            for n, fact in facts.items()
        ]
    )


@query
def scalar_reconcile(x: Layers) -> DataFrame:
    trips = x.table("silver_trips")
    facts = {"fact_trips": x.table("fact_trips"), "fact_trips_faulty": _faulty_fact(x)}
    return A.stacked(
        [
            R.fact_vs_silver_totals(trips, fact).withColumn("dataset", F.lit(n))
            for n, fact in facts.items()
        ]
    )


@query
def overview_union(x: Layers) -> DataFrame:
    return R.layer_overview(_tables(x, [*SILVER, *GOLD, *MARTS]))


# -- aggregates and windows ------------------------------------------------------------------


@query
def agg_conditional_count(x: Layers) -> DataFrame:
    return (
        _bronze(x)
        .groupBy("pickup_year")
        .agg(
            F.count_if(F.col("total_amount") < 0).alias("negative_rows"),
            F.count_if(F.col("payment_type").isNull()).alias("no_payment_rows"),
        )
    )


@query
def null_profile(x: Layers) -> DataFrame:
    return A.profile(_trips(x), A.null_conditions(S.TRIPS_RAW.names), row_count=F.count("*"))


@query
def overview_counts(x: Layers) -> DataFrame:
    return A.overview({"bronze_weather": (x.plan("bronze_weather"), "date")})


@query
def distinct_partitions(x: Layers) -> DataFrame:
    return R.distinct_partitions(_bronze(x), ["pickup_year", "pickup_month"])


@query
def dedupe(x: Layers) -> DataFrame:
    """Largest order per customer; of equal ones the lowest key."""
    orders = _given(x, "orders").withColumn("smallness", -F.col("o_totalprice"))
    return dedupe_by_key(orders, ["o_custkey"], ["smallness", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice"
    )


_REGISTRY["dedupe_by_key"] = _REGISTRY.pop("dedupe")


@query
def silver_trips_few_copies(x: Layers) -> DataFrame:
    """Silver trips, of which only rows with repeated keys are shuffled."""
    return comparable_rows(
        silver.silver_trips(_bronze(x), x.scope, lineage=False, unique_rows=dedupe_few_copies)
    )


@query
def having_duplicates(x: Layers) -> DataFrame:
    """Trip keys that occur more than once before deduplication."""
    trips = silver.clean_trips(_bronze(x), x.scope)
    return R.repeated_keys(trips, ["trip_id"])


@query
def duplicate_group_count(x: Layers) -> DataFrame:
    trips = silver.clean_trips(_bronze(x), x.scope)
    return A.duplicate_group_count(trips, ["trip_id"], "duplicate_trip_ids")


@query
def agg_sum_or_zero(x: Layers) -> DataFrame:
    """The airport fee is null on every row; its total is 0, not null."""
    return _trips(x).agg(
        F.round(A.total_or_zero("airport_fee"), 2).alias("airport_fee_total"),
        F.round(A.total_or_zero("tolls_amount"), 2).alias("tolls_total"),
    )


@query
def share_of_day_total(x: Layers) -> DataFrame:
    """Each pickup place's share of the trips of its day."""
    counts = x.table("fact_trips").groupBy("pickup_date", "pickup_location_id").agg(
        F.count("*").alias("trip_count")
    )
    shared = A.share_of_total(counts, ["pickup_date"], {"share": "trip_count"}, ["share"])
    return shared.withColumn("share", steady("share"))


# -- raw and bronze reports ------------------------------------------------------------------


@query
def raw_row_counts(x: Layers) -> DataFrame:
    return R.labelled_counts(
        {"trips_raw": _trips(x), "weather_raw": x.weather_raw(), "zones_raw": x.zones_raw()}
    )


@query
def raw_trip_quality(x: Layers) -> DataFrame:
    return R.raw_trip_quality(_trips(x), bindings.NARROW_SCOPE)


@query
def weather_completeness(x: Layers) -> DataFrame:
    return R.weather_completeness(x.weather_raw())


@query
def zone_distinct_profile(x: Layers) -> DataFrame:
    return R.zone_distinct_profile(_raw_zones(x))


@query
def unmapped_locations(x: Layers) -> DataFrame:
    return R.unmapped_locations(_trips(x), _raw_zones(x))


@query
def daily_coverage(x: Layers) -> DataFrame:
    return R.daily_coverage(_trips(x), x.weather_raw())


@query
def payment_distribution(x: Layers) -> DataFrame:
    return R.payment_distribution(_trips(x))


@query
def business_metrics(x: Layers) -> DataFrame:
    metrics = R.business_metrics(_trips(x))
    return metrics.select(
        "trip_count",
        *[F.round(c, 2).alias(c) for c in metrics.columns if c != "trip_count"],
    )


@query
def raw_status_summary(x: Layers) -> DataFrame:
    return R.raw_status_summary(_trips(x), x.weather_raw(), _raw_zones(x))


@query
def raw_table_profile(x: Layers) -> DataFrame:
    return R.raw_table_profile(_trips(x), x.weather_raw(), _raw_zones(x))


@query
def raw_vs_bronze_counts(x: Layers) -> DataFrame:
    pairs = {
        "trips": (x.landed("trips"), _bronze(x)),
        "weather": (x.landed("weather"), x.plan("bronze_weather")),
        "zones": (x.landed("zones"), x.plan("bronze_zones")),
    }
    return R.counts_side_by_side(pairs, "raw_count", "bronze_count")


@query
def rows_per_month(x: Layers) -> DataFrame:
    tables = {"bronze_trips": _bronze(x), "bronze_weather": x.plan("bronze_weather"),
              **_tables(x, ["silver_trips", "silver_weather"])}
    return R.rows_per_month({n: (df, S.PARTITIONS[n]) for n, df in tables.items()})


@query
def datetime_extremes(x: Layers) -> DataFrame:
    return R.datetime_extremes(_bronze(x))


@query
def bronze_negative_review(x: Layers) -> DataFrame:
    names = ["trip_distance", "fare_amount", "total_amount"]
    return A.profile(_bronze(x), K.negative_conditions(names, ""))


@query
def calendar_gaps(x: Layers) -> DataFrame:
    return R.calendar_gaps(x.plan("bronze_weather"))


@query
def zones_per_borough(x: Layers) -> DataFrame:
    return R.zones_per_borough(x.plan("bronze_zones"))


# -- checks ----------------------------------------------------------------------------------


def _layer_tables(x: Layers) -> dict[str, DataFrame]:
    bronze_tables = {n: x.plan(n) for n in ("bronze_trips", "bronze_weather", "bronze_zones")}
    return {**bronze_tables, **_tables(x, [*SILVER, *GOLD, *MARTS])}


@query
def check_non_empty(x: Layers) -> DataFrame:
    return A.stacked([K.non_empty(df, n) for n, df in _layer_tables(x).items()])


@query
def check_columns(x: Layers) -> DataFrame:
    """What the stored files hold; with a copy that has a surplus, an absent and a mistyped column."""
    faulty = x.scratch("dim_zone_faulty")
    zones = x.table("dim_zone").withColumn("extra", F.lit(1)).drop("service_zone")
    zones.withColumn("location_id", F.col("location_id").cast("string")).write.parquet(faulty)
    found = {n: dict(df.dtypes) for n, df in _layer_tables(x).items() if n.startswith("bronze_")}
    found |= {
        n: K.stored_columns(x.spark, x.stored_path(n)) for n in [*SILVER, *GOLD, *MARTS]
    }
    rows = [K.columns_match(x.spark, c, n, S.CONTRACTS[n]) for n, c in found.items()]
    bad = K.stored_columns(x.spark, faulty)
    rows.append(K.columns_match(x.spark, bad, "dim_zone_faulty", S.CONTRACTS["dim_zone"]))
    return A.stacked(rows).drop("path")


@query
def check_columns_by_folder(x: Layers) -> DataFrame:
    """The last month of a mart has a surplus column and one of another type; its folder is named."""
    name = "mart_daily_demand"
    by, contract = S.PARTITIONS[name], S.CONTRACTS[name]
    table = VersionedTable(x.spark, x.scratch(f"{name}_odd_month"), by)
    mart = x.table(name)
    table.replace(mart)
    last = mart.agg(F.max(F.struct(*by)).alias("m")).first().m
    odd = mart.filter((F.col(by[0]) == last[0]) & (F.col(by[1]) == last[1]))
    table.replace_partitions(odd.withColumn("trip_count", F.col("trip_count").cast("string")).withColumn("extra", F.lit(1)))
    report = K.columns_match(x.spark, K.stored_schemas(x.spark, table.folders()), name, contract, by)
    return report.withColumn("folder", F.substring_index("path", "/", -2)).drop("path")


@query
def check_rowcount_relation(x: Layers) -> DataFrame:
    """Trips may shrink anywhere; weather and zones must not on the way to bronze."""
    parts = [
        K.rowcount_relation(_trips(x), _bronze(x), "bronze_trips"),
        K.rowcount_relation(x.weather_raw(), x.plan("bronze_weather"), "bronze_weather", False),
        K.rowcount_relation(x.zones_raw(), x.plan("bronze_zones"), "bronze_zones", False),
    ]
    for part in ("trips", "weather", "zones"):
        name = f"silver_{part}"
        parts.append(K.rowcount_relation(x.plan(f"bronze_{part}"), x.table(name), name))
    return A.stacked(parts)


@query
def check_rowcount_exact(x: Layers) -> DataFrame:
    pairs = {"fact_trips": "silver_trips", "dim_weather": "silver_weather",
             "dim_zone": "silver_zones"}
    parts = [K.rowcount_exact(x.table(s), x.table(t), t) for t, s in pairs.items()]
    faulty = K.rowcount_exact(x.table("silver_trips"), _faulty_fact(x), "fact_trips_faulty")
    return A.stacked([*parts, faulty])


@query
def check_unique_key(x: Layers) -> DataFrame:
    tables = _layer_tables(x)
    return A.stacked([K.unique_key(tables[n], n, k) for n, k in S.UNIQUE_KEYS.items()])


@query
def nulls_bronze(x: Layers) -> DataFrame:
    names = ["bronze_trips", "bronze_weather", "bronze_zones"]
    return A.stacked([K.required_columns(x.plan(n), n) for n in names])


@query
def nulls_silver(x: Layers) -> DataFrame:
    return A.stacked([K.required_columns(x.table(n), n) for n in SILVER])


@query
def nulls_gold(x: Layers) -> DataFrame:
    return A.stacked([K.required_columns(x.table(n), n) for n in GOLD])


@query
def nulls_serving(x: Layers) -> DataFrame:
    return A.stacked([K.required_columns(x.table(n), n) for n in MARTS])


@query
def blank_text(x: Layers) -> DataFrame:
    """Both readings of null, on the dimension and on the mart, whose names can be null."""
    parts = []
    for name in ("dim_zone", "mart_zone_demand"):
        for null_is_blank in (False, True):
            report = K.blank_text(x.table(name), name, K.ZONE_DESCRIPTION, null_is_blank)
            parts.append(report.withColumn("null_is_blank", F.lit(null_is_blank)))
    return A.stacked(parts)


@query
def check_time_order(x: Layers) -> DataFrame:
    """On derived trips before the quality filter, where violations exist, and after it."""
    derived = silver.derive_trip_columns(silver.narrow_trips(silver.rename_trips(_bronze(x))))
    return A.stacked(
        [K.time_order(derived, "derived_trips"), K.time_order(x.table("silver_trips"), "silver_trips")]
    )


@query
def check_weather_date_match(x: Layers) -> DataFrame:
    condition = {"bad_weather_date_match_rows": K.weather_match_condition()}
    return A.stacked(
        [K.violations(x.table(n), n, condition) for n in ("fact_trips", "mart_weather_impact")]
    )


@query
def check_derived_parts(x: Layers) -> DataFrame:
    return A.stacked([K.derived_parts(x.table(n), n) for n in ("silver_trips", "fact_trips")])


@query
def check_dim_date_logic(x: Layers) -> DataFrame:
    return K.violations(x.table("dim_date"), "dim_date", K.date_logic_conditions())


@query
def check_dim_date_coverage(x: Layers) -> DataFrame:
    return K.dim_date_coverage(x.table("dim_date"), x.table("silver_trips"))


@query
def check_weather_flags(x: Layers) -> DataFrame:
    return K.violations(x.table("dim_weather"), "dim_weather", K.flag_conditions())


@query
def check_negative_distance(x: Layers) -> DataFrame:
    return K.violations(
        x.table("fact_trips"), "fact_trips", K.negative_conditions(["trip_distance"])
    )


@query
def negative_money_profile(x: Layers) -> DataFrame:
    return K.violations(
        x.table("fact_trips"), "fact_trips", K.negative_conditions(S.MONEY_COLUMNS), K.WARN
    )


@query
def check_same_keys(x: Layers) -> DataFrame:
    trips = x.table("silver_trips")
    facts = {"fact_trips": x.table("fact_trips"), "fact_trips_faulty": _faulty_fact(x)}
    return A.stacked([K.same_keys(trips, fact, n, ["trip_id"], S.PARTITIONS["fact_trips"]) for n, fact in facts.items()])


@query
def fk_coverage(x: Layers) -> DataFrame:
    return K.fk_coverage(
        x.table("fact_trips"), x.table("dim_date"), x.table("dim_zone"), x.table("dim_weather")
    )


@query
def check_partition_dirs(x: Layers) -> DataFrame:
    """Each partition of the stored table lies in its own folder."""
    stored = x.spark.read.parquet(x.stored_path("silver_trips"))
    return K.partition_folders(stored, S.PARTITIONS["silver_trips"])


def _counted(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.count("*").alias(name))


@query
def demand_vs_dim_date(x: Layers) -> DataFrame:
    rows = K.demand_vs_dim_date(x.table("mart_daily_demand"), x.table("dim_date"))
    return _counted(rows, "mart_daily_demand_date_mismatch_rows")


@query
def weather_vs_dims(x: Layers) -> DataFrame:
    rows = K.weather_vs_dims(
        x.table("mart_weather_impact"), x.table("dim_date"), x.table("dim_weather")
    )
    return _counted(rows, "mart_weather_impact_descriptor_mismatch_rows")


@query
def zone_vs_dim_zone(x: Layers) -> DataFrame:
    rows = K.zone_vs_dim_zone(x.table("mart_zone_demand"), x.table("dim_zone"))
    return _counted(rows, "mart_zone_demand_descriptor_mismatch_rows")


def _reconciled(x: Layers, mart: str, negatives: bool = True) -> DataFrame:
    row = K.reconcile_mart(x.table(mart), x.table("fact_trips"), S.UNIQUE_KEYS[mart], negatives)
    return row.withColumns(
        {c: F.round(c, 2) for c in ("mart_revenue", "fact_total_amount")}
    )


@query
def reconcile_daily_demand(x: Layers) -> DataFrame:
    return _reconciled(x, "mart_daily_demand")


@query
def reconcile_payment_mix(x: Layers) -> DataFrame:
    return _reconciled(x, "mart_daily_payment_mix", negatives=False)


@query
def reconcile_weather_impact(x: Layers) -> DataFrame:
    return _reconciled(x, "mart_weather_impact")


@query
def reconcile_zone_demand(x: Layers) -> DataFrame:
    return _reconciled(x, "mart_zone_demand")


@query
def check_payment_labels(x: Layers) -> DataFrame:
    return _counted(K.label_mismatches(x.table("mart_daily_payment_mix")), "label_mismatch_rows")


@query
def share_sum_violations(x: Layers) -> DataFrame:
    sums = K.day_share_sums(x.table("mart_daily_payment_mix"))
    return K.violations(sums, "mart_daily_payment_mix", K.share_sum_conditions())


@query
def share_range_violations(x: Layers) -> DataFrame:
    """Strict and tolerant range; refunds put some revenue shares outside."""
    mix = x.table("mart_daily_payment_mix")
    parts = []
    for tolerance in (0.0, S.SHARE_TOLERANCE):
        report = K.violations(
            mix, "mart_daily_payment_mix", K.share_range_conditions(tolerance), K.WARN
        )
        parts.append(report.withColumn("tolerance", F.lit(tolerance)))
    return A.stacked(parts)


@query
def cross_mart_demand_weather(x: Layers) -> DataFrame:
    rows = K.cross_mart_mismatches(x.table("mart_daily_demand"), x.table("mart_weather_impact"))
    return _counted(rows, "daily_vs_weather_mismatch_rows")


@query
def cross_mart_demand_payment(x: Layers) -> DataFrame:
    rolled = K.daily_totals(x.table("mart_daily_payment_mix"), negatives=False)
    rows = K.cross_mart_mismatches(x.table("mart_daily_demand"), rolled, negatives=False)
    return _counted(rows, "daily_vs_payment_mix_mismatch_rows")


@query
def cross_mart_demand_zone(x: Layers) -> DataFrame:
    rolled = K.daily_totals(x.table("mart_zone_demand"), negatives=True)
    rows = K.cross_mart_mismatches(x.table("mart_daily_demand"), rolled)
    return _counted(rows, "daily_vs_zone_mismatch_rows")


# -- silver, gold and serving reports --------------------------------------------------------


_SCOPED = {
    "silver_trips": (["pickup_date"], True),
    "silver_weather": (["weather_date"], True),
    "dim_date": (["date_day"], False),
    "dim_weather": (["weather_date"], False),
    "fact_trips": (["pickup_date", "weather_date"], True),
    "mart_daily_demand": (["pickup_date"], False),
    "mart_daily_payment_mix": (["pickup_date"], False),
    "mart_weather_impact": (["pickup_date", "weather_date"], False),
    "mart_zone_demand": (["pickup_date"], False),
}


@query
def scope_violations_summary(x: Layers) -> DataFrame:
    return A.stacked(
        [
            R.scope_summary(
                x.table(n), n, bindings.NARROW_SCOPE, dates, S.PARTITIONS[n] if parts else None
            )
            for n, (dates, parts) in _SCOPED.items()
        ]
    )


def _outside(x: Layers, name: str, dates: list[str]) -> DataFrame:
    """Dates and months of a layer outside the narrow scope, with their rows."""
    return R.scope_detail(x.table(name), bindings.NARROW_SCOPE, dates, S.PARTITIONS[name])


@query
def scope_violations_detail(x: Layers) -> DataFrame:
    return _outside(x, "silver_weather", ["weather_date"])


@query
def scope_violations_detail_trips(x: Layers) -> DataFrame:
    return _outside(x, "silver_trips", ["pickup_date"])


@query
def scope_violations_detail_fact(x: Layers) -> DataFrame:
    return _outside(x, "fact_trips", ["pickup_date", "weather_date"])


@query
def scope_violations_detail_marts(x: Layers) -> DataFrame:
    return A.stacked(
        [
            _outside(x, name, ["pickup_date"]).withColumn("dataset", F.lit(name))
            for name in MARTS
        ]
    )


@query
def silver_quality_profile(x: Layers) -> DataFrame:
    return R.silver_quality_profile(x.table("silver_trips"))


@query
def silver_weather_profile(x: Layers) -> DataFrame:
    return R.silver_weather_profile(x.table("silver_weather"))


@query
def silver_zone_profile(x: Layers) -> DataFrame:
    return R.silver_zone_profile(x.table("silver_zones"))


@query
def duplicate_grain_summary(x: Layers) -> DataFrame:
    return R.duplicate_grain_summary(_tables(x, [*SILVER, *GOLD, *MARTS]))


@query
def dates_without_weather(x: Layers) -> DataFrame:
    return R.dates_without_weather(x.table("silver_trips"), x.table("silver_weather"))


@query
def daily_snapshot(x: Layers) -> DataFrame:
    return R.daily_snapshot(x.table("silver_trips"))


@query
def payment_mix_snapshot(x: Layers) -> DataFrame:
    return R.payment_mix_snapshot(x.table("silver_trips"))


@query
def top_pickup_locations(x: Layers) -> DataFrame:
    return R.top_pickup_locations(x.table("silver_trips"))


@query
def top_zones_fact(x: Layers) -> DataFrame:
    return R.top_zones_fact(x.table("fact_trips"), x.table("dim_zone"))


@query
def top_zones_mart(x: Layers) -> DataFrame:
    return R.top_zones_mart(x.table("mart_zone_demand"))


@query
def weather_snapshot(x: Layers) -> DataFrame:
    return R.weather_snapshot(x.table("silver_weather"))


@query
def zone_snapshot(x: Layers) -> DataFrame:
    return R.zone_snapshot(x.table("silver_zones"))


@query
def monthly_revenue(x: Layers) -> DataFrame:
    return R.monthly_revenue(x.table("fact_trips"))


@query
def dim_quality_profile(x: Layers) -> DataFrame:
    return R.dim_quality_profile(x.table("dim_date"), x.table("dim_zone"), x.table("dim_weather"))


@query
def fact_quality_profile(x: Layers) -> DataFrame:
    return R.fact_quality_profile(x.table("fact_trips"))


@query
def negative_amount_by_day(x: Layers) -> DataFrame:
    return R.negative_fact_days(x.table("fact_trips"))


@query
def negative_amount_by_mart_day(x: Layers) -> DataFrame:
    days = R.negative_mart_days(x.table("mart_daily_demand"))
    return days.withColumn("total_revenue", F.round("total_revenue", 2))


@query
def mart_month_coverage(x: Layers) -> DataFrame:
    return R.rows_per_month({n: (x.table(n), S.PARTITIONS[n]) for n in MARTS})


@query
def mart_quality_profile(x: Layers) -> DataFrame:
    return R.mart_quality_profile(_tables(x, MARTS))


@query
def payment_label_listing(x: Layers) -> DataFrame:
    return R.payment_label_listing(x.table("mart_daily_payment_mix"))


@query
def mart_snapshots(x: Layers) -> DataFrame:
    return comparable(R.mart_snapshots(_tables(x, MARTS)))


# -- dashboards ------------------------------------------------------------------------------


@query
def kpi_summary(x: Layers) -> DataFrame:
    return comparable(D.kpi_summary(x.table("mart_daily_demand")))


@query
def daily_trips_vs_revenue(x: Layers) -> DataFrame:
    return comparable(D.daily_trips_vs_revenue(x.table("mart_daily_demand")))


@query
def dow_profile(x: Layers) -> DataFrame:
    return comparable(D.dow_profile(x.table("mart_daily_demand")))


@query
def daily_revenue_trend(x: Layers) -> DataFrame:
    return comparable(D.daily_revenue_trend(x.table("mart_daily_demand")))


@query
def distance_vs_revenue(x: Layers) -> DataFrame:
    return comparable(D.distance_vs_revenue(x.table("mart_daily_demand")))


@query
def top_peak_days(x: Layers) -> DataFrame:
    return comparable(D.top_peak_days(x.table("mart_daily_demand")))


@query
def weather_effect(x: Layers) -> DataFrame:
    return comparable(D.weather_effect(x.table("mart_weather_impact")))
