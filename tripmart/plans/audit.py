"""Audit reports over raw, bronze, silver, gold and serving tables.

Every report takes the tables (and, where dates matter, the scope) as arguments and returns a
DataFrame.  Quality reports are one row from one pass over their table.  The names of measures are
fixed values: they are the reports' output contract.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions import parsing
from tripmart.operators.aggregates import (
    duplicate_group_count,
    duplicate_groups,
    grand_share,
    money_sum,
    null_conditions,
    overview,
    profile,
    row_counts,
    side_by_side,
    stacked,
    top_by,
)
from tripmart.operators.lookups import (
    keyset_difference,
    left_lookup,
    orphan_rows,
    packed_key,
    unmatched_counts,
)
from tripmart.plans import checks as K
from tripmart.sources.scope import Scope

# -- raw -------------------------------------------------------------------------------------


def labelled_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return stacked(
        [
            df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
            for name, df in tables.items()
        ]
    )


def raw_trip_quality(trips: DataFrame, scope: Scope) -> DataFrame:
    """Range, nulls, negatives, time order and days outside the expected window."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    day = F.to_date(pickup)
    conditions = {
        "pickup_datetime_nulls": pickup.isNull(),
        "dropoff_datetime_nulls": dropoff.isNull(),
        **null_conditions(["pulocationid", "dolocationid", "total_amount"]),
        **K.negative_conditions(["trip_distance", "passenger_count", "total_amount"]),
        "invalid_datetime_order_rows": dropoff < pickup,
        "pickup_date_out_of_expected_range_rows": scope.outside_day(day),
    }
    return profile(
        trips,
        conditions,
        trip_row_count=F.count("*"),
        min_pickup_date=F.min(day),
        max_pickup_date=F.max(day),
    )


def weather_completeness(weather: DataFrame) -> DataFrame:
    """Calendar days expected between first and last date, missing days, repeated dates, nulls.

    Rows are reduced to one per date first; the date count is then a plain count.
    """
    measures = ["temperature_2m_mean", "precipitation_sum", "snowfall_sum"]
    per_date = weather.groupBy("date").agg(
        F.count("*").alias("n"), *[F.count_if(F.col(m).isNull()).alias(m) for m in measures]
    )
    totals = per_date.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("weather_row_count"),
        F.count("date").alias("distinct_weather_dates"),
        F.min("date").alias("min_weather_date"),
        F.max("date").alias("max_weather_date"),
        F.coalesce(F.sum(F.when(F.col("date").isNull(), F.col("n"))), F.lit(0)).alias("date_nulls"),
        *[
            F.coalesce(F.sum(m), F.lit(0)).alias(f"{m.replace('_2m', '')}_nulls")
            for m in measures
        ],
    )
    span = (F.datediff("max_weather_date", "min_weather_date") + 1).cast("bigint")
    return totals.withColumns(
        {
            "expected_calendar_days": span,
            "missing_weather_days": span - F.col("distinct_weather_dates"),
            "duplicate_weather_date_rows": F.col("weather_row_count")
            - F.col("distinct_weather_dates"),
        }
    )


def zone_distinct_profile(zones: DataFrame) -> DataFrame:
    ids = F.count_distinct("location_id")
    return profile(
        zones,
        null_conditions(["location_id", "borough", "zone", "service_zone"]),
        zone_row_count=F.count("*"),
        distinct_location_ids=ids,
        duplicate_location_id_rows=F.count("*") - ids,
    )


def unmapped_locations(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trip rows whose pickup or dropoff place is not in the zone table, one row per role."""
    row = unmatched_counts(
        trips,
        {
            "pickup_location_unmapped": ("pulocationid", zones, "location_id", None),
            "dropoff_location_unmapped": ("dolocationid", zones, "location_id", None),
        },
    )
    return row.unpivot([], row.columns, "check_name", "unmapped_rows")


def daily_coverage(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Days with trips, how many of them lack weather, first and last."""
    days = trips.groupBy(F.to_date("tpep_pickup_datetime").alias("pickup_date")).agg(
        F.count("*").alias("trip_count")
    )
    known = weather.select("date").distinct().withColumn("_there", F.lit(True))
    joined = left_lookup(days, known, {"pickup_date": "date"}, {"has_weather": "_there"})
    return joined.agg(
        F.count("*").alias("active_days"),
        F.count_if(F.col("has_weather").isNull()).alias("days_missing_weather"),
        F.min("pickup_date").alias("min_trip_date"),
        F.max("pickup_date").alias("max_trip_date"),
    )


def payment_distribution(trips: DataFrame) -> DataFrame:
    counts = trips.groupBy("payment_type").agg(F.count("*").alias("trip_count"))
    return grand_share(counts, "trip_count", "trip_share_pct").orderBy("payment_type")


def business_metrics(trips: DataFrame) -> DataFrame:
    return trips.agg(
        F.count("*").alias("trip_count"),
        money_sum("total_amount").alias("total_revenue_raw"),
        F.avg("total_amount").alias("avg_total_amount_raw"),
        F.avg("trip_distance").alias("avg_trip_distance_raw"),
    )


def raw_status_summary(trips: DataFrame, weather: DataFrame, zones: DataFrame) -> DataFrame:
    """One PASS / CHECK_REQUIRED row over all three inputs."""
    t = profile(
        trips,
        {
            "pickup_nulls": F.col("tpep_pickup_datetime").isNull(),
            "pickup_location_nulls": F.col("pulocationid").isNull(),
            "dropoff_location_nulls": F.col("dolocationid").isNull(),
        },
        trip_rows=F.count("*"),
    )
    w = weather_completeness(weather).select(
        F.col("weather_row_count").alias("weather_rows"),
        F.col("missing_weather_days").alias("missing_days"),
    )
    z = zone_distinct_profile(zones).select(
        F.col("zone_row_count").alias("zone_rows"),
        F.col("duplicate_location_id_rows").alias("duplicate_location_ids"),
    )
    row = side_by_side(t, w, z)
    filled = ["trip_rows", "weather_rows", "zone_rows"]
    good = F.lit(True)
    for name in row.columns:
        good = good & (F.col(name) > 0 if name in filled else F.col(name) == 0)
    status = F.when(good, "PASS").otherwise("CHECK_REQUIRED")
    return row.select(status.alias("raw_layer_status"), *row.columns)


def raw_table_profile(trips: DataFrame, weather: DataFrame, zones: DataFrame) -> DataFrame:
    """Counts and date ranges of the raw tables, with repeated zone ids."""
    day = F.to_date("tpep_pickup_datetime")
    return side_by_side(
        trips.agg(
            F.count("*").alias("trip_rows"),
            F.min(day).alias("min_pickup_date"),
            F.max(day).alias("max_pickup_date"),
        ),
        weather.agg(
            F.count("*").alias("weather_rows"),
            F.min("date").alias("min_weather_date"),
            F.max("date").alias("max_weather_date"),
        ),
        zones.agg(F.count("*").alias("zone_rows")),
        duplicate_group_count(zones, ["location_id"], "duplicate_zone_id_groups"),
    )


# -- bronze ----------------------------------------------------------------------------------


def counts_side_by_side(pairs: Mapping[str, tuple[DataFrame, DataFrame]], left: str, right: str):
    """Per dataset, rows of two tables next to each other."""
    return stacked(
        [
            row_counts({left: a, right: b}).select(F.lit(name).alias("dataset"), left, right)
            for name, (a, b) in pairs.items()
        ]
    )


def rows_per_month(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows per year and month of each table."""
    parts = []
    for name, (df, (year, month)) in tables.items():
        grouped = df.groupBy(F.col(year).alias("year_num"), F.col(month).alias("month_num"))
        parts.append(
            grouped.agg(F.count("*").alias("row_count")).withColumn("dataset_name", F.lit(name))
        )
    return stacked(parts).orderBy("dataset_name", "year_num", "month_num")


def datetime_extremes(trips: DataFrame) -> DataFrame:
    p, d = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    return trips.agg(
        F.min(p).alias("min_pickup_ts"),
        F.max(p).alias("max_pickup_ts"),
        F.min(d).alias("min_dropoff_ts"),
        F.max(d).alias("max_dropoff_ts"),
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("source_file")
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), "source_file")
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return duplicate_groups(df, keys).orderBy(*keys)


def calendar_gaps(weather: DataFrame, date_column: str = "date") -> DataFrame:
    """Dates between the first and last that do not occur."""
    ends = weather.agg(F.min(date_column).alias("a"), F.max(date_column).alias("b"))
    days = F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("expected_date")
    every = ends.filter(F.col("a").isNotNull()).select(days)
    return orphan_rows(every, weather, {"expected_date": date_column}).orderBy("expected_date")


def zones_per_borough(zones: DataFrame) -> DataFrame:
    return (
        zones.groupBy("borough")
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("row_count"), "borough")
    )


def distinct_partitions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct().orderBy(*columns)


# -- scope -----------------------------------------------------------------------------------


def scope_summary(
    df: DataFrame,
    dataset: str,
    scope: Scope,
    dates: Sequence[str],
    partition: Sequence[str] | None = None,
) -> DataFrame:
    """Rows outside the scope by date column, and by year / month if given."""
    conditions = {f"{d}_out_of_scope": scope.outside_day(F.col(d)) for d in dates}
    if partition:
        conditions["partition_out_of_scope"] = scope.outside_month(*map(F.col, partition))
    return K.violations(df, dataset, conditions)


def scope_detail(
    df: DataFrame,
    scope: Scope,
    dates: Sequence[str],
    partition: Sequence[str] | None = None,
) -> DataFrame:
    """The values that lie outside, with their row counts."""
    outside: list[Column] = [scope.outside_day(F.col(d)) for d in dates]
    if partition:
        outside.append(scope.outside_month(*map(F.col, partition)))
    keys = [*dates, *(partition or [])]
    return df.filter(K.any_of(outside)).groupBy(*keys).agg(F.count("*").alias("row_count"))


# -- silver and gold -------------------------------------------------------------------------


def silver_quality_profile(trips: DataFrame) -> DataFrame:
    required = [c for c in S.REQUIRED["silver_trips"] if c != "trip_duration_minutes"]
    return profile(
        trips,
        {
            **null_conditions(required),
            **K.time_order_conditions(),
            **K.derived_part_conditions(),
        },
    )


def silver_weather_profile(weather: DataFrame) -> DataFrame:
    return profile(
        weather,
        {
            **null_conditions(S.REQUIRED["silver_weather"]),
            "bad_weather_year_rows": F.col("weather_year") != F.year("weather_date"),
            "bad_weather_month_rows": F.col("weather_month") != F.month("weather_date"),
            **K.flag_conditions(),
        },
    )


def _blank_conditions() -> dict[str, Column]:
    return {
        f"blank_{c}_rows": parsing.is_blank(F.col(c), null_is_blank=True)
        for c in K.ZONE_DESCRIPTION
    }


def silver_zone_profile(zones: DataFrame) -> DataFrame:
    return profile(
        zones, {**null_conditions(S.REQUIRED["silver_zones"]), **_blank_conditions()}
    )


def dim_date_profile(dim_date: DataFrame) -> DataFrame:
    logic = K.date_logic_conditions()
    kept = ["bad_year_num_rows", "bad_quarter_num_rows", "bad_month_num_rows", "bad_day_num_rows"]
    return profile(
        dim_date, {**null_conditions(S.DIM_DATE.names), **{n: logic[n] for n in kept}}
    )


def dim_zone_profile(dim_zone: DataFrame) -> DataFrame:
    return profile(dim_zone, {**null_conditions(S.DIM_ZONE.names), **_blank_conditions()})


def dim_weather_profile(dim_weather: DataFrame) -> DataFrame:
    return profile(
        dim_weather, {**null_conditions(S.DIM_WEATHER.names), **K.flag_conditions()}
    )


def dim_quality_profile(dim_date: DataFrame, dim_zone: DataFrame, dim_weather: DataFrame):
    """The three dimension profiles as report rows."""
    return stacked(
        [
            K.as_report(dim_date_profile(dim_date), "dim_date"),
            K.as_report(dim_zone_profile(dim_zone), "dim_zone"),
            K.as_report(dim_weather_profile(dim_weather), "dim_weather"),
        ]
    )


def fact_quality_profile(fact: DataFrame) -> DataFrame:
    """Thirty counts from one pass."""
    nulls = [
        "trip_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_year",
        "pickup_month", "pickup_hour", "weather_date", "pickup_location_id",
        "dropoff_location_id", "trip_distance", "trip_duration_minutes", "total_amount",
        "gold_loaded_at",
    ]
    return profile(
        fact,
        {
            **null_conditions(nulls),
            **K.time_order_conditions(),
            **K.negative_conditions(["trip_distance"]),
            **K.derived_part_conditions(),
            "bad_weather_date_match_rows": K.weather_match_condition(),
            **K.negative_conditions(S.MONEY_COLUMNS),
        },
    )


def duplicate_grain_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row: repeated keys per table, by the key each layer table must be unique on."""
    return side_by_side(
        *[
            duplicate_group_count(df, S.UNIQUE_KEYS[name], f"{name}_duplicate_keys")
            for name, df in tables.items()
        ]
    )


def dates_without_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    days = trips.select("pickup_date").distinct()
    return orphan_rows(days, weather, {"pickup_date": "weather_date"}).agg(
        F.count("*").alias("trip_dates_without_weather")
    )


def zone_coverage(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return unmatched_counts(
        trips,
        {
            "missing_pickup_zone_rows": ("pickup_location_id", zones, "location_id", None),
            "missing_dropoff_zone_rows": ("dropoff_location_id", zones, "location_id", None),
        },
    )


def daily_snapshot(trips: DataFrame, k: int | None = 31) -> DataFrame:
    days = trips.groupBy("pickup_date").agg(
        F.count("*").alias("trip_count"),
        F.round(money_sum("total_amount"), 2).alias("total_revenue"),
        F.round(F.avg("trip_distance"), 2).alias("avg_trip_distance"),
        F.round(F.avg("trip_duration_minutes"), 2).alias("avg_trip_duration_minutes"),
    )
    ordered = days.orderBy("pickup_date")
    return ordered.limit(k) if k else ordered


def payment_mix_snapshot(trips: DataFrame, k: int = 50) -> DataFrame:
    mix = trips.groupBy("pickup_date", "payment_type_code").agg(
        F.count("*").alias("trip_count"),
        F.round(money_sum("total_amount"), 2).alias("total_revenue"),
    )
    return mix.orderBy("pickup_date", F.desc("trip_count"), "payment_type_code").limit(k)


def _place_totals(fact: DataFrame) -> DataFrame:
    return fact.groupBy("pickup_location_id").agg(
        F.count("*").alias("trip_count"), F.round(money_sum("total_amount"), 2).alias("total_revenue")
    )


def top_pickup_locations(trips: DataFrame, k: int = 15) -> DataFrame:
    return top_by(
        _place_totals(trips), ["trip_count", "total_revenue"], ["pickup_location_id"], k
    )


def top_zones_fact(fact: DataFrame, dim_zone: DataFrame, k: int = 20) -> DataFrame:
    named = left_lookup(
        _place_totals(fact), dim_zone, {"pickup_location_id": "location_id"}, ["borough", "zone"]
    )
    return top_by(named, ["trip_count", "total_revenue"], ["pickup_location_id"], k)


def weather_snapshot(weather: DataFrame, k: int = 31) -> DataFrame:
    names = ["weather_date", "temperature_mean", "precipitation_sum", "snowfall_sum",
             "is_rainy_day", "is_snowy_day"]
    return weather.select(*names).orderBy("weather_date").limit(k)


def zone_snapshot(zones: DataFrame, k: int = 50) -> DataFrame:
    return (
        zones.select("location_id", "borough", "zone", "service_zone")
        .orderBy("location_id")
        .limit(k)
    )


def monthly_revenue(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("pickup_year", "pickup_month")
        .agg(
            F.count("*").alias("trip_count"),
            F.round(money_sum("total_amount"), 2).alias("total_revenue"),
        )
        .orderBy("pickup_year", "pickup_month")
    )


def fact_vs_silver_totals(trips: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows and money of both tables in one row."""

    def totals(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count("*").alias(f"{name}_row_count"),
            F.round(money_sum("total_amount"), 2).alias(f"{name}_total_amount_sum"),
        )

    return side_by_side(totals(trips, "silver_trips"), totals(fact, "fact_trips"))


def except_counts(left: DataFrame, right: DataFrame, key: str, missing: str, unexpected: str):
    """Distinct keys only on the left and only on the right, as EXCEPT both ways counts them.

    Each side is exchanged once, as bytes where keys are hex digits, after its copies are dropped on the map
    side. Null is a key like any other.
    """
    keys = {key: F.col(key)}
    if all(df.schema[key].dataType.simpleString() == "string" for df in (left, right)):
        keys = packed_key(key)
    sides = [df.select(*[c.alias(n) for n, c in keys.items()]) for df in (left, right)]
    return keyset_difference(*sides, list(keys)).select(F.col("only_left").alias(missing), F.col("only_right").alias(unexpected))


def negative_fact_days(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("total_amount") < 0)
        .groupBy("pickup_date")
        .agg(
            F.count("*").alias("negative_total_amount_trip_count"),
            F.round(money_sum("total_amount"), 2).alias("negative_total_amount_sum"),
        )
        .orderBy("pickup_date")
    )


def negative_mart_days(demand: DataFrame) -> DataFrame:
    return (
        demand.filter(F.col("negative_total_amount_trip_count") > 0)
        .select("pickup_date", "negative_total_amount_trip_count", "total_revenue")
        .orderBy("pickup_date")
    )


# -- serving ---------------------------------------------------------------------------------


def mart_conditions(name: str) -> dict[str, Column]:
    """Everything counted for one mart: nulls, date parts, ranges, blanks."""
    out = null_conditions(S.REQUIRED[name])
    parts = K.derived_part_conditions()
    out.update({n: parts[n] for n in ("bad_pickup_year_rows", "bad_pickup_month_rows")})
    out["non_positive_trip_count_rows"] = F.col("trip_count") <= 0
    if name == "mart_daily_demand":
        out["negative_negative_trip_count_rows"] = F.col("negative_total_amount_trip_count") < 0
    if name == "mart_daily_payment_mix":
        out.update(K.share_range_conditions(tolerance=0))
    if name == "mart_weather_impact":
        out["bad_weather_match_rows"] = K.weather_match_condition()
    if name == "mart_zone_demand":
        out.update(_blank_conditions())
    return out


def mart_quality_profile(marts: Mapping[str, DataFrame]) -> DataFrame:
    return stacked([K.violations(df, n, mart_conditions(n)) for n, df in marts.items()])


def payment_label_listing(mix: DataFrame, k: int = 40) -> DataFrame:
    keys = ["pickup_date", "payment_type_code", "payment_type_name"]
    return (
        mix.groupBy(*keys)
        .agg(F.count("*").alias("row_count"))
        .orderBy("pickup_date", "payment_type_code")
        .limit(k)
    )


# Columns, order and length of the four mart snapshots.
SNAPSHOTS = {
    "mart_daily_demand": (
        ["pickup_date", "trip_count", "total_revenue", "avg_trip_distance",
         "avg_trip_duration_minutes", "negative_total_amount_trip_count"],
        [],
        31,
    ),
    "mart_daily_payment_mix": (
        ["pickup_date", "payment_type_code", "payment_type_name", "trip_count", "total_revenue",
         "payment_trip_share_pct", "payment_revenue_share_pct"],
        ["payment_type_code"],
        50,
    ),
    "mart_weather_impact": (
        ["pickup_date", "is_rainy_day", "is_snowy_day", "temperature_mean", "precipitation_sum",
         "trip_count", "total_revenue", "avg_trip_distance", "avg_trip_duration_minutes",
         "negative_total_amount_trip_count"],
        [],
        31,
    ),
    "mart_zone_demand": (
        ["pickup_date", "pickup_location_id", "borough", "zone", "trip_count", "total_revenue",
         "negative_total_amount_trip_count"],
        ["pickup_location_id"],
        50,
    ),
}


def mart_snapshot(mart: DataFrame, name: str, k: int | None = None) -> DataFrame:
    """First rows by date; within a date the busiest first, then the rest of the key."""
    columns, rest, default = SNAPSHOTS[name]
    order = ["pickup_date", *([F.desc("trip_count")] if rest else []), *rest]
    return mart.select(*columns).orderBy(*order).limit(k or default)


def mart_snapshots(marts: Mapping[str, DataFrame]) -> DataFrame:
    return stacked(
        [
            mart_snapshot(df, n).withColumn("dataset_name", F.lit(n))
            for n, df in marts.items()
        ]
    )


def top_zones_mart(zone_mart: DataFrame, k: int = 20) -> DataFrame:
    totals = zone_mart.groupBy("pickup_location_id", "borough", "zone").agg(
        F.sum("trip_count").alias("trip_count"),
        F.round(money_sum("total_revenue"), 2).alias("total_revenue"),
        F.sum("negative_total_amount_trip_count").alias("negative_total_amount_trip_count"),
    )
    return top_by(totals, ["trip_count", "total_revenue"], ["pickup_location_id"], k)


# -- description -----------------------------------------------------------------------------


def describe_schema(df: DataFrame, dataset: str) -> DataFrame:
    """Columns in order with type and number of filled rows."""
    row = df.agg(*[F.count(c).alias(c) for c in df.columns])
    entries = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f.name).alias("filled_rows"),
        )
        for i, f in enumerate(df.schema, 1)
    ]
    return row.select(F.inline(F.array(*entries)))


def dataset_overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and schema text per table."""
    return stacked(
        [
            df.agg(
                F.lit(name).alias("dataset_name"),
                F.count("*").alias("row_count"),
                F.lit(len(df.columns)).alias("column_count"),
                F.lit(",".join(df.columns)).alias("columns"),
                F.lit(df.schema.simpleString()).alias("schema"),
            )
            for name, df in tables.items()
        ]
    )


def layer_overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``overview`` with each layer table's own date column."""
    days = {
        "silver_trips": "pickup_date", "silver_weather": "weather_date", "dim_date": "date_day",
        "dim_weather": "weather_date", "fact_trips": "pickup_date",
    }
    return overview(
        {
            n: (df, days.get(n) or ("pickup_date" if n.startswith("mart_") else None))
            for n, df in tables.items()
        }
    ).orderBy("dataset_name")
