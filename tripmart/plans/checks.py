"""Data-quality checks as DataFrames.

A check returns rows ``(dataset, check_name, severity, violations)`` or the offending rows.  All
conditions on one table are counted in one pass.  ``enforce`` is the only place that collects, and
only the handful of failed checks.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.schemas import Contract
from tripmart.functions import parsing
from tripmart.functions.keys import payment_code, payment_label
from tripmart.operators.aggregates import (
    duplicate_groups,
    money_of,
    money_rest,
    money_sum,
    money_units,
    null_conditions,
    profile,
    row_counts,
    side_by_side,
    stacked,
)
from tripmart.operators.lookups import (
    any_of,
    differing,
    full_outer_mismatches,
    keyset_differences,
    left_lookup,
    unmatched_counts,
)

ERROR, WARN = "error", "warn"
log = logging.getLogger(__name__)


class CheckFailed(ValueError):
    """Raised by ``enforce``; the message lists every failed check."""


def enforce(report: DataFrame) -> list[str]:
    """Raise on error rows with violations; log and return the warnings."""
    failed = report.filter(F.col("violations") > 0).collect()
    lines = {r: f"[{r.dataset}] {r.check_name}: {r.violations}" for r in failed}
    errors = [text for r, text in lines.items() if r.severity == ERROR]
    warnings = [text for r, text in lines.items() if r.severity != ERROR]
    for text in warnings:
        log.warning(text)
    if errors:
        raise CheckFailed("; ".join(errors))
    return warnings


def as_report(row: DataFrame, dataset: str, severity: str | Mapping[str, str] = ERROR) -> DataFrame:
    """A one-row frame of named counts as one report row per count."""
    level = severity if isinstance(severity, Mapping) else dict.fromkeys(row.columns, severity)
    entries = [
        F.struct(
            F.lit(dataset).alias("dataset"),
            F.lit(n).alias("check_name"),
            F.lit(level.get(n, ERROR)).alias("severity"),
            F.col(n).cast("bigint").alias("violations"),
        )
        for n in row.columns
    ]
    return row.select(F.inline(F.array(*entries)))


def violations(
    df: DataFrame, dataset: str, conditions: Mapping[str, Column], severity: str = ERROR
) -> DataFrame:
    return as_report(profile(df, conditions), dataset, severity)


# -- presence, shape, counts -----------------------------------------------------------------


def non_empty(df: DataFrame, dataset: str) -> DataFrame:
    """Stops at the first row."""
    found = df.select(F.lit(1).alias("row")).limit(1).agg(F.count("*").alias("n"))
    return as_report(found.select((1 - F.col("n")).alias("is_empty")), dataset)


def column_differences(
    found: Mapping[str, str], contract: Contract
) -> tuple[list[str], list[str], list[str]]:
    """Missing, unexpected and otherwise typed columns; order does not matter."""
    wanted = {n: simple_type(t) for n, t in contract.types.items()}
    mistyped = [n for n in wanted.keys() & found.keys() if wanted[n] != simple_type(found[n])]
    return sorted(wanted.keys() - found), sorted(found.keys() - wanted), sorted(mistyped)


def simple_type(name: str) -> str:
    return {"integer": "int", "long": "bigint"}.get(name.lower(), name.lower())


def stored_columns(spark: SparkSession, path: str) -> dict[str, str]:
    """Names and types in the files of a folder, whatever its contract says.

    Columns of all files are merged; a column with several types has all of them in its type's place.
    """
    try:
        return dict(spark.read.option("mergeSchema", True).parquet(path).dtypes)
    except Exception as e:  # the error of differing types has no class of its own
        if "CANNOT_MERGE" not in str(e):
            raise
    types: dict[str, set[str]] = {}
    for columns in stored_schemas(spark, file_paths(spark, path)).values():
        for name, kind in columns.items():
            types.setdefault(name, set()).add(kind)
    return {name: "|".join(sorted(kinds)) for name, kinds in types.items()}


def file_paths(spark: SparkSession, path: str) -> list[str]:
    """Parquet files below a folder, by name; for folders known to be small or at fault."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    found = listing.option("pathGlobFilter", "*.parquet").load(path).select("path").distinct()
    return sorted(r.path for r in found.collect())


def stored_schemas(spark: SparkSession, folders: Sequence[str]) -> dict[str, dict[str, str]]:
    """Columns by folder, from the footer of one file in each; partition columns are not among them.

    Files of one write have one schema, so a folder that was written at once needs no more. Footers
    are fetched by the driver, eight at a time, as many as there are partitions.
    """
    folders = list(dict.fromkeys(folders))

    def columns(folder: str) -> dict[str, str]:
        return dict(spark.read.parquet(folder).dtypes)

    with ThreadPool(8) as pool:
        return dict(zip(folders, pool.map(columns, folders), strict=True))


def by_folder(
    found: Mapping[str, str] | Mapping[str, Mapping[str, str]], contract: Contract, partition_by: Sequence[str]
) -> dict[str, tuple[list[str], list[str], list[str]]]:
    """``column_differences`` by folder; partition columns are in the folders' names."""
    each = found if any(isinstance(v, Mapping) for v in found.values()) else {"": found}
    inside = {n: contract.types[n] for n in partition_by if n in contract.types}
    return {
        path: column_differences({**(inside if path else {}), **columns}, contract)
        for path, columns in each.items()
    }


def any_differences(found: Mapping, dataset: str) -> bool:
    return any(map(any, by_folder(found, S.CONTRACTS[dataset], S.PARTITIONS.get(dataset, ())).values()))


def columns_match(
    spark: SparkSession,
    found: Mapping[str, str] | Mapping[str, Mapping[str, str]],
    dataset: str,
    contract: Contract,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Columns found in a table against its contract, with the names at fault; no row is read.

    ``found`` is one schema, or a schema for each folder. Folders are compared one by one; every
    deviating folder gives a row with its path, and a table without any one row without violations.
    """
    rows = [
        (dataset, "columns_match", ERROR, sum(map(len, differences)), *map(",".join, differences), path)
        for path, differences in by_folder(found, contract, partition_by).items()
        if any(differences)
    ]
    return spark.createDataFrame(
        rows or [(dataset, "columns_match", ERROR, 0, "", "", "", "")],
        "dataset string, check_name string, severity string, violations bigint, missing_columns string,"
        " unexpected_columns string, mistyped_columns string, path string",
    )


def _counts(
    source: DataFrame | int, target: DataFrame | int, names: tuple[str, str], spark: SparkSession | None
) -> DataFrame:
    """One row with both counts; those given as numbers come from a table's commit."""
    sides = dict(zip(names, (source, target), strict=True))
    frames = {n: x for n, x in sides.items() if not isinstance(x, int)}
    row = row_counts(frames) if frames else spark.range(1)
    return row.select(*[F.col(n) if n in frames else F.lit(sides[n]).cast("bigint").alias(n) for n in names])


def rowcount_relation(
    source: DataFrame | int,
    target: DataFrame | int,
    dataset: str,
    may_shrink: bool = True,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Target rows above source rows is an error; below is a warning, or an error if not allowed.

    Either side may be a count that a table's commit has; ``spark`` is needed if both are.
    """
    counts = _counts(source, target, ("source_rows", "target_rows"), spark)
    grown = F.greatest(F.col("target_rows") - F.col("source_rows"), F.lit(0))
    shrunk = F.greatest(F.col("source_rows") - F.col("target_rows"), F.lit(0))
    row = counts.select(
        grown.alias("target_above_source"), shrunk.alias("target_below_source")
    )
    return as_report(row, dataset, {"target_below_source": WARN if may_shrink else ERROR})


def rowcount_exact(
    left: DataFrame | int, right: DataFrame | int, dataset: str, spark: SparkSession | None = None
) -> DataFrame:
    counts = _counts(left, right, ("left_rows", "right_rows"), spark)
    return as_report(
        counts.select(F.abs(F.col("left_rows") - F.col("right_rows")).alias("rowcount_differs")),
        dataset,
    )


def unique_key(df: DataFrame, dataset: str, keys: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once."""
    row = duplicate_groups(df, keys).agg(F.count("*").alias("duplicate_" + "_".join(keys)))
    return as_report(row, dataset)


def required_columns(df: DataFrame, dataset: str, names: Sequence[str] | None = None) -> DataFrame:
    return violations(df, dataset, null_conditions(names or S.REQUIRED[dataset]))


def blank_text(
    df: DataFrame, dataset: str, names: Sequence[str], null_is_blank: bool = False
) -> DataFrame:
    conditions = {
        f"blank_{n}_rows": parsing.is_blank(F.col(n), null_is_blank) for n in names
    }
    return violations(df, dataset, conditions)


# -- row logic -------------------------------------------------------------------------------


def time_order_conditions() -> dict[str, Column]:
    return {
        "bad_time_order_rows": F.col("pickup_datetime") >= F.col("dropoff_datetime"),
        "non_positive_duration_rows": F.col("trip_duration_minutes") <= 0,
    }


def derived_part_conditions() -> dict[str, Column]:
    return {
        "bad_pickup_year_rows": F.col("pickup_year") != F.year("pickup_date"),
        "bad_pickup_month_rows": F.col("pickup_month") != F.month("pickup_date"),
        "bad_pickup_hour_rows": F.col("pickup_hour") != F.hour("pickup_datetime"),
    }


def weather_match_condition() -> Column:
    return F.col("pickup_date") != F.col("weather_date")


def date_logic_conditions() -> dict[str, Column]:
    day = F.col("date_day")
    return {
        "bad_year_num_rows": F.col("year_num") != F.year(day),
        "bad_quarter_num_rows": F.col("quarter_num") != F.quarter(day),
        "bad_month_num_rows": F.col("month_num") != F.month(day),
        "bad_day_num_rows": F.col("day_num_in_month") != F.dayofmonth(day),
        "bad_day_of_week_rows": F.col("day_of_week_num") != F.dayofweek(day),
        "bad_weekend_rows": F.col("is_weekend") != F.col("day_of_week_num").isin(1, 7),
    }


def flag_conditions() -> dict[str, Column]:
    """Flag and amount must agree, each way, for rain and snow."""
    out = {}
    for name, amount, flag in (
        ("rain", "precipitation_sum", "is_rainy_day"),
        ("snow", "snowfall_sum", "is_snowy_day"),
    ):
        out[f"bad_{name}_flag_rows"] = (F.col(amount) > 0) & ~F.col(flag)
        out[f"bad_non_{name}_flag_rows"] = (F.col(amount) <= 0) & F.col(flag)
    return out


def negative_conditions(columns: Sequence[str], suffix: str = "_rows") -> dict[str, Column]:
    return {f"negative_{c}{suffix}": F.col(c) < 0 for c in columns}


def time_order(df: DataFrame, dataset: str) -> DataFrame:
    return violations(df, dataset, time_order_conditions())


def derived_parts(df: DataFrame, dataset: str) -> DataFrame:
    return violations(df, dataset, derived_part_conditions())


def dim_date_coverage(dim_date: DataFrame, trips: DataFrame) -> DataFrame:
    """Rows of the dimension against the distinct trip dates."""
    days = trips.select("pickup_date").filter(F.col("pickup_date").isNotNull()).distinct()
    return rowcount_exact(days, dim_date, "dim_date")


# -- keys between tables ---------------------------------------------------------------------


def same_keys(
    left: DataFrame, right: DataFrame, dataset: str, keys: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """Keys on one side only; equal tables are told by their digests, without an exchange of keys."""
    row = keyset_differences(left, right, keys, within)
    return as_report(
        row.select(F.col("only_left").alias("missing_keys"), F.col("only_right").alias("unexpected_keys")), dataset
    )


def fk_coverage(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_zone: DataFrame,
    dim_weather: DataFrame,
    row_bound: int | None = None,
) -> DataFrame:
    """One row: fact rows without a partner in each of the four dimension roles."""
    return unmatched_counts(
        fact,
        {
            "missing_dim_date_rows": ("pickup_date", dim_date, "date_day", row_bound),
            "missing_pickup_dim_zone_rows": ("pickup_location_id", dim_zone, "location_id", None),
            "missing_dropoff_dim_zone_rows": ("dropoff_location_id", dim_zone, "location_id", None),
            "missing_dim_weather_rows": ("weather_date", dim_weather, "weather_date", row_bound),
        },
    )


def partition_folders(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Partitions in the data next to the folders its files lie in, one row per partition."""
    per_file = stored.groupBy(*columns, F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("n")
    )
    folder = [F.regexp_extract("path", f"/{c}=([^/]+)/", 1) for c in columns]
    return (
        per_file.groupBy(*columns, F.concat_ws("/", *folder).alias("folder"))
        .agg(F.sum("n").alias("row_count"))
        .withColumn(
            "in_own_folder",
            F.col("folder") == F.concat_ws("/", *[F.col(c).cast("string") for c in columns]),
        )
    )


def partition_coverage(stored: DataFrame, dataset: str, columns: Sequence[str]) -> DataFrame:
    """No partitions at all, or rows lying outside their partition's folder, are errors."""
    parts = partition_folders(stored, columns)
    row = parts.agg(
        F.when(F.count("*") == 0, 1).otherwise(0).alias("no_partitions"),
        F.coalesce(F.sum(F.when(~F.col("in_own_folder"), F.col("row_count"))), F.lit(0)).alias(
            "rows_outside_folder"
        ),
    )
    return as_report(row, dataset)


# -- marts against dimensions and fact -------------------------------------------------------


def described_differently(
    mart: DataFrame,
    tables: Sequence[tuple[DataFrame, str, str, Sequence[str]]],
    also: Sequence[Column] = (),
    null_safe: bool = False,
    row_bound: int | None = None,
) -> DataFrame:
    """Mart rows with no partner in a table, or with a description differing from it.

    ``tables`` holds (table, mart column, table key, described columns).  By default a null
    description passes, as comparison with null is not true; ``null_safe`` reports it.
    """
    joined, bad = mart, list(also)
    for i, (table, column, key, names) in enumerate(tables):
        found = {f"_found{i}": key, **{f"_{i}_{n}": n for n in names}}
        joined = left_lookup(joined, table, {column: key}, found, row_bound)
        bad.append(F.col(f"_found{i}").isNull())
        bad += [differing(F.col(n), F.col(f"_{i}_{n}"), null_safe) for n in names]
    return joined.filter(any_of(bad)).select(*mart.columns)


DEMAND_DESCRIPTION = ["quarter_num", "month_name", "day_num_in_month", "day_of_week_num",
                      "day_of_week_name", "is_weekend"]
WEEKDAY_DESCRIPTION = ["day_of_week_num", "day_of_week_name", "is_weekend"]
WEATHER_DESCRIPTION = ["is_rainy_day", "is_snowy_day", "temperature_max", "temperature_min",
                       "temperature_mean", "precipitation_sum", "snowfall_sum"]
ZONE_DESCRIPTION = ["borough", "zone", "service_zone"]


def demand_vs_dim_date(
    mart: DataFrame, dim_date: DataFrame, null_safe: bool = False, row_bound: int | None = None
) -> DataFrame:
    tables = [(dim_date, "pickup_date", "date_day", DEMAND_DESCRIPTION)]
    return described_differently(mart, tables, null_safe=null_safe, row_bound=row_bound)


def weather_vs_dims(
    mart: DataFrame,
    dim_date: DataFrame,
    dim_weather: DataFrame,
    null_safe: bool = False,
    row_bound: int | None = None,
) -> DataFrame:
    tables = [
        (dim_date, "pickup_date", "date_day", WEEKDAY_DESCRIPTION),
        (dim_weather, "weather_date", "weather_date", WEATHER_DESCRIPTION),
    ]
    apart = [weather_match_condition()]
    return described_differently(mart, tables, apart, null_safe, row_bound)


def zone_vs_dim_zone(mart: DataFrame, dim_zone: DataFrame, null_safe: bool = False) -> DataFrame:
    tables = [(dim_zone, "pickup_location_id", "location_id", ZONE_DESCRIPTION)]
    return described_differently(mart, tables, null_safe=null_safe)


def money_differs(left: Column, right: Column) -> Column:
    """Off by a cent or more, whatever the amount; meant for sums by ``money_sum``, which do not drift."""
    return differing(left, right, tolerance=S.MONEY_DRIFT)


def reconcile_mart(
    mart: DataFrame, fact: DataFrame, grain: Sequence[str], negatives: bool = True
) -> DataFrame:
    """One row comparing a mart with the fact it came from: rows, trips, revenue, negatives.

    The fact is reduced to the grain first, so its row count and the number of groups come out of
    one scan.
    """
    if "payment_type_code" in grain:
        fact = fact.withColumn("payment_type_code", payment_code(F.col("payment_type_code")))
    per_group = fact.groupBy(*grain).agg(
        F.count("*").alias("n"),
        money_units("total_amount").alias("units"),
        money_rest("total_amount").alias("rest"),
        F.count_if(F.col("total_amount") < 0).alias("negative"),
    )
    zero = F.lit(0)
    expected = per_group.agg(
        F.count("*").alias("expected_rows"),
        F.coalesce(F.sum("n"), zero).alias("fact_rows"),
        F.coalesce(money_of(F.sum("units"), F.sum("rest")), F.lit(0.0)).alias("fact_total_amount"),
        *([F.coalesce(F.sum("negative"), zero).alias("fact_negatives")] if negatives else []),
    )
    found = mart.agg(
        F.count("*").alias("mart_rows"),
        F.coalesce(F.sum("trip_count"), zero).alias("mart_trips"),
        F.coalesce(money_sum("total_revenue"), F.lit(0.0)).alias("mart_revenue"),
        *(
            [F.coalesce(F.sum("negative_total_amount_trip_count"), zero).alias("mart_negatives")]
            if negatives
            else []
        ),
    )
    row = side_by_side(found, expected)
    exact = [("mart_rows", "expected_rows"), ("mart_trips", "fact_rows")]
    exact += [("mart_negatives", "fact_negatives")] if negatives else []
    bad = [F.col(a) != F.col(b) for a, b in exact]
    bad.append(money_differs(F.col("mart_revenue"), F.col("fact_total_amount")))
    failed = sum((b.cast("int") for b in bad[1:]), bad[0].cast("int"))
    return row.withColumn("violations", failed)


def label_mismatches(mix: DataFrame) -> DataFrame:
    return mix.filter(F.col("payment_type_name") != payment_label(F.col("payment_type_code")))


def day_share_sums(mix: DataFrame) -> DataFrame:
    return mix.groupBy("pickup_date").agg(
        F.sum("payment_trip_share_pct").alias("trip_share_sum"),
        F.sum("payment_revenue_share_pct").alias("revenue_share_sum"),
        money_sum("total_revenue").alias("daily_revenue_sum"),
    )


def share_sum_conditions(tolerance: float = S.SHARE_TOLERANCE) -> dict[str, Column]:
    """On ``day_share_sums``: trip shares must sum to 1; revenue shares too, unless the day's
    revenue is about zero."""
    off = {
        name: F.abs(F.col(f"{name}_sum") - 1.0) > tolerance
        for name in ("trip_share", "revenue_share")
    }
    some_revenue = F.abs(F.col("daily_revenue_sum")) > S.MONEY_TOLERANCE
    return {
        "bad_trip_share_days": off["trip_share"],
        "bad_revenue_share_days": some_revenue & off["revenue_share"],
    }


def share_range_conditions(tolerance: float = S.SHARE_TOLERANCE) -> dict[str, Column]:
    """Shares outside 0..1; a tolerance of 0 is the strict form."""
    return {
        f"out_of_range_{name}_share_rows": (F.col(f"payment_{name}_share_pct") < -tolerance)
        | (F.col(f"payment_{name}_share_pct") > 1 + tolerance)
        for name in ("trip", "revenue")
    }


def share_checks(mix: DataFrame, dataset: str = "mart_daily_payment_mix") -> DataFrame:
    """Trip share range and both day sums are errors; revenue share range only a warning."""
    ranges = as_report(
        profile(mix, share_range_conditions()),
        dataset,
        {"out_of_range_revenue_share_rows": WARN},
    )
    return ranges.unionByName(violations(day_share_sums(mix), dataset, share_sum_conditions()))


def daily_totals(mart: DataFrame, negatives: bool) -> DataFrame:
    """A finer mart rolled up to days."""
    counts = ["trip_count", *(["negative_total_amount_trip_count"] if negatives else [])]
    return mart.groupBy("pickup_date").agg(
        *[F.sum(c).alias(c) for c in counts], money_sum("total_revenue").alias("total_revenue"))


def cross_mart_mismatches(demand: DataFrame, other: DataFrame, negatives: bool = True) -> DataFrame:
    """Days on which two marts disagree on trips, revenue (to a cent) or negative trips."""
    exact = {"trip_count": "trip_count"}
    if negatives:
        exact["negative_total_amount_trip_count"] = "negative_total_amount_trip_count"
    return full_outer_mismatches(
        demand, other, ["pickup_date"], exact, {"total_revenue": "total_revenue"},
        S.MONEY_DRIFT,
    )


# -- suites ----------------------------------------------------------------------------------


def columns_suite(spark: SparkSession, dataset: str, found: Mapping) -> DataFrame:
    """``columns_match`` as report rows, with the folder at fault in the check's name."""
    report = columns_match(spark, found, dataset, S.CONTRACTS[dataset], S.PARTITIONS.get(dataset, ()))
    at_fault = F.concat_ws(" ", "check_name", F.nullif("path", F.lit("")))
    return report.select("dataset", at_fault.alias("check_name"), "severity", "violations")


def row_suite(
    df: DataFrame, dataset: str, rules: Mapping[str, Column] = {}, warnings: Mapping[str, Column] = {}
) -> DataFrame:
    """Rows present, required values and rules, counted in one pass."""
    conditions = {**null_conditions(S.REQUIRED[dataset]), **rules, **warnings}
    empty = (1 - F.least(F.count("*"), F.lit(1))).alias("is_empty")
    row = profile(df, conditions, is_empty=empty)
    return as_report(row, dataset, dict.fromkeys(warnings, WARN))


def contract_suite(
    df: DataFrame,
    dataset: str,
    found: Mapping | None = None,
    rules: Mapping[str, Column] = {},
) -> DataFrame:
    """Columns, rows present, required values, rules and key of a layer table."""
    absent = sorted(set(S.CONTRACTS[dataset].names) - set(df.columns))
    if absent:
        raise CheckFailed(f"[{dataset}] missing columns {absent}")
    # a frame read by contract shows only the contract; ``found`` is what the files hold
    columns = columns_suite(df.sparkSession, dataset, found or dict(df.dtypes))
    parts = [columns, row_suite(df, dataset, rules)]
    if dataset in S.UNIQUE_KEYS:
        parts.append(unique_key(df, dataset, S.UNIQUE_KEYS[dataset]))
    return stacked(parts)


def silver_suite(
    trips: DataFrame,
    bronze: DataFrame,
    found: Mapping | None = None,
    bronze_rows: int | None = None,
    trips_rows: int | None = None,
) -> DataFrame:
    """Row counts are those of the tables' commits where given, else counted."""
    rules = {**time_order_conditions(), **derived_part_conditions()}
    source = bronze if bronze_rows is None else bronze_rows
    target = trips if trips_rows is None else trips_rows
    return stacked(
        [
            contract_suite(trips, "silver_trips", found, rules),
            rowcount_relation(source, target, "silver_trips", spark=trips.sparkSession),
        ]
    )


def trip_key_suite(trips: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows, copies, missing and unexpected trips of the fact, from one exchange of 32-byte keys."""
    side = {True: trips, False: fact}
    keys = stacked(
        [df.select(F.unhex("trip_id").alias("key"), F.lit(s).alias("in_trips")) for s, df in side.items()]
    )
    per_key = keys.groupBy("key").agg(
        F.count_if("in_trips").alias("trips"), F.count_if(~F.col("in_trips")).alias("facts")
    )
    zero = F.lit(0)
    row = per_key.agg(
        F.count_if(F.col("facts") > 1).alias("duplicate_trip_id"),
        F.count_if(F.col("facts") == 0).alias("missing_keys"),
        F.count_if(F.col("trips") == 0).alias("unexpected_keys"),
        F.abs(F.coalesce(F.sum("trips"), zero) - F.coalesce(F.sum("facts"), zero)).alias(
            "rowcount_differs"
        ),
    )
    return as_report(row, "fact_trips")


def fact_suite(
    fact: DataFrame, dim_date: DataFrame, dim_zone: DataFrame, dim_weather: DataFrame
) -> DataFrame:
    """All row rules and the coverage by the dimensions, in one pass over the fact.

    Rules are counted per combination of the dimension keys, which then look up their partners.
    """
    rules = {
        **null_conditions(S.REQUIRED["fact_trips"]),
        **time_order_conditions(),
        **derived_part_conditions(),
        "bad_weather_date_match_rows": weather_match_condition(),
        **negative_conditions(["trip_distance"]),
    }
    warnings = negative_conditions(S.MONEY_COLUMNS)
    lookups = {
        "missing_dim_date_rows": ("pickup_date", dim_date, "date_day", None),
        "missing_pickup_dim_zone_rows": ("pickup_location_id", dim_zone, "location_id", None),
        "missing_dropoff_dim_zone_rows": ("dropoff_location_id", dim_zone, "location_id", None),
        "missing_dim_weather_rows": ("weather_date", dim_weather, "weather_date", None),
    }
    row = unmatched_counts(fact, lookups, {**rules, **warnings}, total="rows")
    row = row.withColumn("is_empty", (F.col("rows") == 0).cast("int")).drop("rows")
    return as_report(row, "fact_trips", dict.fromkeys(warnings, WARN))


def gold_suite(
    fact: DataFrame,
    trips: DataFrame,
    dim_date: DataFrame,
    dim_zone: DataFrame,
    dim_weather: DataFrame,
    found: Mapping[str, Mapping] = {},
) -> DataFrame:
    """The fact is read twice: all columns for its rows, the key for its trips."""
    blanks = {f"blank_{n}_rows": parsing.is_blank(F.col(n), False) for n in ZONE_DESCRIPTION}
    return stacked(
        [
            contract_suite(dim_date, "dim_date", found.get("dim_date"), date_logic_conditions()),
            dim_date_coverage(dim_date, trips),
            contract_suite(dim_zone, "dim_zone", found.get("dim_zone"), blanks),
            contract_suite(dim_weather, "dim_weather", found.get("dim_weather"), flag_conditions()),
            columns_suite(fact.sparkSession, "fact_trips", found.get("fact_trips") or dict(fact.dtypes)),
            fact_suite(fact, dim_date, dim_zone, dim_weather),
            trip_key_suite(trips, fact),
        ]
    )


def marts_vs_fact(marts: Mapping[str, DataFrame], fact: DataFrame) -> DataFrame:
    """Per mart, the groups of its grain that are absent, surplus or sum up differently.

    The fact is reduced once to the finest grain of all marts and rolled up from there. Groups are
    compared one by one, so errors of opposite sign do not cancel.
    """
    coded = fact.withColumn("payment_type_code", payment_code(F.col("payment_type_code")))
    keys = list(dict.fromkeys(k for name in marts for k in S.UNIQUE_KEYS[name]))
    measures = ["trips", "money", "negative"]
    finest = coded.groupBy(*keys).agg(
        F.count("*").alias("trips"),
        money_units("total_amount").alias("units"),
        money_rest("total_amount").alias("rest"),
        F.count_if(F.col("total_amount") < 0).alias("negative"),
    )
    # one bit per key, the first key in the highest place; a set bit is a key summed over
    number = {
        name: sum(
            1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in S.UNIQUE_KEYS[name]
        )
        for name in marts
    }
    grains = {number[name]: [F.col(k) for k in S.UNIQUE_KEYS[name]] for name in marts}
    of_grain = [
        F.when(F.col("grain") == g, F.array(*[F.lit(n) for n in marts if number[n] == g]))
        for g in grains
    ]
    rolled = finest.groupingSets(list(grains.values()), *keys).agg(
        F.grouping_id(*[F.col(k) for k in keys]).alias("grain"),
        F.sum("trips").alias("trips"),
        money_of(F.sum("units"), F.sum("rest")).alias("money"),
        F.sum("negative").alias("negative"),
    )
    parts = [
        rolled.select(
            F.explode(F.coalesce(*of_grain)).alias("mart"), *keys, *measures, F.lit(True).alias("expected")
        )
    ]
    for name, mart in marts.items():
        negative = "negative_total_amount_trip_count"
        parts.append(
            mart.select(
                F.lit(name).alias("mart"),
                *[
                    F.col(k) if k in S.UNIQUE_KEYS[name]
                    else F.lit(None).cast(coded.schema[k].dataType).alias(k)
                    for k in keys
                ],
                F.col("trip_count").alias("trips"),
                F.col("total_revenue").alias("money"),
                F.col(negative).alias("negative")
                if negative in mart.columns
                else F.lit(None).cast("bigint").alias("negative"),
                F.lit(False).alias("expected"),
            )
        )
    sides = {"want": F.col("expected"), "got": ~F.col("expected")}
    both = stacked(parts).groupBy("mart", *keys).agg(
        *[F.count_if(on).alias(side) for side, on in sides.items()],
        *[F.sum(F.when(on, F.col(m))).alias(f"{side}_{m}") for side, on in sides.items() for m in measures],
    )
    bad = any_of(
        [
            F.col("want") != 1,
            F.col("got") != 1,
            F.col("want_trips") != F.col("got_trips"),
            F.col("want_negative") != F.col("got_negative"),
            money_differs(F.col("want_money"), F.col("got_money")),
        ]
    )
    names = list(marts)
    row = both.agg(*[
        F.count_if(bad & (F.col("mart") == name)).alias(name) for name in names
    ])
    entries = [
        F.struct(F.lit(n).alias("dataset"), F.lit("differs_from_fact").alias("check_name"),
                 F.lit(ERROR).alias("severity"), F.col(n).cast("bigint").alias("violations"))
        for n in names
    ]
    return row.select(F.inline(F.array(*entries)))


def serving_suite(
    marts: Mapping[str, DataFrame],
    fact: DataFrame,
    dim_date: DataFrame,
    dim_zone: DataFrame,
    dim_weather: DataFrame,
    found: Mapping[str, Mapping] = {},
) -> DataFrame:
    def counted(rows: DataFrame, dataset: str, name: str) -> DataFrame:
        return as_report(rows.agg(F.count("*").alias(name)), dataset)

    demand, mix = marts["mart_daily_demand"], marts["mart_daily_payment_mix"]
    weather, zone = marts["mart_weather_impact"], marts["mart_zone_demand"]
    parts = [contract_suite(df, name, found.get(name)) for name, df in marts.items()]
    parts += [
        marts_vs_fact(marts, fact),
        counted(demand_vs_dim_date(demand, dim_date), "mart_daily_demand", "date_mismatch"),
        counted(
            weather_vs_dims(weather, dim_date, dim_weather),
            "mart_weather_impact",
            "descriptor_mismatch",
        ),
        counted(zone_vs_dim_zone(zone, dim_zone), "mart_zone_demand", "zone_mismatch"),
        blank_text(zone, "mart_zone_demand", ZONE_DESCRIPTION),
        counted(label_mismatches(mix), "mart_daily_payment_mix", "label_mismatch"),
        share_checks(mix),
    ]
    return stacked(parts)
