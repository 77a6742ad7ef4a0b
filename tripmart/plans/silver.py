"""Bronze to silver: business names, narrow types, derived columns, one row per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions.calendar import minutes_between
from tripmart.functions.keys import surrogate_key
from tripmart.operators.columns import retype
from tripmart.operators.dedupe import dedupe_by_key
from tripmart.sources.scope import Scope

LINEAGE = ["source_file", "bronze_loaded_at"]
DERIVED = ["trip_id", "pickup_year", "pickup_month", "pickup_hour", "trip_duration_minutes"]

# What copies of one trip may differ in; decides which copy stays.
TIE_BREAK = [
    c
    for c in S.SILVER_TRIPS.names
    if c not in [*S.TRIP_KEY, *DERIVED, *LINEAGE, "pickup_date", "silver_loaded_at"]
]


def trip_quality() -> Column:
    """Both times, both places and a date present; pickup before dropoff; positive duration.

    Null comparisons are false in a filter, so the order test also demands both times; they are
    spelled out so that the scan can skip on them.
    """
    return F.expr("""
        pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND pickup_date IS NOT NULL
        AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL
        AND pickup_datetime < dropoff_datetime AND trip_duration_minutes > 0
    """)


def rename_trips(bronze: DataFrame) -> DataFrame:
    return bronze.withColumnsRenamed(S.TRIP_RENAMES)


def narrow_trips(renamed: DataFrame) -> DataFrame:
    have = set(renamed.columns) - set(LINEAGE)
    return retype(renamed, {n: t for n, t in S.SILVER_TRIPS.types.items() if n in have})


def derive_trip_columns(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {
            "store_and_fwd_flag": F.trim("store_and_fwd_flag"),
            "pickup_year": F.year("pickup_date"),
            "pickup_month": F.month("pickup_date"),
            "pickup_hour": F.hour("pickup_datetime"),
            "trip_duration_minutes": minutes_between(
                F.col("pickup_datetime"), F.col("dropoff_datetime")
            ),
        }
    )


def clean_trips(bronze: DataFrame, scope: Scope | None) -> DataFrame:
    """Valid, keyed trips of the scope, copies still in.

    The scope is tested on the bronze partition columns (prunes folders), on the pickup time
    (skips row groups) and on the date, which alone decides.
    """
    if scope:
        bronze = bronze.filter(
            scope.has_month(F.col("pickup_year"), F.col("pickup_month"))
            & scope.has_time(F.col("tpep_pickup_datetime"))
            & scope.has_day(F.col("pickup_date"))
        )
    trips = derive_trip_columns(narrow_trips(rename_trips(bronze))).filter(trip_quality())
    return trips.withColumn("trip_id", surrogate_key(S.TRIP_KEY))


def silver_trips(
    bronze: DataFrame,
    scope: Scope | None = None,
    lineage: bool = True,
    unique_rows: Callable[..., DataFrame] = dedupe_by_key,
    spread: bool = False,
) -> DataFrame:
    """One row per trip key.

    This is the one place where whole trip rows are shuffled: with ``trip_id`` as the 32 bytes that its
    64 digits stand for, which no codec makes smaller, and without the columns that follow from others.
    ``lineage=False`` leaves out the file path and load time, which plans that go straight on to the
    fact do not need.  From a stored ``bronze`` with few copies ``unique_rows=dedupe_few_copies``
    shuffles the copies only.  ``spread=True`` rebalances the months for a partitioned write while the
    rows are still narrow: no id is shuffled then, copies are found by what it is made of, and it is worked
    out after both shuffles.
    """
    extra = ["source_file"] if lineage else []
    carried = [*S.TRIP_KEY, "pickup_date", *TIE_BREAK, *(LINEAGE if lineage else [])]
    trips = clean_trips(bronze, scope)
    if spread:
        texts = [c for c in S.TRIP_KEY if S.SILVER_TRIPS.types[c] == "double"]
        # as in the id: 0.0 and -0.0 are two values; the text of a double reads back as the same one
        narrow = trips.select(*carried).withColumns({c: F.col(c).cast("string") for c in texts})
        grain = sorted(S.TRIP_KEY, key=lambda c: c not in texts[::-1][:1])  # sorts by few equal values first
        unique = unique_rows(narrow, grain, [*TIE_BREAK, *extra])
        unique = unique.withColumns({c: F.col(c).cast("double") for c in texts})
        months = {"pickup_year": F.year("pickup_date"), "pickup_month": F.month("pickup_date")}
        unique = unique.withColumns(months).hint("rebalance", *months)
        digits = surrogate_key(S.TRIP_KEY)
    else:
        packed = trips.withColumn("trip_id", F.unhex("trip_id")).select("trip_id", *carried)
        unique = unique_rows(packed, ["trip_id"], [*TIE_BREAK, *extra])
        digits = F.lower(F.hex("trip_id"))
    keyed = derive_trip_columns(unique).withColumn("trip_id", digits)
    names = [n for n in S.SILVER_TRIPS.names if lineage or n not in LINEAGE]
    return keyed.withColumn("silver_loaded_at", F.current_timestamp()).select(*names)


def silver_weather(bronze: DataFrame) -> DataFrame:
    """One row per date; a flag stays null where its amount is null."""
    days = bronze.withColumnsRenamed(S.WEATHER_RENAMES).filter(F.col("weather_date").isNotNull())
    measures = [*S.WEATHER_RAW.without("date").names, "source_file"]
    order = [S.WEATHER_RENAMES.get(m, m) for m in measures]
    return (
        dedupe_by_key(days, ["weather_date"], order)
        .withColumns(
            {
                "is_rainy_day": F.col("precipitation_sum") > 0,
                "is_snowy_day": F.col("snowfall_sum") > 0,
                "silver_loaded_at": F.current_timestamp(),
            }
        )
        .select(*S.SILVER_WEATHER.names)
    )


def silver_zones(bronze: DataFrame) -> DataFrame:
    """One row per location; of several names the first in text order stays."""
    texts = ["borough", "zone", "service_zone"]
    zones = bronze.filter(F.col("location_id").isNotNull()).withColumns(
        {t: F.trim(t) for t in texts}
    )
    return (
        dedupe_by_key(zones, ["location_id"], [*texts, "source_file"])
        .withColumn("silver_loaded_at", F.current_timestamp())
        .select(*S.SILVER_ZONES.names)
    )
