"""Silver to gold: date, zone and weather dimensions and the trip fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions.calendar import calendar_attributes
from tripmart.operators.columns import fill_zero
from tripmart.operators.dedupe import dedupe_by_key
from tripmart.operators.lookups import left_lookup
from tripmart.sources.scope import Scope


def dim_date(trips: DataFrame) -> DataFrame:
    """The dates that occur, not a full calendar.

    Copies of a trip share its date, so trips from before or after deduplication give the same
    dimension; passing ``clean_trips`` avoids their shuffle.
    """
    days = (
        trips.select(F.col("pickup_date").alias("date_day"))
        .filter(F.col("date_day").isNotNull())
        .distinct()
    )
    return days.withColumns(calendar_attributes(F.col("date_day"))).select(
        *S.DIM_DATE.names[:-1], F.current_timestamp().alias("gold_loaded_at")
    )


def dim_zone(zones: DataFrame) -> DataFrame:
    texts = ["borough", "zone", "service_zone"]
    keyed = zones.select("location_id", *[F.trim(t).alias(t) for t in texts]).filter(
        F.col("location_id").isNotNull()
    )
    return dedupe_by_key(keyed, ["location_id"], texts).withColumn(
        "gold_loaded_at", F.current_timestamp()
    )


def dim_weather(weather: DataFrame) -> DataFrame:
    keyed = weather.select(*S.DIM_WEATHER.names[:-1]).filter(F.col("weather_date").isNotNull())
    return dedupe_by_key(keyed, ["weather_date"]).withColumn(
        "gold_loaded_at", F.current_timestamp()
    )


def fact_trips(
    trips: DataFrame, weather: DataFrame, scope: Scope | None = None, unique: bool = True
) -> DataFrame:
    """Trip fact with the weather date it matched, optional amounts filled with 0.0.

    Left joins to the date and zone dimensions would add no column and, their keys being unique,
    no row, so only weather is joined; ``unmatched_counts`` reports coverage of all four.  Within
    a scope weather holds at most one row per day, which proves the broadcast small.  Set
    ``unique=False`` when ``trips`` or ``weather`` may hold a key twice.
    """
    bound = None
    if scope:
        weather = weather.filter(scope.has_day(F.col("weather_date")))
        bound = scope.days
    if not unique:
        weather = weather.select("weather_date").distinct()
    found = left_lookup(
        trips, weather, {"pickup_date": "weather_date"}, ["weather_date"], row_bound=bound
    )
    fact = fill_zero(found, S.OPTIONAL_AMOUNTS)
    if not unique:
        fact = dedupe_by_key(fact.select(*S.FACT_TRIPS.names[:-1]), ["trip_id"])
    return fact.withColumn("gold_loaded_at", F.current_timestamp()).select(*S.FACT_TRIPS.names)
