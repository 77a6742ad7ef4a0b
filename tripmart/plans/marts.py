"""Gold to serving: four daily marts.

Each mart first reduces the fact to its grain (partial aggregation on the map side, so a busy day
or zone is no hot spot) and only then looks up descriptions, which do not vary within a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions.calendar import calendar_attributes
from tripmart.functions.keys import payment_code, payment_label
from tripmart.operators.aggregates import money_sum, share_of_total
from tripmart.operators.lookups import left_lookup
from tripmart.schemas import Contract

DAY = ["pickup_date", "pickup_year", "pickup_month"]

# The fact column behind each total and average.
TOTALS = {
    "total_passenger_count": "passenger_count",
    "total_trip_distance": "trip_distance",
    "total_trip_duration_minutes": "trip_duration_minutes",
}
MONEY_TOTALS = {
    "total_revenue": "total_amount",
    "total_fare_amount": "fare_amount",
    "total_tip_amount": "tip_amount",
    "total_tolls_amount": "tolls_amount",
}
AVERAGES = {
    "avg_trip_distance": "trip_distance",
    "avg_trip_duration_minutes": "trip_duration_minutes",
    "avg_total_amount": "total_amount",
    "avg_fare_amount": "fare_amount",
    "avg_tip_amount": "tip_amount",
}


def _measures(contract: Contract) -> list[Column]:
    """Aggregates for the measure columns a mart's contract names; money is summed exactly."""
    known = {
        "trip_count": F.count("*"),
        "negative_total_amount_trip_count": F.count_if(F.col("total_amount") < 0),
        **{name: F.sum(column) for name, column in TOTALS.items()},
        **{name: money_sum(column) for name, column in MONEY_TOTALS.items()},
        **{name: F.avg(column) for name, column in AVERAGES.items()},
    }
    return [known[n].alias(n) for n in contract.names if n in known]


def _serve(df: DataFrame, contract: Contract) -> DataFrame:
    return df.withColumn("serving_loaded_at", F.current_timestamp()).select(*contract.names)


def _with_calendar(
    days: DataFrame, dim_date: DataFrame | None, names: Sequence[str], row_bound: int | None
) -> DataFrame:
    """Calendar columns from the date dimension, or computed when none is given.

    The dimension is a function of the date alone, so both give the same for every date in it.
    """
    if dim_date is None:
        attributes = calendar_attributes(F.col("pickup_date"))
        return days.withColumns({n: attributes[n] for n in names})
    return left_lookup(days, dim_date, {"pickup_date": "date_day"}, names, row_bound)


def mart_daily_demand(
    fact: DataFrame, dim_date: DataFrame | None = None, row_bound: int | None = None
) -> DataFrame:
    days = fact.groupBy(*DAY).agg(*_measures(S.MART_DAILY_DEMAND))
    names = ["quarter_num", "month_name", "day_num_in_month", "day_of_week_num",
             "day_of_week_name", "is_weekend"]
    return _serve(_with_calendar(days, dim_date, names, row_bound), S.MART_DAILY_DEMAND)


def mart_daily_payment_mix(fact: DataFrame) -> DataFrame:
    """Trips and money per day and payment code, with each code's share of the day (0 to 1)."""
    coded = fact.withColumn("payment_type_code", payment_code(F.col("payment_type_code")))
    mix = coded.groupBy(*DAY, "payment_type_code").agg(*_measures(S.MART_DAILY_PAYMENT_MIX))
    shared = share_of_total(
        mix,
        ["pickup_date"],
        {"payment_trip_share_pct": "trip_count", "payment_revenue_share_pct": "total_revenue"},
        positive_only=["payment_trip_share_pct"],
    )
    named = shared.withColumn("payment_type_name", payment_label(F.col("payment_type_code")))
    return _serve(named, S.MART_DAILY_PAYMENT_MIX)


def mart_weather_impact(
    fact: DataFrame,
    dim_weather: DataFrame,
    dim_date: DataFrame | None = None,
    row_bound: int | None = None,
) -> DataFrame:
    days = fact.groupBy(*DAY, "weather_date").agg(*_measures(S.MART_WEATHER_IMPACT))
    described = _with_calendar(
        days, dim_date, ["day_of_week_num", "day_of_week_name", "is_weekend"], row_bound
    )
    weather = ["is_rainy_day", "is_snowy_day", "temperature_max", "temperature_min",
               "temperature_mean", "precipitation_sum", "snowfall_sum"]
    joined = left_lookup(
        described, dim_weather, {"weather_date": "weather_date"}, weather, row_bound
    )
    return _serve(joined, S.MART_WEATHER_IMPACT)


def mart_zone_demand(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    places = fact.groupBy(*DAY, "pickup_location_id").agg(*_measures(S.MART_ZONE_DEMAND))
    named = left_lookup(
        places, dim_zone, {"pickup_location_id": "location_id"}, ["borough", "zone", "service_zone"]
    )
    return _serve(named, S.MART_ZONE_DEMAND)
