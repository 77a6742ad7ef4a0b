"""Dashboard queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.aggregates import money_sum, top_by


def kpi_summary(demand: DataFrame) -> DataFrame:
    """Whole-period averages are weighted: sum over sum, not a mean of daily means."""
    trips = F.sum("trip_count")
    return demand.agg(
        trips.alias("total_trips"),
        money_sum("total_revenue").alias("total_revenue"),
        F.try_divide(money_sum("total_revenue"), trips).alias("avg_revenue_per_trip"),
        F.try_divide(F.sum("total_trip_duration_minutes"), trips).alias("avg_duration_minutes"),
    )


def daily_trips_vs_revenue(demand: DataFrame) -> DataFrame:
    return demand.select("pickup_date", "trip_count", "avg_total_amount").orderBy("pickup_date")


def dow_profile(demand: DataFrame) -> DataFrame:
    """Mean over the days of each weekday."""
    return (
        demand.groupBy("day_of_week_num", "day_of_week_name")
        .agg(
            F.avg("trip_count").alias("avg_trips"),
            F.avg("avg_total_amount").alias("avg_revenue_per_trip"),
        )
        .orderBy("day_of_week_num")
    )


def daily_revenue_trend(demand: DataFrame) -> DataFrame:
    return demand.select("pickup_date", "total_revenue").orderBy("pickup_date")


def distance_vs_revenue(demand: DataFrame) -> DataFrame:
    return demand.select("pickup_date", "avg_trip_distance", "avg_total_amount")


def top_peak_days(demand: DataFrame, k: int = 10) -> DataFrame:
    days = demand.select("pickup_date", "day_of_week_name", "trip_count", "total_revenue")
    return top_by(days, ["trip_count"], ["pickup_date"], k)


def weather_effect(weather_mart: DataFrame) -> DataFrame:
    trips = F.sum("trip_count")
    return (
        weather_mart.groupBy("is_rainy_day", "is_snowy_day")
        .agg(
            F.count("*").alias("days"),
            trips.alias("trips"),
            money_sum("total_revenue").alias("total_revenue"),
            F.avg("trip_count").alias("avg_trips_per_day"),
            F.try_divide(money_sum("total_revenue"), trips).alias("avg_revenue_per_trip"),
        )
        .orderBy("is_rainy_day", "is_snowy_day")
    )
