"""Small hand-made inputs."""

from tripmart import schemas as S

TRIP = {
    "vendorid": "1",
    "tpep_pickup_datetime": "2023-01-01 08:00:00",
    "tpep_dropoff_datetime": "2023-01-01 08:30:30",
    "passenger_count": "1.0",
    "trip_distance": "2.5",
    "ratecodeid": "1.0",
    "store_and_fwd_flag": " N ",
    "pulocationid": "10",
    "dolocationid": "20",
    "payment_type": "1",
    "fare_amount": "12.0",
    "extra": "0.5",
    "mta_tax": "0.5",
    "tip_amount": "2.0",
    "tolls_amount": None,
    "improvement_surcharge": "1.0",
    "total_amount": "16.0",
    "congestion_surcharge": None,
    "airport_fee": None,
}


def trips(spark, *changes):
    """Raw text trips, one per dict of changes to ``TRIP``."""
    records = [tuple({**TRIP, **c}[n] for n in S.TRIPS_RAW.names) for c in changes]
    return spark.createDataFrame(records, S.TRIPS_RAW.text_ddl)


def weather(spark, *records):
    return spark.createDataFrame(list(records), S.WEATHER_RAW.text_ddl)


def zones(spark, *records):
    ddl = ", ".join(f"{n} string" for n in S.ZONE_FILE_COLUMNS)
    return spark.createDataFrame(list(records), ddl)


def default_weather(spark):
    return weather(
        spark,
        ("2023-01-01", "5.0", "1.0", "3.0", "0.0", "1.5"),
        ("2023-01-02", "6.0", "2.0", "4.0", "2.0", "0.0"),
        ("2023-02-01", "7.0", "3.0", "5.0", None, "0.0"),
    )


def default_zones(spark):
    return zones(
        spark,
        ("10", " Uptown ", "Hill", "Yellow Zone"),
        ("20", "Harbour", " Pier ", "Boro Zone"),
    )
