"""Column contracts of every layer.

A contract is an ordered list of fields; the type text is what ``try_cast``
understands.  ``varchar(n)`` keeps the load-time length and is a string in Spark.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    max_chars: int | None = None


class Contract(tuple):
    """Ordered fields with a few views on them."""

    @classmethod
    def of(cls, text: str) -> Contract:
        fields = []
        for line in text.strip().splitlines():
            name, kind = line.split()
            if kind.startswith("varchar("):
                fields.append(Field(name, "string", int(kind[8:-1])))
            else:
                fields.append(Field(name, kind))
        return cls(fields)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self]

    @property
    def types(self) -> dict[str, str]:
        return {f.name: f.type for f in self}

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.type}" for f in self)

    @property
    def text_ddl(self) -> str:
        """The same columns, all as strings: the shape of a raw text file."""
        return ", ".join(f"`{f.name}` string" for f in self)

    def without(self, *names: str) -> Contract:
        return Contract(f for f in self if f.name not in names)


# Column names, order and types of the inputs and of every layer.

TRIPS_RAW = Contract.of("""
    vendorid bigint
    tpep_pickup_datetime timestamp_ntz
    tpep_dropoff_datetime timestamp_ntz
    passenger_count double
    trip_distance double
    ratecodeid double
    store_and_fwd_flag varchar(10)
    pulocationid bigint
    dolocationid bigint
    payment_type bigint
    fare_amount double
    extra double
    mta_tax double
    tip_amount double
    tolls_amount double
    improvement_surcharge double
    total_amount double
    congestion_surcharge double
    airport_fee double
""")

WEATHER_RAW = Contract.of("""
    date date
    temperature_2m_max double
    temperature_2m_min double
    temperature_2m_mean double
    precipitation_sum double
    snowfall_sum double
""")

ZONES_RAW = Contract.of("""
    location_id int
    borough varchar(100)
    zone varchar(255)
    service_zone varchar(255)
""")

ZONE_FILE_COLUMNS = ["LocationID", "Borough", "Zone", "service_zone"]

TRIP_FILE_OPTIONAL = ["congestion_surcharge", "airport_fee"]

TRIP_RENAMES = {
    "vendorid": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "ratecodeid": "rate_code_id",
    "pulocationid": "pickup_location_id",
    "dolocationid": "dropoff_location_id",
    "payment_type": "payment_type_code",
    "extra": "extra_amount",
    "mta_tax": "mta_tax_amount",
    "improvement_surcharge": "improvement_surcharge_amount",
    "congestion_surcharge": "congestion_surcharge_amount",
    "airport_fee": "airport_fee_amount",
}

WEATHER_RENAMES = {
    "date": "weather_date",
    "temperature_2m_max": "temperature_max",
    "temperature_2m_min": "temperature_min",
    "temperature_2m_mean": "temperature_mean",
}

ZONE_RENAMES = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}

TRIP_KEY = [
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "trip_distance",
    "total_amount",
]

BRONZE_TRIPS = Contract(
    TRIPS_RAW
    + Contract.of("""
    pickup_date date
    pickup_year int
    pickup_month int
    source_file string
    bronze_loaded_at timestamp
""")
)

BRONZE_WEATHER = Contract(
    WEATHER_RAW
    + Contract.of("""
    weather_year int
    weather_month int
    source_file string
    bronze_loaded_at timestamp
""")
)

BRONZE_ZONES = Contract(
    ZONES_RAW
    + Contract.of("""
    source_file string
    bronze_loaded_at timestamp
""")
)

SILVER_TRIPS = Contract.of("""
    trip_id string
    vendor_id int
    pickup_datetime timestamp_ntz
    dropoff_datetime timestamp_ntz
    pickup_date date
    pickup_year int
    pickup_month int
    pickup_hour int
    passenger_count int
    trip_distance double
    trip_duration_minutes double
    rate_code_id int
    store_and_fwd_flag string
    pickup_location_id int
    dropoff_location_id int
    payment_type_code int
    fare_amount double
    extra_amount double
    mta_tax_amount double
    tip_amount double
    tolls_amount double
    improvement_surcharge_amount double
    congestion_surcharge_amount double
    airport_fee_amount double
    total_amount double
    source_file string
    bronze_loaded_at timestamp
    silver_loaded_at timestamp
""")

SILVER_WEATHER = Contract.of("""
    weather_date date
    temperature_max double
    temperature_min double
    temperature_mean double
    precipitation_sum double
    snowfall_sum double
    is_rainy_day boolean
    is_snowy_day boolean
    weather_year int
    weather_month int
    source_file string
    bronze_loaded_at timestamp
    silver_loaded_at timestamp
""")

SILVER_ZONES = Contract.of("""
    location_id int
    borough string
    zone string
    service_zone string
    source_file string
    bronze_loaded_at timestamp
    silver_loaded_at timestamp
""")

DIM_DATE = Contract.of("""
    date_day date
    year_num int
    quarter_num int
    month_num int
    month_name string
    day_num_in_month int
    day_of_week_num int
    day_of_week_name string
    is_weekend boolean
    gold_loaded_at timestamp
""")

DIM_ZONE = Contract.of("""
    location_id int
    borough string
    zone string
    service_zone string
    gold_loaded_at timestamp
""")

DIM_WEATHER = Contract.of("""
    weather_date date
    temperature_max double
    temperature_min double
    temperature_mean double
    precipitation_sum double
    snowfall_sum double
    is_rainy_day boolean
    is_snowy_day boolean
    gold_loaded_at timestamp
""")

FACT_TRIPS = Contract.of("""
    trip_id string
    pickup_datetime timestamp_ntz
    dropoff_datetime timestamp_ntz
    pickup_date date
    pickup_year int
    pickup_month int
    pickup_hour int
    weather_date date
    pickup_location_id int
    dropoff_location_id int
    vendor_id int
    rate_code_id int
    payment_type_code int
    store_and_fwd_flag string
    passenger_count int
    trip_distance double
    trip_duration_minutes double
    fare_amount double
    extra_amount double
    mta_tax_amount double
    tip_amount double
    tolls_amount double
    improvement_surcharge_amount double
    congestion_surcharge_amount double
    airport_fee_amount double
    total_amount double
    gold_loaded_at timestamp
""")

MART_DAILY_DEMAND = Contract.of("""
    pickup_date date
    pickup_year int
    pickup_month int
    quarter_num int
    month_name varchar(20)
    day_num_in_month int
    day_of_week_num int
    day_of_week_name varchar(20)
    is_weekend boolean
    trip_count bigint
    total_passenger_count bigint
    total_trip_distance double
    total_trip_duration_minutes double
    total_revenue double
    total_fare_amount double
    total_tip_amount double
    total_tolls_amount double
    avg_trip_distance double
    avg_trip_duration_minutes double
    avg_total_amount double
    avg_fare_amount double
    avg_tip_amount double
    negative_total_amount_trip_count bigint
    serving_loaded_at timestamp
""")

MART_DAILY_PAYMENT_MIX = Contract.of("""
    pickup_date date
    pickup_year int
    pickup_month int
    payment_type_code int
    payment_type_name varchar(50)
    trip_count bigint
    total_revenue double
    total_fare_amount double
    total_tip_amount double
    avg_total_amount double
    avg_fare_amount double
    avg_tip_amount double
    payment_trip_share_pct double
    payment_revenue_share_pct double
    serving_loaded_at timestamp
""")

MART_WEATHER_IMPACT = Contract.of("""
    pickup_date date
    pickup_year int
    pickup_month int
    day_of_week_num int
    day_of_week_name varchar(20)
    is_weekend boolean
    weather_date date
    is_rainy_day boolean
    is_snowy_day boolean
    temperature_max double
    temperature_min double
    temperature_mean double
    precipitation_sum double
    snowfall_sum double
    trip_count bigint
    total_revenue double
    total_fare_amount double
    total_tip_amount double
    avg_total_amount double
    avg_trip_distance double
    avg_trip_duration_minutes double
    negative_total_amount_trip_count bigint
    serving_loaded_at timestamp
""")

MART_ZONE_DEMAND = Contract.of("""
    pickup_date date
    pickup_year int
    pickup_month int
    pickup_location_id int
    borough varchar(100)
    zone varchar(255)
    service_zone varchar(255)
    trip_count bigint
    total_revenue double
    total_fare_amount double
    total_tip_amount double
    avg_total_amount double
    avg_trip_distance double
    avg_trip_duration_minutes double
    negative_total_amount_trip_count bigint
    serving_loaded_at timestamp
""")

CONTRACTS = {
    "bronze_trips": BRONZE_TRIPS,
    "bronze_weather": BRONZE_WEATHER,
    "bronze_zones": BRONZE_ZONES,
    "silver_trips": SILVER_TRIPS,
    "silver_weather": SILVER_WEATHER,
    "silver_zones": SILVER_ZONES,
    "dim_date": DIM_DATE,
    "dim_zone": DIM_ZONE,
    "dim_weather": DIM_WEATHER,
    "fact_trips": FACT_TRIPS,
    "mart_daily_demand": MART_DAILY_DEMAND,
    "mart_daily_payment_mix": MART_DAILY_PAYMENT_MIX,
    "mart_weather_impact": MART_WEATHER_IMPACT,
    "mart_zone_demand": MART_ZONE_DEMAND,
}

UNIQUE_KEYS = {
    "bronze_weather": ["date"],
    "bronze_zones": ["location_id", "borough", "zone", "service_zone"],
    "silver_trips": ["trip_id"],
    "silver_weather": ["weather_date"],
    "silver_zones": ["location_id"],
    "dim_date": ["date_day"],
    "dim_zone": ["location_id"],
    "dim_weather": ["weather_date"],
    "fact_trips": ["trip_id"],
    "mart_daily_demand": ["pickup_date"],
    "mart_daily_payment_mix": ["pickup_date", "payment_type_code"],
    "mart_weather_impact": ["pickup_date"],
    "mart_zone_demand": ["pickup_date", "pickup_location_id"],
}

PARTITIONS = {
    "bronze_trips": ["pickup_year", "pickup_month"],
    "bronze_weather": ["weather_year", "weather_month"],
    "silver_trips": ["pickup_year", "pickup_month"],
    "silver_weather": ["weather_year", "weather_month"],
    "fact_trips": ["pickup_year", "pickup_month"],
    "mart_daily_demand": ["pickup_year", "pickup_month"],
    "mart_daily_payment_mix": ["pickup_year", "pickup_month"],
    "mart_weather_impact": ["pickup_year", "pickup_month"],
    "mart_zone_demand": ["pickup_year", "pickup_month"],
}

# Fixed values from here on: what the checks require, which amounts they look at, labels, tolerances.
REQUIRED = {
    "bronze_trips": ["pickup_date", "pickup_year", "pickup_month", "source_file", "bronze_loaded_at"],
    "bronze_weather": ["date", "weather_year", "weather_month", "source_file", "bronze_loaded_at"],
    "bronze_zones": ["location_id", "source_file", "bronze_loaded_at"],
    "silver_trips": [
        "trip_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_year",
        "pickup_month", "pickup_hour", "trip_duration_minutes", "pickup_location_id",
        "dropoff_location_id", "source_file", "bronze_loaded_at", "silver_loaded_at",
    ],
    "silver_weather": [
        "weather_date", "weather_year", "weather_month", "source_file", "bronze_loaded_at",
        "silver_loaded_at",
    ],
    "silver_zones": ["location_id", "source_file", "bronze_loaded_at", "silver_loaded_at"],
    "dim_date": DIM_DATE.names,
    "dim_zone": DIM_ZONE.names,
    "dim_weather": DIM_WEATHER.names,
    "fact_trips": [
        "trip_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_year",
        "pickup_month", "pickup_hour", "weather_date", "pickup_location_id",
        "dropoff_location_id", "trip_distance", "trip_duration_minutes", "fare_amount",
        "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount",
        "improvement_surcharge_amount", "congestion_surcharge_amount", "airport_fee_amount",
        "total_amount", "gold_loaded_at",
    ],
    "mart_daily_demand": [
        "pickup_date", "pickup_year", "pickup_month", "quarter_num", "month_name",
        "day_num_in_month", "day_of_week_num", "day_of_week_name", "is_weekend", "trip_count",
        "total_revenue", "avg_total_amount", "negative_total_amount_trip_count",
        "serving_loaded_at",
    ],
    "mart_daily_payment_mix": [
        "pickup_date", "pickup_year", "pickup_month", "payment_type_code", "payment_type_name",
        "trip_count", "total_revenue", "payment_trip_share_pct", "payment_revenue_share_pct",
        "serving_loaded_at",
    ],
    "mart_weather_impact": [
        "pickup_date", "pickup_year", "pickup_month", "day_of_week_num", "day_of_week_name",
        "is_weekend", "weather_date", "is_rainy_day", "is_snowy_day", "temperature_mean",
        "precipitation_sum", "trip_count", "total_revenue", "negative_total_amount_trip_count",
        "serving_loaded_at",
    ],
    "mart_zone_demand": [
        "pickup_date", "pickup_year", "pickup_month", "pickup_location_id", "borough", "zone",
        "service_zone", "trip_count", "total_revenue", "negative_total_amount_trip_count",
        "serving_loaded_at",
    ],
}

MONEY_COLUMNS = [
    "fare_amount", "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount",
    "improvement_surcharge_amount", "congestion_surcharge_amount", "airport_fee_amount",
    "total_amount",
]

OPTIONAL_AMOUNTS = [
    "extra_amount", "mta_tax_amount", "tip_amount", "tolls_amount",
    "improvement_surcharge_amount", "congestion_surcharge_amount", "airport_fee_amount",
]

PAYMENT_LABELS = {
    -1: "Missing",
    0: "Unknown",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_LABEL_MISSING = "Missing"
PAYMENT_LABEL_OTHER = "Other"
PAYMENT_CODE_MISSING = -1

KEY_SEPARATOR = "||"
MONEY_TOLERANCE = 0.01
MONEY_DRIFT = 0.75 * MONEY_TOLERANCE  # less than a cent, which as a double may be a little below 0.01
SHARE_TOLERANCE = 0.0001
EXPORT_FILES = {
    "mart_daily_demand": 1,
    "mart_daily_payment_mix": 1,
    "mart_weather_impact": 1,
    "mart_zone_demand": 4,
}
