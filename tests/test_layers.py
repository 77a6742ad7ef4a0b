import datetime as dt

import pytest
from data import TRIP, default_weather, default_zones, trips, weather, zones
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.plans import bronze, gold, marts, silver
from tripmart.sources.scope import Scope

SCOPE = Scope.of("2023-01-01", "2023-03-31")


def silver_of(spark, *changes, scope=SCOPE):
    return silver.silver_trips(bronze.bronze_trips(trips(spark, *changes)), scope)


def same_types(df, contract):
    assert df.columns == contract.names
    assert {f.name: f.dataType.simpleString() for f in df.schema} == contract.types


@pytest.fixture(scope="module")
def small(spark):
    """A few days of trips through every layer."""
    t = silver_of(
        spark,
        {},
        {"tpep_dropoff_datetime": "2023-01-01 09:00:00", "total_amount": "-6.0", "payment_type": None},
        {"tpep_pickup_datetime": "2023-01-02 23:10:00", "tpep_dropoff_datetime": "2023-01-03 00:10:00",
         "payment_type": "5", "pulocationid": "99"},
        {"tpep_pickup_datetime": "2023-01-04 10:00:00", "tpep_dropoff_datetime": "2023-01-04 10:01:00",
         "payment_type": "42"},
    )
    w = silver.silver_weather(bronze.bronze_weather(default_weather(spark)))
    z = silver.silver_zones(bronze.bronze_zones(default_zones(spark)))
    out = {
        "silver_trips": t, "silver_weather": w, "silver_zones": z,
        "dim_date": gold.dim_date(t), "dim_zone": gold.dim_zone(z), "dim_weather": gold.dim_weather(w),
    }
    out["fact_trips"] = gold.fact_trips(t, out["dim_weather"], SCOPE)
    f = out["fact_trips"]
    out["mart_daily_demand"] = marts.mart_daily_demand(f, out["dim_date"])
    out["mart_daily_payment_mix"] = marts.mart_daily_payment_mix(f)
    out["mart_weather_impact"] = marts.mart_weather_impact(f, out["dim_weather"], out["dim_date"])
    out["mart_zone_demand"] = marts.mart_zone_demand(f, out["dim_zone"])
    return out


def test_every_layer_follows_its_contract(small):
    for name, df in small.items():
        same_types(df, S.CONTRACTS[name])


def test_bronze_trips_survive_malformed_text(spark):
    got = bronze.bronze_trips(
        trips(
            spark,
            {"vendorid": "x", "trip_distance": "", "pulocationid": "7.0", "passenger_count": " "},
            {"tpep_pickup_datetime": "2023-13-01 00:00:00"},
            {"tpep_pickup_datetime": None},
            {"tpep_dropoff_datetime": "yesterday"},
        )
    )
    same_types(got, S.BRONZE_TRIPS)
    found = got.orderBy(F.col("vendorid").isNotNull()).collect()
    assert len(found) == 2
    odd, late = found
    assert (odd.vendorid, odd.trip_distance, odd.pulocationid, odd.passenger_count) == (None, None, 7, None)
    assert odd.store_and_fwd_flag == "N" and odd.pickup_date == dt.date(2023, 1, 1)
    assert late.tpep_dropoff_datetime is None


def test_bronze_adds_missing_and_drops_unknown_columns(spark):
    raw = trips(spark, {}).drop("airport_fee", "extra").withColumn("surprise", F.lit(1))
    row = bronze.bronze_trips(raw).first()
    assert row.airport_fee is None and row.extra is None and "surprise" not in row.asDict()


def test_typed_and_text_input_give_the_same_bronze(spark, rows):
    text = trips(spark, {}, {"payment_type": None}, {"trip_distance": "0.1"})
    from tripmart.operators.columns import retype

    typed = retype(text, S.TRIPS_RAW.types)
    drop = ["bronze_loaded_at", "source_file"]
    assert rows(bronze.bronze_trips(text).drop(*drop)) == rows(bronze.bronze_trips(typed).drop(*drop))


def test_bronze_weather_and_zones(spark, rows):
    w = bronze.bronze_weather(weather(spark, ("2023-01-05", "1", "x", "", None, "2"), ("2023-1-5", *"11111")))
    same_types(w, S.BRONZE_WEATHER)
    assert [tuple(r)[:8] for r in w.collect()] == [
        (dt.date(2023, 1, 5), 1.0, None, None, None, 2.0, 2023, 1)
    ]
    z = bronze.bronze_zones(
        zones(spark, ("1", " A ", "B", "C"), ("1", "A", "B", "C"), ("1", "A2", "B", "C"), (None, "D", "E", "F"),
              ("?", "D", "E", "F"))
    )
    same_types(z, S.BRONZE_ZONES)
    assert rows(z.select("location_id", "borough", "zone", "service_zone")) == [
        (1, "A", "B", "C"), (1, "A2", "B", "C")
    ]


def test_quality_rules_and_scope(spark):
    kept = silver_of(
        spark,
        {},
        {"tpep_dropoff_datetime": TRIP["tpep_pickup_datetime"]},
        {"tpep_dropoff_datetime": "2023-01-01 07:59:59"},
        {"tpep_dropoff_datetime": None},
        {"pulocationid": None},
        {"dolocationid": "none"},
        {"tpep_pickup_datetime": "2022-12-31 23:59:59"},
        {"tpep_pickup_datetime": "2023-03-31 23:59:59", "tpep_dropoff_datetime": "2023-04-01 00:10:00"},
        {"tpep_pickup_datetime": "2023-04-01 00:00:00", "tpep_dropoff_datetime": "2023-04-01 00:10:00"},
    )
    assert sorted(str(r.pickup_datetime) for r in kept.collect()) == [
        "2023-01-01 08:00:00", "2023-03-31 23:59:59"
    ]


def test_silver_derives_and_deduplicates(spark):
    got = silver_of(spark, {}, {"tip_amount": "1.0"}, {"passenger_count": None, "tip_amount": "9.0"})
    assert got.count() == 1
    row = got.first()
    assert (row.passenger_count, row.tip_amount) == (None, 9.0)  # nulls sort first
    assert (row.trip_duration_minutes, row.pickup_hour, row.pickup_month) == (30.5, 8, 1)
    assert row.store_and_fwd_flag == "N"


def test_null_and_empty_key_parts_collapse(spark):
    got = silver_of(spark, {"vendorid": None}, {"vendorid": ""}, {"vendorid": "2"})
    assert got.count() == 2


def test_weather_flags_and_repeats(spark):
    raw = weather(
        spark,
        ("2023-01-01", "1", "1", "1", None, "0"),
        ("2023-01-02", "1", "1", "1", "0", "0.1"),
        ("2023-01-03", "1", "1", "1", "5", None),
        ("2023-01-03", "2", "1", "1", "0", "1"),
    )
    got = silver.silver_weather(bronze.bronze_weather(raw)).orderBy("weather_date").collect()
    assert [(r.is_rainy_day, r.is_snowy_day, r.temperature_max) for r in got] == [
        (None, False, 1.0), (False, True, 1.0), (True, None, 1.0)
    ]


def test_zone_with_two_names_keeps_the_first_in_text_order(spark):
    z = bronze.bronze_zones(zones(spark, ("1", "Z", "b", "c"), ("1", "A", "b", "c")))
    got = silver.silver_zones(z)
    same_types(got, S.SILVER_ZONES)
    assert [(r.location_id, r.borough) for r in got.collect()] == [(1, "A")]


def test_date_dimension_has_only_observed_dates(spark, rows, small):
    assert [str(r[0]) for r in rows(small["dim_date"].select("date_day"))] == [
        "2023-01-01", "2023-01-02", "2023-01-04"
    ]


def test_date_dimension_is_the_same_before_deduplication(spark, rows):
    b = bronze.bronze_trips(trips(spark, {}, {}, {"tpep_dropoff_datetime": "2023-01-01 11:00:00"}))
    before = gold.dim_date(silver.clean_trips(b, SCOPE)).drop("gold_loaded_at")
    after = gold.dim_date(silver.silver_trips(b, SCOPE)).drop("gold_loaded_at")
    assert rows(before) == rows(after)


def test_fact_fills_amounts_and_marks_missing_weather(small):
    by_day = {}
    for r in small["fact_trips"].collect():
        by_day.setdefault(str(r.pickup_date), r)
    assert by_day["2023-01-04"].weather_date is None
    assert str(by_day["2023-01-02"].weather_date) == "2023-01-02"
    row = by_day["2023-01-01"]
    assert (row.tolls_amount, row.congestion_surcharge_amount, row.airport_fee_amount) == (0.0, 0.0, 0.0)


def test_fact_of_repeated_inputs(spark, small):
    twice = small["silver_trips"].unionByName(small["silver_trips"])
    double_weather = small["dim_weather"].unionByName(small["dim_weather"])
    fact = gold.fact_trips(twice, double_weather, SCOPE, unique=False)
    assert fact.count() == small["silver_trips"].count()


def test_fact_is_the_same_without_a_scope(rows, small):
    a = gold.fact_trips(small["silver_trips"], small["dim_weather"])
    assert rows(a.drop("gold_loaded_at")) == rows(small["fact_trips"].drop("gold_loaded_at"))


def test_daily_demand(small):
    first = small["mart_daily_demand"].orderBy("pickup_date").first()
    assert (first.trip_count, first.total_passenger_count) == (2, 2)
    assert (first.total_revenue, first.avg_total_amount) == (10.0, 5.0)
    assert first.negative_total_amount_trip_count == 1
    assert (first.day_of_week_name, first.is_weekend) == ("Sunday", True)


def test_calendar_by_dimension_or_computed(rows, small):
    f = small["fact_trips"]
    assert rows(marts.mart_daily_demand(f).drop("serving_loaded_at")) == rows(
        small["mart_daily_demand"].drop("serving_loaded_at")
    )
    assert rows(
        marts.mart_weather_impact(f, small["dim_weather"]).drop("serving_loaded_at")
    ) == rows(small["mart_weather_impact"].drop("serving_loaded_at"))


def test_payment_mix(small):
    got = {(str(r.pickup_date), r.payment_type_code): r for r in small["mart_daily_payment_mix"].collect()}
    missing, card = got[("2023-01-01", -1)], got[("2023-01-01", 1)]
    assert (missing.payment_type_name, card.payment_type_name) == ("Missing", "Credit card")
    assert (missing.payment_trip_share_pct, card.payment_trip_share_pct) == (0.5, 0.5)
    assert (missing.payment_revenue_share_pct, card.payment_revenue_share_pct) == (-0.6, 1.6)
    assert got[("2023-01-02", 5)].payment_type_name == "Unknown"
    assert got[("2023-01-04", 42)].payment_type_name == "Other"


def test_weather_and_zone_marts(small):
    w = {str(r.pickup_date): r for r in small["mart_weather_impact"].collect()}
    assert (w["2023-01-01"].is_rainy_day, w["2023-01-01"].is_snowy_day) == (False, True)
    assert w["2023-01-04"].weather_date is None and w["2023-01-04"].temperature_mean is None
    z = {(str(r.pickup_date), r.pickup_location_id): r for r in small["mart_zone_demand"].collect()}
    assert (z[("2023-01-01", 10)].borough, z[("2023-01-01", 10)].trip_count) == ("Uptown", 2)
    assert z[("2023-01-02", 99)].borough is None


def test_mart_sums_equal_the_fact(small):
    fact = small["fact_trips"].agg(F.count("*"), F.sum("total_amount")).first()
    for name, df in small.items():
        if name.startswith("mart_"):
            assert df.agg(F.sum("trip_count"), F.sum("total_revenue")).first() == fact, name


def test_layers_of_nothing_are_empty(spark, small):
    none = small["fact_trips"].limit(0)
    assert marts.mart_daily_demand(none, small["dim_date"]).count() == 0
    assert marts.mart_daily_payment_mix(none).count() == 0
    assert marts.mart_weather_impact(none, small["dim_weather"]).count() == 0
    assert marts.mart_zone_demand(none, small["dim_zone"]).count() == 0
    assert gold.dim_date(small["silver_trips"].limit(0)).count() == 0


def test_trips_for_a_write_by_month_are_those_of_silver(spark, rows):
    """Found by the values of the key instead of its id: as text, so that 0.0 and -0.0 are two and null is one."""
    zero = [{"total_amount": t, "trip_distance": d, "fare_amount": f} for t in ("0.0", "-0.0", None, "NaN")
            for d in ("0.0", "-0.0", None, "1e-7", "0.1") for f in ("2.0", "1.0")]
    days = [{"vendorid": v, "tpep_pickup_datetime": f"2023-0{m}-01 0{m}:00:00", "tpep_dropoff_datetime": "2023-03-09 00:00:00",
             "total_amount": "123456789.01"} for m in (1, 2, 3) for v in ("1", None) for _ in range(2)]
    raw = bronze.bronze_trips(trips(spark, *zero, *days)).withColumn("bronze_loaded_at", F.lit(None).cast("timestamp"))
    want = silver.silver_trips(raw, SCOPE).drop("silver_loaded_at")
    got = silver.silver_trips(raw, SCOPE, spread=True).drop("silver_loaded_at")
    assert got.schema.simpleString() == want.schema.simpleString()
    assert repr(rows(got)) == repr(rows(want)) and got.count() == 20 + 6


def test_trips_for_a_write_by_month_are_shuffled_without_an_id(spark):
    raw = bronze.bronze_trips(trips(spark, {}))
    plan = silver.silver_trips(raw, SCOPE, spread=True)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("rebalance") if "rebalance" in plan else plan.index("REBALANCE"):]
    assert "sha2(" not in below and "row_number(), 1, Partial" in below
