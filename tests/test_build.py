import pytest
from data import default_weather, default_zones, trips

from pyspark.sql import functions as F

from tripmart.plans import checks
from tripmart.plans.build import MARTS, Warehouse
from tripmart.sources.scope import Scope

SCOPE = Scope.of("2023-01-01", "2023-03-31")


def month(m, n=3, **changes):
    return [
        {"tpep_pickup_datetime": f"2023-{m:02d}-01 0{h}:00:00",
         "tpep_dropoff_datetime": f"2023-{m:02d}-01 1{h}:00:00", "payment_type": str(h), **changes}
        for h in range(n)
    ]


def contents(warehouse, name, rows):
    df = warehouse.read(name)
    return rows(df.drop(*[c for c in df.columns if c.endswith("_loaded_at")]))


@pytest.fixture
def inputs(spark):
    return default_weather(spark).na.fill({"precipitation_sum": "0.0"}), default_zones(spark)


def test_full_build_is_repeatable_and_a_month_leaves_others_alone(spark, tmp_path, inputs, rows):
    weather, zones = inputs
    root = str(tmp_path / "w")
    full = Warehouse(spark, root, SCOPE)
    raw = trips(spark, *month(1), *month(2, 2))
    full.run(raw, weather, zones)
    first = {n: contents(full, n, rows) for n in ["fact_trips", *MARTS]}
    full.run(raw, weather, zones)
    assert {n: contents(full, n, rows) for n in first} == first

    changed = trips(spark, *month(1, 1), *month(2, 5))
    one = Warehouse(spark, root, SCOPE, months="2023-02")
    one.run(changed, weather, zones)
    demand = {r.pickup_month: r.trip_count for r in one.read("mart_daily_demand").collect()}
    assert demand == {1: 3, 2: 5}
    assert [r for r in contents(one, "mart_zone_demand", rows) if r[2] == 1] == [
        r for r in first["mart_zone_demand"] if r[2] == 1
    ]

    report = one.export(str(tmp_path / "flat"))
    assert [r.violations for r in report.collect()] == [0, 0, 0, 0]


def test_a_failed_check_stops_the_build(spark, tmp_path, inputs):
    weather, zones = inputs
    warehouse = Warehouse(spark, str(tmp_path / "w"), SCOPE)
    uncovered = trips(spark, *month(1), *month(3))  # no weather in March
    with pytest.raises(checks.CheckFailed, match="weather_date_nulls"):
        warehouse.run(uncovered, weather, zones)
    with pytest.raises(FileNotFoundError):
        warehouse.read("mart_daily_demand")


def test_a_narrower_run_leaves_other_months_alone(spark, tmp_path, inputs, rows):
    weather, zones = inputs
    root = str(tmp_path / "w")
    raw = trips(spark, *month(1), *month(2, 2))
    Warehouse(spark, root, SCOPE).run(raw, weather, zones)
    first = {n: contents(Warehouse(spark, root, SCOPE), n, rows) for n in ["dim_date", "fact_trips", *MARTS]}
    narrow = Warehouse(spark, root, Scope.of("2023-01-01", "2023-01-31"))
    narrow.run(raw, weather, zones)
    assert {n: contents(narrow, n, rows) for n in first} == first
    Warehouse(spark, root, SCOPE, months="2023-01").run(trips(spark, *month(1, 1)), weather, zones)
    fact = narrow.read("fact_trips")
    assert fact.filter("pickup_month = 2 AND weather_date IS NULL").count() == 0
    assert {r.pickup_month: r["count"] for r in fact.groupBy("pickup_month").count().collect()} == {1: 1, 2: 2}
    assert narrow.read("dim_date").count() == 2


def test_faulty_stored_columns_are_reported(spark, tmp_path, inputs):
    weather, zones = inputs
    warehouse = Warehouse(spark, str(tmp_path / "w"), SCOPE)
    warehouse.run(trips(spark, *month(1)), weather, zones)
    frame = warehouse.read("dim_zone").withColumn("surplus", F.lit(1)).drop("service_zone")
    warehouse.table("dim_zone").replace(frame.withColumn("location_id", F.col("location_id").cast("string")))
    (found,) = warehouse._found("dim_zone")["dim_zone"].values()
    assert checks.column_differences(found, checks.S.DIM_ZONE) == (["service_zone"], ["surplus"], ["location_id"])
    warehouse.table("bronze_weather").replace(warehouse.read("bronze_weather").drop("snowfall_sum"))
    with pytest.raises(checks.CheckFailed, match="bronze_weather.*columns_match"):
        checks.enforce(warehouse.check_bronze())


def scans(df, folder):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line and folder in line]


def test_suites_read_the_fact_no_more_than_they_must(spark, tmp_path, inputs):
    weather, zones = inputs
    warehouse = Warehouse(spark, str(tmp_path / "w"), SCOPE, months="2023-01")
    warehouse.run(trips(spark, *month(1)), weather, zones)
    report = [p for p in warehouse.check_gold().collect() if p.violations]
    assert not [r for r in report if r.severity == checks.ERROR]
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)  # paths in full
    suite = checks.gold_suite(
        warehouse.trips("fact_trips"), warehouse.trips("silver_trips"), warehouse.days(),
        warehouse.read("dim_zone"), warehouse.read("dim_weather"))
    assert len(scans(suite, "/fact/fact_trips")) == 2
    served = checks.marts_vs_fact({n: warehouse.trips(n) for n in MARTS}, warehouse.trips("fact_trips"))
    assert len(scans(served, "/fact/fact_trips")) == 1
    for line in scans(suite, "_trips") + scans(served, "_trips"):
        assert "pickup_month" in line.split("PartitionFilters")[1].split("PushedFilters")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
