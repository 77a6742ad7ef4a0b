"""The physical plans must keep the properties that matter on large inputs."""

import re
import time

import pytest
from pyspark.sql import functions as F

from tripmart import bindings
from tripmart.plans import bronze, silver
from tripmart.queries import all_queries
from tripmart.store import Layers

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def no_auto_broadcast(spark):
    """As if every table were too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scope_reaches_the_scan_and_unused_columns_do_not(spark):
    plan = plan_of(Layers(spark, FOLDER).plan("mart_daily_demand"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,1990-01-01", plan)
    orders = re.search(r"FileScan parquet \[(o_orderkey[^\]]*)\]", plan).group(1)
    assert "o_totalprice" not in orders and "o_orderpriority" not in orders
    assert "file_path" not in plan  # lineage is not read for a mart


def test_trip_rows_are_shuffled_once_for_the_mart(spark, no_auto_broadcast):
    """Besides the joins that make up the input: one exchange by trip key, one by day."""
    plan = plan_of(Layers(spark, FOLDER).plan("mart_daily_demand"))
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert keys.count("trip_id") == 1
    assert keys.count("pickup_date") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_weather_is_broadcast_by_its_bound_and_zones_are_not(spark, no_auto_broadcast):
    layers = Layers(spark, FOLDER)
    assert plan_of(layers.plan("fact_trips")).count("BroadcastHashJoin") == 1
    zone_mart = plan_of(layers.plan("mart_zone_demand"))
    assert "SortMergeJoin [pickup_location_id" in zone_mart


def test_copies_are_dropped_before_the_trip_exchange(spark):
    trips = bronze.bronze_trips(bindings.trips_raw(spark, FOLDER, lineage=False))
    plan = plan_of(silver.silver_trips(trips, bindings.DEFAULT_SCOPE, lineage=False))
    below = plan[plan.index("Exchange hashpartitioning(trip_id"):]
    assert "row_number(), 1, Partial" in below


def test_trips_are_shuffled_without_what_follows_from_other_columns(spark):
    """Neither the 64 digits of the id nor derived columns are below the exchange by trip key."""
    trips = bronze.bronze_trips(bindings.trips_raw(spark, FOLDER, lineage=False))
    df = silver.silver_trips(trips, bindings.DEFAULT_SCOPE, lineage=False)
    sent = plan_of(df).split("Exchange hashpartitioning(trip_id")[1].split("Project [", 1)[1].split("]\n")[0]
    assert "trip_duration_minutes" not in sent and "pickup_hour" not in sent
    assert "unhex(" in sent


def test_the_fact_is_read_from_stored_silver(spark):
    """A report on the fact neither deals the trips again nor stores a second copy of them."""
    layers = Layers(spark, FOLDER, storage=f"{spark.conf.get('spark.checkpoint.dir')}/own")
    fact = layers.table("fact_trips")
    assert any("/silver_trips/" in f for f in fact.inputFiles())
    assert not any("/fact_trips/" in f for f in fact.inputFiles())
    assert "hashpartitioning" not in plan_of(fact)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_what_is_shuffled_for_a_stored_layer_goes_with_its_write(spark):
    name = "spark.sql.files.maxPartitionBytes"
    layers = Layers(spark, FOLDER, storage=f"{spark.conf.get('spark.checkpoint.dir')}/steps")
    layers.root()
    before, known = spark.conf.get(name), shuffle_files(spark)
    layers.stored_path("silver_trips")
    until = time.time() + 20
    while shuffle_files(spark) - known and time.time() < until:  # removed in the background
        time.sleep(0.2)
    assert not shuffle_files(spark) - known
    assert spark.conf.get(name) == before
    assert layers.table("silver_trips").count() == layers.plan("silver_trips").count()
    scratch = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{layers.root()}/scratch")
    assert scratch.filter("length > 0").isEmpty()


def test_early_values_are_those_of_raw_trips(spark, rows, no_auto_broadcast):
    """The key's columns without what their values are made of; few suppliers are no shuffle of trips."""
    names = ["vendorid", "total_amount", "trip_distance"]
    want = bindings.trips_raw(spark, FOLDER, lineage=False).select(names)
    got = bindings.trips_raw(spark, FOLDER, lineage=False, early=["total_amount"], few_suppliers=True).select(names)
    assert rows(got) == rows(want)
    plan = plan_of(got)
    moved = plan[:plan.index("Exchange hashpartitioning(l_orderkey")]
    assert "l_returnflag" in plan and "l_returnflag" not in moved
    assert "hashpartitioning(l_suppkey" in plan_of(want) and "hashpartitioning(l_suppkey" not in plan


def test_months_prune_folders(spark):
    layers = Layers(spark, FOLDER)
    stored = layers.table("silver_trips")
    plan = plan_of(stored.filter(layers.scope.has_month(F.col("pickup_year"), F.col("pickup_month"))))
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_year", plan)


@pytest.mark.parametrize(
    "name",
    ["raw_status_summary", "raw_table_profile", "duplicate_grain_summary", "scalar_reconcile",
     "reconcile_zone_demand", "check_same_keys", "fk_coverage", "keyset_diff_except"],
)
def test_reports_have_no_cross_join(spark, name):
    plan = plan_of(all_queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_python_in_any_plan(spark):
    for name, query in all_queries().items():
        if name.startswith(("sink_", "export_")):
            continue
        plan = plan_of(query(spark, FOLDER))
        assert "Python" not in plan and "Pandas" not in plan, name


def test_changed_inputs_are_computed_anew(spark, tmp_path):
    import shutil

    for table in bindings.INPUTS:
        shutil.copy(f"{FOLDER}/{table}.parquet", tmp_path / f"{table}.parquet")
    before = Layers(spark, str(tmp_path)).table("mart_daily_demand").agg(F.sum("trip_count")).first()[0]
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").filter("l_returnflag = 'N'")
    lines.write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    after = Layers(spark, str(tmp_path)).table("mart_daily_demand").agg(F.sum("trip_count")).first()[0]
    assert 0 < after < before


def test_layers_stay_plans_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr("tripmart.store.shared_folder", lambda spark: None)
    layers = Layers(spark, FOLDER)
    assert layers.table("mart_daily_demand").count() > 0
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        layers.scratch("x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        layers.stored_path("silver_trips")
