"""Tables that change in one commit: replacement, appending, counts, jobs that die."""

import shutil

import pytest
from data import default_weather, default_zones, trips

from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.plans import checks
from tripmart.plans.build import MARTS, Warehouse
from tripmart.sources import writers
from tripmart.sources.scope import Scope
from tripmart.sources.tables import CommitConflict, State, VersionedTable, month_partitions

MONTHS = ["pickup_year", "pickup_month"]
DDL = "v int, pickup_year int, pickup_month int"
ALL = ["bronze_trips", "bronze_weather", "bronze_zones", "silver_trips", "silver_weather", "silver_zones",
       "dim_date", "dim_zone", "dim_weather", "fact_trips", *MARTS]


def month_rows(spark, *records):
    return spark.createDataFrame(list(records), DDL)


def held(table):
    return sorted(tuple(r) for r in table.read(DDL).select("v", *MONTHS).collect())


class Died(RuntimeError):
    pass


class DiesAt:
    """Ends the job in place of, or right after, the n-th write of files or commit."""

    def __init__(self, monkeypatch, at):
        self.left = at
        for name in ("_write", "_commit"):
            monkeypatch.setattr(VersionedTable, name, self.wrapped(getattr(VersionedTable, name)))

    def wrapped(self, method):
        def run(table, *args):
            if self.left == 0:
                raise Died
            out = method(table, *args)
            self.left -= 1
            if self.left == 0:
                raise Died
            return out

        return run


def test_requested_month_that_is_gone_is_emptied_in_the_same_commit(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), MONTHS)
    with pytest.raises(FileNotFoundError):
        table.read(DDL)
    table.replace(month_rows(spark, (1, 2023, 1), (2, 2023, 2), (3, 2023, 3)))
    also = month_partitions(["2023-02", "2023-03"], MONTHS)
    state = table.replace_partitions(month_rows(spark, (7, 2023, 2)), also)
    assert held(table) == [(1, 2023, 1), (7, 2023, 2)] and state.number == 2
    table.replace_partitions(month_rows(spark), also)
    assert held(table) == [(1, 2023, 1)]
    table.replace_partitions(month_rows(spark), month_partitions(["2023-01"], MONTHS))
    assert held(table) == [] and table.rows() == 0


def test_counts_by_partition_come_from_stored_files(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), MONTHS)
    table.replace(spark.range(5000).selectExpr("int(id) AS v", "2023 AS pickup_year", "int(id % 3 + 1) AS pickup_month"))
    table.append(month_rows(spark, (-1, 2023, 1)))
    counts = {r.partition: r.row_count for r in table.row_counts().collect()}
    assert counts == {f"pickup_year=2023/pickup_month={m}": n for m, n in ((1, 1668), (2, 1667), (3, 1666))}
    assert table.rows(month_partitions(["2023-01", "2022-01"], MONTHS)) == 1668 and table.rows() == 5001
    assert all(r.files and r.bytes for r in table.row_counts().collect())


def test_counts_hold_when_rows_pass_twice(spark, tmp_path):
    """A sort reads its input once for its ranges and once more; what is counted is what was stored."""
    source = VersionedTable(spark, str(tmp_path / "s"))
    state = source.replace(month_rows(spark, *[(k, 2023, 1) for k in range(100)]).repartition(5).orderBy("v"))
    assert state.rows == 100
    contract = S.Contract.of("v int\npickup_month int")
    row = writers.export_flat(source.read(DDL).orderBy("v"), str(tmp_path / "out"), contract, 1, source.rows()).first()
    assert (row.source_rows, row.exported_rows, row.violations) == (100, 100, 0)
    again = spark.read.parquet(str(tmp_path / "out"))
    again.limit(1).write.mode("append").parquet(str(tmp_path / "out"))
    row = writers.reconciled(source.rows(), spark.read.parquet(str(tmp_path / "out"))).first()
    assert (row.exported_rows, row.violations) == (101, 1)


def test_odd_partition_names(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["p"])
    names = ["a b", "c/d", "e+f", "é:%", None]
    table.replace(spark.createDataFrame([(k, n) for k, n in enumerate(names)], "v int, p string"))
    assert sorted(r.v for r in table.read().collect()) == list(range(5))
    assert {r.p for r in table.read().collect()} == set(names)
    assert table.rows() == 5 and len(table.state().parts) == 5


def test_a_table_may_be_made_from_itself_and_old_readers_keep_theirs(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(month_rows(spark, (1, 2023, 1)))
    before = table.read(DDL)
    table.replace(before.withColumn("v", F.col("v") + 1).unionByName(before))
    assert [r[0] for r in held(table)] == [1, 2] and before.count() == 1


def test_other_columns_of_a_later_write(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(month_rows(spark, (1, 2023, 1)))
    table.replace(spark.createDataFrame([("x", 1)], "name string, stored long"))
    assert table.read().columns == ["name", "stored"]


def test_writes_that_died_are_not_seen_and_are_swept(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"), MONTHS)
    table.replace(month_rows(spark, (1, 2023, 1)))
    with monkeypatch.context() as patch:
        DiesAt(patch, 1)
        with pytest.raises(Died):
            table.replace(month_rows(spark, (2, 2023, 1)))
    assert held(table) == [(1, 2023, 1)] and table.vacuum() == []  # it might still go on
    table.replace_partitions(month_rows(spark, (3, 2023, 2)))
    assert len(table.vacuum()) == 1 and table.vacuum() == []
    assert held(table) == [(1, 2023, 1), (3, 2023, 2)]


def test_of_two_writers_one_fails(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(month_rows(spark, (1, 2023, 1)))
    state = table.current()
    outcomes = []
    for _ in range(6):  # names are drawn, so either order comes up
        try:
            table._commit(State(state.number + 1, state.ddl, None, state.parts))
            outcomes.append("first")
        except CommitConflict:
            outcomes.append("conflict")
    assert outcomes[0] == "first" and "conflict" in outcomes
    assert held(table) == [(1, 2023, 1)] and table.current().number == state.number + 1


# -- batches -------------------------------------------------------------------------------------


def batch(spark, v):
    return spark.createDataFrame([(v,)], "v string")


def test_a_restarted_run_neither_truncates_nor_doubles(spark, tmp_path, monkeypatch):
    contract, path = S.Contract.of("v int"), str(tmp_path / "t")
    writers.RunLoader(spark, run="old").load(batch(spark, "9"), path, contract)

    def run(loader):
        return [loader.load(batch(spark, v), path, contract) for v in "123"]

    def values():
        return sorted(r.v for r in writers.RunLoader(spark).read(path, contract).collect())

    for at in (1, 4, 5):  # dies after some of the writes and commits of three batches
        with monkeypatch.context() as patch:
            DiesAt(patch, at)
            with pytest.raises(Died):
                run(writers.RunLoader(spark, run=f"run{at}"))
        run(writers.RunLoader(spark, run=f"run{at}"))
        assert values() == [1, 2, 3]
        assert run(writers.RunLoader(spark, run=f"run{at}")) == [False] * 3
        assert values() == [1, 2, 3]
    named = writers.RunLoader(spark, truncate=False, run="more")
    assert named.load(batch(spark, "4"), path, contract, name="2023-04")
    assert not writers.RunLoader(spark, truncate=False).load(batch(spark, "5"), path, contract, name="2023-04")
    assert values() == [1, 2, 3, 4]
    ledger = {b.batch: b.rows for b in VersionedTable(spark, path).state().batches}
    assert ledger == {"run5/1": 1, "run5/2": 1, "run5/3": 1, "2023-04": 1}
    writers.RunLoader(spark, run="new").load(batch(spark, "7"), path, contract)
    assert values() == [7]


def test_a_refused_batch_leaves_the_target(spark, tmp_path):
    contract, path = S.Contract.of("v int"), str(tmp_path / "t")
    loader = writers.RunLoader(spark, run="a")
    loader.load(batch(spark, "1"), path, contract)
    with pytest.raises(ValueError, match="rejected_v"):
        writers.RunLoader(spark, run="b").load(batch(spark, "x"), path, contract)
    assert [r.v for r in loader.read(path, contract).collect()] == [1]


# -- the warehouse -------------------------------------------------------------------------------


def month(m, n):
    return [{"tpep_pickup_datetime": f"2023-{m:02d}-0{h + 1} 0{h}:00:00",
             "tpep_dropoff_datetime": f"2023-{m:02d}-0{h + 1} 1{h}:00:00"} for h in range(n)]


def contents(warehouse):
    out = {}
    for name in ALL:
        df = warehouse.read(name)
        out[name] = sorted(map(repr, df.drop(*[c for c in df.columns if c.endswith("_loaded_at")]).collect()))
    return out


@pytest.fixture(scope="module")
def raw(spark):
    days = [f"2023-0{m}-0{d}" for m in (1, 2, 3) for d in (1, 2, 3)]
    weather = [(d, "5.0", "1.0", "3.0", "0.0", "0.0") for d in days]
    from data import weather as frame
    return frame(spark, *weather), default_zones(spark)


@pytest.mark.parametrize("step", ["to_gold", "to_serving"])
def test_a_month_run_may_die_after_any_write(spark, tmp_path, monkeypatch, raw, step):
    weather, zones = raw
    scope = Scope.of("2023-01-01", "2023-03-31")
    whole = trips(spark, *month(1, 3), *month(2, 2), *month(3, 1))
    changed = trips(spark, *month(1, 1), *month(2, 3))

    root = tmp_path / "rough"
    Warehouse(spark, str(root), scope).run(whole, weather, zones)
    rough = Warehouse(spark, str(root), scope, months="2023-02,2023-03")
    rough.to_bronze(changed, weather, zones)
    rough.to_silver()
    if step == "to_serving":
        rough.to_gold()
    calm = Warehouse(spark, str(shutil.copytree(root, tmp_path / "calm")), scope, months="2023-02,2023-03")
    getattr(calm, step)()
    want = contents(calm)
    assert len(want["dim_date"]) == 6  # three days of January, three of February
    for at in (1, 2, 3, 6, 8):  # of four tables, files and commit of each; it goes on from one death to the next
        with monkeypatch.context() as patch:
            DiesAt(patch, at)
            with pytest.raises(Died):
                getattr(rough, step)()
    getattr(rough, step)()
    assert contents(rough) == want
    checks.enforce(rough.check_gold())


def test_row_counts_of_a_run_are_those_of_its_months(spark, tmp_path, raw):
    weather, zones = raw
    root, scope = str(tmp_path / "w"), Scope.of("2023-01-01", "2023-03-31")
    full = Warehouse(spark, root, scope)
    full.run(trips(spark, *month(1, 3), *month(2, 2)), weather, zones)
    assert full._rows("fact_trips") == 5 and full._rows("dim_zone") == 2
    assert Warehouse(spark, root, scope, months="2023-02")._rows("silver_trips") == 2
    assert Warehouse(spark, root, Scope.of("2023-01-02", "2023-03-31"))._rows("fact_trips") is None
    report = full.check_silver()
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert [r.violations for r in report.filter("check_name = 'target_below_source'").collect()] == [0, 0, 0]
    assert "bronze_trips" not in plan  # counted by the commit, not by a scan


def test_a_month_of_another_type_is_a_report_row(spark, tmp_path, raw):
    weather, zones = raw
    warehouse = Warehouse(spark, str(tmp_path / "w"), Scope.of("2023-01-01", "2023-03-31"))
    warehouse.run(trips(spark, *month(1, 2), *month(2, 2)), weather, zones)
    mart = warehouse.read("mart_daily_demand").filter("pickup_month = 2")
    odd = mart.withColumn("trip_count", F.col("trip_count").cast("string")).withColumn("extra", F.lit(1))
    warehouse.table("mart_daily_demand").replace_partitions(odd)
    found = warehouse._found("mart_daily_demand")["mart_daily_demand"]
    rows = checks.columns_match(
        spark, found, "mart_daily_demand", S.CONTRACTS["mart_daily_demand"], MONTHS).collect()
    assert [(r.violations, r.missing_columns, r.unexpected_columns, r.mistyped_columns) for r in rows] == [
        (2, "", "extra", "trip_count")]
    assert rows[0].path.endswith("pickup_year=2023/pickup_month=2")
    with pytest.raises(checks.CheckFailed, match="columns_match .*pickup_month=2"):
        checks.enforce(warehouse.check_serving().filter("check_name LIKE 'columns_match%'"))


def test_files_of_two_types_in_one_folder_are_reported(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "v int, s string").coalesce(1).write.parquet(path)
    spark.createDataFrame([("x", "a")], "v string, s string").coalesce(1).write.mode("append").parquet(path)
    found = checks.stored_columns(spark, path)
    assert found == {"v": "int|string", "s": "string"}
    row = checks.columns_match(spark, found, "t", S.Contract.of("v int\ns string")).first()
    assert (row.violations, row.mistyped_columns) == (1, "v")
    by_file = checks.stored_schemas(spark, checks.file_paths(spark, path))
    assert sorted(c["v"] for c in by_file.values()) == ["int", "string"]
