import datetime as dt
import json
from datetime import date

import pytest
from data import TRIP, trips
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.plans import bronze, checks
from tripmart.sources import readers, writers
from tripmart.sources.scope import Scope, in_months, month_list


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture
def csv_root(tmp_path):
    header = ",".join(S.TRIPS_RAW.names)
    line = ",".join(TRIP[n] or "" for n in S.TRIPS_RAW.names)
    write(tmp_path / "year=2023/month=01/trips_2023-01.csv", header, line, line.replace("16.0", "17.5"))
    write(tmp_path / "year=2023/month=02/trips_2023-02.csv", header, line.replace("2023-01-01", "2023-02-01"))
    write(tmp_path / "year=2023/month=02/notes.txt", "not,a,trip")
    return tmp_path


def test_csv_scan_is_recursive_with_lineage(spark, csv_root):
    raw = readers.read_trips_csv(spark, str(csv_root), pattern="*.csv")
    assert raw.columns == [*S.TRIPS_RAW.names, "source_file"]
    got = readers.month_of_file(bronze.bronze_trips(raw)).groupBy("file_month").count().collect()
    assert {r.file_month: r["count"] for r in got} == {"2023-01": 2, "2023-02": 1}


def test_csv_scan_without_files_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_trips_csv(spark, str(tmp_path / "nowhere"))
    with pytest.raises(FileNotFoundError):
        readers.read_trips_csv(spark, str(tmp_path), pattern="*.csv")


def test_csv_delimiter_inference_and_untyped_count(spark, tmp_path):
    write(tmp_path / "w.csv", "date;amount", "2023-01-01;1.5", "2023-01-02;2.5")
    df = readers.read_csv(spark, str(tmp_path), sep=";", infer=True, lineage=False)
    assert df.dtypes == [("date", "date"), ("amount", "double")]
    assert readers.read_csv(spark, str(tmp_path), sep=";").count() == 2


def test_stored_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_stored(spark, str(tmp_path / "none"), "t")
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        readers.read_stored(spark, str(tmp_path / "empty"), "t")
    path = str(tmp_path / "t")
    spark.range(10).withColumn("m", F.col("id") % 2).write.partitionBy("m").parquet(path)
    df = readers.read_stored(spark, path, "t")
    assert df.columns == ["id", "m"]
    plan = df.filter("m = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan
    readers.register_views(spark, {"v_t": path})
    assert spark.sql("SELECT count(*) FROM v_t WHERE m = 0").first()[0] == 5


def test_headers(spark, tmp_path):
    write(tmp_path / "good.csv", "LocationID,Borough", "1,a", "2,b")
    write(tmp_path / "quoted.csv", '"LocationID","Borough"', "1,a")
    write(tmp_path / "order.csv", "Borough,LocationID", "LocationID,Borough")
    write(tmp_path / "bare.csv", "LocationID,Borough")
    rows = readers.header_report(spark, str(tmp_path), ["LocationID", "Borough"], pattern="*.csv").collect()
    got = {r.source_file.rsplit("/", 1)[1]: (r.header_ok, r.data_rows, r.has_rows) for r in rows}
    assert got == {"good.csv": (True, 2, True), "quoted.csv": (True, 1, True),
                   "order.csv": (False, 1, True), "bare.csv": (True, 0, False)}
    loose = readers.header_report(spark, str(tmp_path / "good.csv"), ["locationid", "borough"], sanitized=True)
    assert loose.first().header_ok


def test_headers_are_read_as_csv(spark, tmp_path):
    write(tmp_path / "comma.csv", '"a,x",b', "1,2", "", '"3,4",5')
    write(tmp_path / "blank.csv", '"a,x",b', "")
    write(tmp_path / "long.csv", '"a,x",b,c', "1,2,3")
    (tmp_path / "empty.csv").write_bytes(b"")
    rows = readers.header_report(spark, str(tmp_path), ["a,x", "b"], pattern="*.csv").collect()
    got = {r.source_file.rsplit("/", 1)[1]: (r.header_ok, r.data_rows, r.has_rows) for r in rows}
    assert got == {"comma.csv": (True, 2, True), "blank.csv": (True, 0, False),
                   "long.csv": (False, 1, True), "empty.csv": (False, 0, False)}
    write(tmp_path / "caret.txt", "a^b", "1^2")
    row = readers.header_report(spark, str(tmp_path / "caret.txt"), ["a", "b"], sep="^").first()
    assert (row.header_ok, row.data_rows) == (True, 1)


def test_header_of_a_file_read_in_many_splits(spark, tmp_path):
    write(tmp_path / "big.csv", "a,b", *["x,y"] * 5000, "a,b")
    write(tmp_path / "bad.csv", "x,y", *["a,b"] * 5000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = readers.header_report(spark, str(tmp_path), ["a", "b"], pattern="*.csv").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {r.source_file.rsplit("/", 1)[1]: (r.header_ok, r.data_rows) for r in rows}
    assert got == {"big.csv": (True, 5001), "bad.csv": (False, 5000)}


def test_headers_take_one_read_of_each_file(spark, tmp_path):
    for k in range(3):
        write(tmp_path / f"p={k}" / f"odd name {k}.csv", "a,b", "1,2", " \t", "3,4")
    report = readers.header_report(spark, str(tmp_path), ["a", "b"], pattern="*.csv")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.count("FileScan") == 1
    assert sorted((r.header_ok, r.data_rows) for r in report.collect()) == [(True, 2)] * 3


def test_monthly_source(spark):
    source = spark.createDataFrame(
        [(1, dt.datetime(2023, 1, 1, 8, 0, 0, 700000), "bad", 1.0, "2.5", 1.0, "N", 10, 20, None,
          *[1.0] * 7, 0.25)],
        "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime string, passenger_count double, "
        "trip_distance string, RatecodeID double, store_and_fwd_flag string, PULocationID int, DOLocationID int, "
        "payment_type bigint, fare_amount double, extra double, mta_tax double, tip_amount double, "
        "tolls_amount double, improvement_surcharge double, total_amount double, AIRPORT_FEE double",
    )
    got = readers.normalize_trip_source(source)
    assert got.columns == S.TRIPS_RAW.names
    row = got.first()
    assert row.tpep_pickup_datetime == dt.datetime(2023, 1, 1, 8) and row.tpep_dropoff_datetime is None
    assert (row.trip_distance, row.airport_fee, row.congestion_surcharge) == (2.5, 0.25, None)
    with pytest.raises(ValueError, match="pulocationid"):
        readers.normalize_trip_source(source.drop("PULocationID"))


def test_parallel_arrays(spark, tmp_path):
    fields = S.WEATHER_RAW.names[1:]
    good = {"daily": {"time": ["2023-01-01", "2023-01-02"], **{f: [1.0, None] for f in fields}}}
    short = {"daily": {**good["daily"], "snowfall_sum": [1.0]}}
    absent = {"daily": {k: v for k, v in good["daily"].items() if k != "precipitation_sum"}}
    empty = {"daily": {"time": [], **{f: [] for f in fields}}}
    for name, doc in {"good": good, "short": short, "absent": absent, "empty": empty, "none": {}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=1))
    docs = readers.read_daily_json(spark, str(tmp_path)).withColumn(
        "doc", F.regexp_extract("_metadata.file_name", "^[a-z]+", 0)
    )
    flat = readers.flatten_parallel_arrays(docs, ["doc"], fields)
    assert flat.columns == ["doc", *S.WEATHER_RAW.names]
    assert [(r.doc, r.date, r.snowfall_sum) for r in flat.orderBy("date").collect()] == [
        ("good", "2023-01-01", 1.0), ("good", "2023-01-02", None)
    ]
    report = readers.parallel_array_report(docs, ["doc"], fields).filter("NOT is_usable").collect()
    found = {(r.doc, r.field) for r in report}
    assert ("short", "snowfall_sum") in found and ("absent", "precipitation_sum") in found
    assert not [d for d, _ in found if d == "good"]
    assert {("empty", "time"), ("none", "time")} <= found


def test_month_lists():
    assert month_list(" 2023-02,2023-01 ,2023-02,") == ["2023-02", "2023-01"]
    assert month_list(["2023-01", " 2023-01"]) == ["2023-01"]
    assert month_list(None) == [] and month_list("") == []
    for bad in ("2023-13", "2023-1", "202301", "2023-00"):
        with pytest.raises(ValueError, match=bad):
            month_list(bad)
    assert Scope.covering("2024-02,2023-11") == Scope(date(2023, 11, 1), date(2024, 2, 29))
    assert Scope.of("2023-01-01", "2023-03-31").days == 90
    with pytest.raises(ValueError):
        Scope.covering([])


def test_scope_predicates(spark):
    scope = Scope.of("2022-12-15", "2023-02-10")
    df = spark.createDataFrame([(2022, 11), (2022, 12), (2023, 1), (2023, 2), (2023, 3)], "y int, m int")
    y, m = F.col("y"), F.col("m")
    inside = [tuple(r) for r in df.filter(scope.has_month(y, m)).collect()]
    assert inside == [(2022, 12), (2023, 1), (2023, 2)]
    assert [tuple(r) for r in df.filter(scope.outside_month(y, m)).collect()] == [(2022, 11), (2023, 3)]
    assert [tuple(r) for r in df.filter(in_months(y, m, "2022-11,2023-02")).collect()] == [(2022, 11), (2023, 2)]


MONTHS = ["pickup_year", "pickup_month"]


def month_rows(spark, *records):
    return spark.createDataFrame(list(records), "v int, pickup_year int, pickup_month int")


def stored(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("v", *MONTHS).collect())


def test_partitioned_write_replaces_only_its_months(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.write_table(month_rows(spark, (1, 2023, 1), (2, 2023, 2)), path, MONTHS) == 2
    assert writers.write_table(month_rows(spark, (9, 2023, 2)), path, MONTHS) == 1
    assert stored(spark, path) == [(1, 2023, 1), (9, 2023, 2)]


def test_unpartitioned_write_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(month_rows(spark, (1, 2023, 1)), path)
    writers.write_table(month_rows(spark, (2, 2023, 2)), path)
    assert stored(spark, path) == [(2, 2023, 2)]


def test_heavy_month_is_split_over_tasks(spark, tmp_path):
    """A month with nearly all rows must not be written by a single task."""
    path = str(tmp_path / "t")
    df = spark.range(0, 400_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.lit(2023).alias("pickup_year"),
        F.when(F.col("id") % 100 == 0, 2).otherwise(1).alias("pickup_month"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "2MB")
    try:
        writers.write_table(df, path, MONTHS)
    finally:
        spark.conf.set(size, before)
    files = spark.read.parquet(path).filter("pickup_month = 1").select("_metadata.file_path").distinct()
    assert files.count() > 3


def test_flat_export(spark, tmp_path):
    contract = S.Contract.of("v int\npickup_month int")
    source, out = str(tmp_path / "t"), str(tmp_path / "out")
    writers.write_table(month_rows(spark, (1, 2023, 1), (2, 2023, 2)), source, MONTHS)
    row = writers.export_flat(spark.read.parquet(source), out, contract, 1).first()
    assert (row.source_rows, row.exported_rows, row.violations) == (2, 2, 0)
    exported = spark.read.parquet(out)
    assert exported.columns == ["v", "pickup_month"] and len(exported.inputFiles()) == 1


def test_truncate_once_then_append(spark, tmp_path):
    contract, path = S.Contract.of("v int"), str(tmp_path / "t")
    def batch(v):
        return spark.createDataFrame([(v,)], "v string")

    writers.RunLoader(spark).load(batch("1"), path, contract)
    run = writers.RunLoader(spark)
    run.load(batch("2"), path, contract)
    run.load(batch("3"), path, contract)
    assert sorted(r.v for r in run.read(path, contract).collect()) == [2, 3]
    writers.RunLoader(spark, truncate=False).load(batch("4"), path, contract)
    assert run.read(path, contract).count() == 3


def test_partition_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(month_rows(spark, (1, 2023, 1), (2, 2023, 2)), path, MONTHS)
    df = spark.read.parquet(path)
    report = {r.check_name: r.violations for r in checks.partition_coverage(df, "t", MONTHS).collect()}
    assert report == {"no_partitions": 0, "rows_outside_folder": 0}
    none = {r.check_name: r.violations for r in checks.partition_coverage(df.limit(0), "t", MONTHS).collect()}
    assert none["no_partitions"] == 1


def test_bronze_of_repeated_trips_keeps_them(spark):
    assert bronze.bronze_trips(trips(spark, {}, {})).count() == 2


def test_landing_files_are_packed_and_read_back(spark):
    """Text files of all inputs are compressed, and trips are dealt before they become text."""
    from tripmart import bindings
    from tripmart.store import Layers

    folder = "/root/testdata/sf0.001"
    layers = Layers(spark, folder)
    for name, raw in (("trips", layers.trips_raw()), ("weather", layers.weather_raw()), ("zones", layers.zones_raw())):
        landed = layers.landed(name)
        assert landed.inputFiles() and all(f.endswith(".csv.gz") for f in landed.inputFiles())
        assert landed.count() == raw.count()
    text = bindings.trips_text(spark, folder).drop("source_file")
    assert landed_trips(layers, text).exceptAll(text).isEmpty()


def landed_trips(layers, like):
    """Landed trips with text as it was before blanks at its ends were dropped."""
    df = layers.landed("trips").withColumn("store_and_fwd_flag", F.concat(F.lit(" "), F.trim("store_and_fwd_flag"), F.lit(" ")))
    return df.select(*like.columns)
