"""Every check must count exactly the faults put into otherwise clean tables."""

import pytest
from data import default_weather, default_zones, trips
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.plans import audit, bronze, checks, gold, marts, silver
from tripmart.sources.scope import Scope

SCOPE = Scope.of("2023-01-01", "2023-03-31")


@pytest.fixture(scope="module")
def t(spark, tmp_path_factory):
    """Clean layer tables, stored so that each test reads settled data."""
    changes = [
        {"tpep_pickup_datetime": f"2023-01-0{d} 0{h}:00:00", "tpep_dropoff_datetime": f"2023-01-0{d} 1{h}:00:00",
         "pulocationid": str(p), "payment_type": str(h)}
        for d in (1, 2) for h in (1, 2, 3) for p in (10, 20)
    ]
    root = tmp_path_factory.mktemp("layers")
    out = {}

    def keep(name, df):
        df.write.parquet(f"{root}/{name}")
        out[name] = spark.read.schema(S.CONTRACTS[name].ddl).parquet(f"{root}/{name}")

    from pyspark.sql import functions as F

    keep("bronze_trips", bronze.bronze_trips(trips(spark, *changes).withColumn("source_file", F.lit("f"))))
    keep("silver_trips", silver.silver_trips(out["bronze_trips"], SCOPE))
    w = bronze.bronze_weather(default_weather(spark)).filter("precipitation_sum IS NOT NULL")
    keep("bronze_weather", w.withColumn("source_file", F.lit("f")))
    keep("bronze_zones", bronze.bronze_zones(default_zones(spark)).withColumn("source_file", F.lit("f")))
    keep("silver_weather", silver.silver_weather(w))
    keep("silver_zones", silver.silver_zones(bronze.bronze_zones(default_zones(spark))))
    keep("dim_date", gold.dim_date(out["silver_trips"]))
    keep("dim_zone", gold.dim_zone(out["silver_zones"]))
    keep("dim_weather", gold.dim_weather(out["silver_weather"]))
    keep("fact_trips", gold.fact_trips(out["silver_trips"], out["dim_weather"], SCOPE))
    f = out["fact_trips"]
    keep("mart_daily_demand", marts.mart_daily_demand(f, out["dim_date"]))
    keep("mart_daily_payment_mix", marts.mart_daily_payment_mix(f))
    keep("mart_weather_impact", marts.mart_weather_impact(f, out["dim_weather"], out["dim_date"]))
    keep("mart_zone_demand", marts.mart_zone_demand(f, out["dim_zone"]))
    return out


def counts(report):
    return {r.check_name: r.violations for r in report.collect()}


def spoil(df, where, **values):
    """Set columns to SQL values on the rows meeting ``where``."""
    return df.withColumns(
        {n: F.when(F.expr(where), F.expr(v)).otherwise(F.col(n)) for n, v in values.items()}
    )


DAY1 = "pickup_date = '2023-01-01'"
ONE_TRIP = "pickup_hour = 1 AND pickup_location_id = 10 AND pickup_date = '2023-01-01'"


def marts_of(t):
    return {n: df for n, df in t.items() if n.startswith("mart_")}


def test_clean_tables_pass_every_suite(t):
    reports = [
        checks.silver_suite(t["silver_trips"], t["bronze_trips"]),
        checks.gold_suite(t["fact_trips"], t["silver_trips"], t["dim_date"], t["dim_zone"], t["dim_weather"]),
        checks.serving_suite(marts_of(t), t["fact_trips"], t["dim_date"], t["dim_zone"], t["dim_weather"]),
    ]
    for report in reports:
        assert checks.enforce(report) == []
        assert {r.violations for r in report.collect()} == {0}


def test_enforce_raises_on_errors_and_returns_warnings(t, caplog):
    bad = spoil(t["fact_trips"], ONE_TRIP, fare_amount="-1.0D")
    warn = checks.violations(bad, "fact", checks.negative_conditions(["fare_amount"]), checks.WARN)
    assert checks.enforce(warn) == ["[fact] negative_fare_amount_rows: 1"]
    error = checks.violations(bad, "fact", checks.negative_conditions(["fare_amount"]))
    with pytest.raises(checks.CheckFailed, match="negative_fare_amount_rows: 1"):
        checks.enforce(warn.unionByName(error))


def test_non_empty(t):
    assert counts(checks.non_empty(t["dim_zone"], "d")) == {"is_empty": 0}
    assert counts(checks.non_empty(t["dim_zone"].limit(0), "d")) == {"is_empty": 1}


def test_columns(spark, t, tmp_path):
    df = t["dim_zone"].withColumnRenamed("zone", "area")
    row = checks.columns_match(spark, dict(df.dtypes), "dim_zone", S.DIM_ZONE).first()
    assert (row.missing_columns, row.unexpected_columns, row.violations) == ("zone", "area", 2)
    shuffled = t["dim_zone"].select(*S.DIM_ZONE.names[::-1])
    found = dict(shuffled.dtypes)
    assert checks.columns_match(spark, found, "dim_zone", S.DIM_ZONE).first().violations == 0
    # one deviating file among good ones is seen
    path = str(tmp_path / "dim_zone")
    t["dim_zone"].write.parquet(path)
    t["dim_zone"].withColumn("more", F.lit(1)).write.mode("append").parquet(path)
    stored = checks.stored_columns(spark, path)
    assert checks.columns_match(spark, stored, "dim_zone", S.DIM_ZONE).first().unexpected_columns == "more"
    with pytest.raises(checks.CheckFailed, match="zone"):
        checks.contract_suite(df, "dim_zone")


def test_row_count_relations(t):
    two, one = t["dim_zone"], t["dim_zone"].limit(1)
    grown = checks.rowcount_relation(one, two, "d")
    assert counts(grown) == {"target_above_source": 1, "target_below_source": 0}
    shrunk = {r.check_name: r.severity for r in checks.rowcount_relation(two, one, "d").collect()}
    assert shrunk["target_below_source"] == "warn"
    strict = checks.rowcount_relation(two, one, "d", may_shrink=False)
    with pytest.raises(checks.CheckFailed, match="target_below_source: 1"):
        checks.enforce(strict)
    assert counts(checks.rowcount_exact(two, one, "d")) == {"rowcount_differs": 1}


@pytest.mark.parametrize("name", sorted(S.UNIQUE_KEYS))
def test_unique_keys(t, name):
    keys = S.UNIQUE_KEYS[name]
    doubled = t[name].unionByName(t[name].limit(1))
    assert set(counts(checks.unique_key(doubled, name, keys)).values()) == {1}
    assert set(counts(checks.unique_key(t[name], name, keys)).values()) == {0}


@pytest.mark.parametrize("name", ["silver_trips", "fact_trips", "dim_date", "mart_zone_demand"])
def test_required_columns_count_each_null(t, name):
    total = t[name].count()
    for column in S.REQUIRED[name][:3]:
        got = counts(checks.required_columns(t[name].withColumn(column, F.lit(None)), name))
        assert {k for k, v in got.items() if v} == {f"{column}_nulls"}
        assert got[f"{column}_nulls"] == total


def test_blank_text(spark):
    df = spark.createDataFrame([("a",), (" ",), (None,)], "zone string")
    assert counts(checks.blank_text(df, "d", ["zone"])) == {"blank_zone_rows": 1}
    assert counts(checks.blank_text(df, "d", ["zone"], null_is_blank=True)) == {"blank_zone_rows": 2}


def test_time_order_parts_and_weather_date(t):
    bad = spoil(t["fact_trips"], ONE_TRIP, dropoff_datetime="pickup_datetime", trip_duration_minutes="0.0D",
                pickup_year="1999", pickup_month="7", weather_date="DATE'2023-01-05'")
    bad = bad.withColumn("pickup_hour", F.when(F.col("pickup_year") == 1999, 5).otherwise(F.col("pickup_hour")))
    assert set(counts(checks.time_order(bad, "f")).values()) == {1}
    assert set(counts(checks.derived_parts(bad, "f")).values()) == {1}
    match = checks.violations(bad, "f", {"m": checks.weather_match_condition()})
    assert counts(match) == {"m": 1}


def test_date_logic_each_rule(t):
    wrong = {"year_num": "1", "quarter_num": "9", "month_num": "13", "day_num_in_month": "40",
             "day_of_week_num": "4", "is_weekend": "NOT is_weekend"}
    first = "date_day = '2023-01-01'"
    for column, value in wrong.items():
        got = counts(checks.violations(spoil(t["dim_date"], first, **{column: value}), "d",
                                       checks.date_logic_conditions()))
        hit = {k for k, v in got.items() if v}
        expected = {"day_of_week_num": {"bad_day_of_week_rows", "bad_weekend_rows"}}.get(column)
        assert (hit == expected) if expected else len(hit) == 1, (column, hit)


def test_date_coverage(t):
    fewer = t["dim_date"].filter("date_day <> '2023-01-01'")
    assert counts(checks.dim_date_coverage(fewer, t["silver_trips"])) == {"rowcount_differs": 1}


def test_weather_flags_each_way(spark):
    df = spark.createDataFrame(
        [(1.0, False, 1.0, False), (0.0, True, 0.0, True), (None, None, 0.0, False), (1.0, True, 0.0, False)],
        "precipitation_sum double, is_rainy_day boolean, snowfall_sum double, is_snowy_day boolean",
    )
    assert set(counts(checks.violations(df, "w", checks.flag_conditions())).values()) == {1}


def test_key_sets_and_foreign_keys(t):
    fewer = spoil(t["fact_trips"], ONE_TRIP, trip_id="'other'")
    assert counts(checks.same_keys(t["silver_trips"], fewer, "f", ["trip_id"])) == {
        "missing_keys": 1, "unexpected_keys": 1
    }
    bad = spoil(t["fact_trips"], ONE_TRIP, pickup_location_id="77", weather_date="NULL")
    bad = bad.withColumn("dropoff_location_id", F.lit(78))
    got = checks.fk_coverage(bad, t["dim_date"].limit(1), t["dim_zone"], t["dim_weather"]).first().asDict()
    assert got["missing_pickup_dim_zone_rows"] == 1 and got["missing_dim_weather_rows"] == 1
    assert got["missing_dropoff_dim_zone_rows"] == bad.count() == 12
    assert got["missing_dim_date_rows"] == 6


def test_descriptor_mismatches_and_null_descriptors(t):
    d = t["mart_daily_demand"]
    for column, value in {"month_name": "'May'", "is_weekend": "NOT is_weekend", "quarter_num": "4"}.items():
        assert checks.demand_vs_dim_date(spoil(d, DAY1, **{column: value}), t["dim_date"]).count() == 1
    unknown = spoil(d, DAY1, pickup_date="DATE'2030-01-01'")
    assert checks.demand_vs_dim_date(unknown, t["dim_date"]).count() == 1

    z = t["mart_zone_demand"]
    null = spoil(z, f"{DAY1} AND pickup_location_id = 10", borough="CAST(NULL AS string)")
    assert checks.zone_vs_dim_zone(null, t["dim_zone"]).count() == 0
    assert checks.zone_vs_dim_zone(null, t["dim_zone"], null_safe=True).count() == 1

    w = t["mart_weather_impact"]
    for column, value in {"temperature_max": "0.5D", "is_rainy_day": "NOT is_rainy_day",
                          "weather_date": "DATE'2023-01-02'"}.items():
        bad = spoil(w, DAY1, **{column: value})
        assert checks.weather_vs_dims(bad, t["dim_date"], t["dim_weather"]).count() == 1, column


@pytest.mark.parametrize("name", ["mart_daily_demand", "mart_weather_impact", "mart_zone_demand",
                                  "mart_daily_payment_mix"])
def test_reconciliation_with_the_fact(t, name):
    negatives = name != "mart_daily_payment_mix"

    def failed(df):
        row = checks.reconcile_mart(df, t["fact_trips"], S.UNIQUE_KEYS[name], negatives).first()
        return row.violations

    mart = t[name]
    one = mart.limit(1)
    rest = mart.exceptAll(one)
    assert failed(mart) == 0
    assert failed(rest) == 3  # rows, trips, revenue
    more = one.withColumn("trip_count", F.col("trip_count") + 1).unionByName(rest)
    assert failed(more) == 1
    close = one.withColumn("total_revenue", F.col("total_revenue") + 0.005).unionByName(rest)
    apart = one.withColumn("total_revenue", F.col("total_revenue") + 0.02).unionByName(rest)
    assert (failed(close), failed(apart)) == (0, 1)
    if negatives:
        column = "negative_total_amount_trip_count"
        assert failed(one.withColumn(column, F.col(column) + 1).unionByName(rest)) == 1


def test_labels_and_shares(t):
    mix = t["mart_daily_payment_mix"]
    first = f"{DAY1} AND payment_type_code = 1"
    assert checks.label_mismatches(spoil(mix, first, payment_type_name="'Cash'")).count() == 1
    moved = spoil(mix, first, payment_trip_share_pct="payment_trip_share_pct + 0.001D",
                  payment_revenue_share_pct="-0.5D")
    got = counts(checks.share_checks(moved))
    assert got == {"out_of_range_trip_share_rows": 0, "out_of_range_revenue_share_rows": 1,
                   "bad_trip_share_days": 1, "bad_revenue_share_days": 1}
    severities = {r.check_name: r.severity for r in checks.share_checks(moved).collect()}
    assert severities["out_of_range_revenue_share_rows"] == "warn"
    small = spoil(mix, first, payment_trip_share_pct="payment_trip_share_pct + 0.00005D")
    assert set(counts(checks.share_checks(small)).values()) == {0}


def test_revenue_shares_are_not_summed_on_days_without_revenue(spark):
    mix = spark.createDataFrame(
        [("d", 0.5, 0.0, 5.0), ("d", 0.5, 0.0, -5.0)],
        "pickup_date string, payment_trip_share_pct double, payment_revenue_share_pct double, total_revenue double",
    )
    assert set(counts(checks.share_checks(mix)).values()) == {0}


def test_cross_mart_checks(t):
    d, z, p = t["mart_daily_demand"], t["mart_zone_demand"], t["mart_daily_payment_mix"]
    first = f"{DAY1} AND pickup_location_id = 10"
    by_zone = checks.daily_totals(spoil(z, first, total_revenue="total_revenue + 0.02D"), negatives=True)
    assert checks.cross_mart_mismatches(d, by_zone).count() == 1
    by_code = checks.daily_totals(p.filter(f"NOT ({DAY1})"), negatives=False)
    assert checks.cross_mart_mismatches(d, by_code, negatives=False).count() == 1
    w = spoil(t["mart_weather_impact"], DAY1, negative_total_amount_trip_count="9L")
    assert checks.cross_mart_mismatches(d, w).count() == 1
    assert checks.cross_mart_mismatches(d, t["mart_weather_impact"]).count() == 0


def test_scope_reports(t):
    bad = spoil(t["silver_trips"], ONE_TRIP, pickup_date="DATE'2022-12-31'", pickup_month="12", pickup_year="2022")
    got = counts(audit.scope_summary(bad, "s", SCOPE, ["pickup_date"], ["pickup_year", "pickup_month"]))
    assert got == {"pickup_date_out_of_scope": 1, "partition_out_of_scope": 1}
    detail = audit.scope_detail(bad, SCOPE, ["pickup_date"], ["pickup_year", "pickup_month"]).collect()
    assert [(str(r.pickup_date), r.row_count) for r in detail] == [("2022-12-31", 1)]


def test_quality_profiles_find_single_faults(t):
    bad = spoil(t["fact_trips"], ONE_TRIP, trip_distance="-1.0D", total_amount="CAST(NULL AS double)")
    row = audit.fact_quality_profile(bad).first().asDict()
    assert {k for k, v in row.items() if v} == {"negative_trip_distance_rows", "total_amount_nulls"}
    assert len(row) == 30
    clean = audit.silver_quality_profile(t["silver_trips"]).first().asDict()
    assert len(clean) == 17 and set(clean.values()) == {0}


def test_raw_status(spark, t):
    raw = t["bronze_trips"]
    w = spark.sql("SELECT DATE'2023-01-01' AS date, 1D temperature_2m_mean, 1D precipitation_sum, 1D snowfall_sum")
    gap = w.unionByName(w.withColumn("date", F.lit("2023-01-03").cast("date")))
    z = t["silver_zones"]
    assert audit.raw_status_summary(raw, w, z).first().raw_layer_status == "PASS"
    late = audit.raw_status_summary(raw, gap, z).first()
    assert (late.raw_layer_status, late.missing_days) == ("CHECK_REQUIRED", 1)
    twice = audit.raw_status_summary(raw, w, z.unionByName(z.limit(1))).first()
    assert (twice.raw_layer_status, twice.duplicate_location_ids) == ("CHECK_REQUIRED", 1)
    assert [str(r[0]) for r in audit.calendar_gaps(gap).collect()] == ["2023-01-02"]
    assert audit.calendar_gaps(gap.limit(0)).count() == 0
    none = audit.raw_status_summary(raw.limit(0), w, z).first()
    assert none.raw_layer_status == "CHECK_REQUIRED"


def test_one_scan_per_profile(t):
    plan = audit.fact_quality_profile(t["fact_trips"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
