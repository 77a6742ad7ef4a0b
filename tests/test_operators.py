import pytest
from pyspark.sql import functions as F

from tripmart.operators import aggregates as A
from tripmart.operators import lookups as L
from tripmart.operators.dedupe import dedupe_by_key, dedupe_few_copies
from tripmart.plans.audit import except_counts
from tripmart.plans.checks import money_differs


def test_dedupe_keeps_the_same_row_whatever_the_order(spark, rows):
    data = [("a", 3, "z"), ("a", 1, "y"), ("a", None, "x"), ("b", 2, "w"), (None, 1, "v"), (None, 0, "u")]
    first = dedupe_by_key(spark.createDataFrame(data, "k string, n int, t string"), ["k"])
    again = dedupe_by_key(
        spark.createDataFrame(data[::-1], "k string, n int, t string").repartition(4), ["k"]
    )
    assert rows(first) == rows(again) == sorted(
        [("a", None, "x"), ("b", 2, "w"), (None, 0, "u")], key=repr
    )


def test_hot_key_is_reduced_before_the_exchange(spark):
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    unique = dedupe_by_key(df, ["k"])
    assert unique.count() == 20001
    assert unique.filter("k = -1").first().v == 0
    plan = unique._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "Partial" in plan[exchange:] and "Final" in plan[:exchange]


def test_few_copies_give_the_same_rows(spark, rows, tmp_path):
    data = [("a", 3, "z"), ("a", 1, "y"), ("a", None, "x"), ("b", 2, "w"), (None, 1, "v"), (None, 0, "u")]
    data += [(f"k{i}", i, "t") for i in range(500)]
    df = spark.createDataFrame(data, "k string, n int, t string").repartition(3)
    want = rows(dedupe_by_key(df, ["k"]))
    for bound in (1_000_000, 1):
        assert rows(dedupe_few_copies(df, ["k"], bound=bound)) == want
    assert rows(dedupe_few_copies(df, ["k"], ["t", "n"])) == rows(dedupe_by_key(df, ["k"], ["t", "n"]))
    assert rows(dedupe_few_copies(df.filter("n > 10"), ["k", "t"])) == rows(df.filter("n > 10"))
    assert dedupe_few_copies(df.limit(0), ["k"]).collect() == []


def test_few_copies_alone_are_shuffled(spark, tmp_path):
    wide = spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 100 == 0, F.col("id") - 1).otherwise(F.col("id")).alias("k"),
        F.md5(F.col("id").cast("string")).alias("v"))
    wide.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))

    def shuffled(df):
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        nodes, sizes = [df._jdf.queryExecution().executedPlan()], 0
        while nodes:
            node = nodes.pop()
            kind = node.nodeName()
            if kind == "AdaptiveSparkPlan":
                nodes.append(node.executedPlan())
            elif kind.endswith("QueryStage"):
                nodes.append(node.plan())
            else:
                if kind == "Exchange":
                    sizes += node.metrics().apply("shuffleRecordsWritten").value()
                children = node.children()
                nodes += [children.apply(i) for i in range(children.size())]
        return sizes

    few, every = dedupe_few_copies(stored, ["k"]), dedupe_by_key(stored, ["k"])
    assert few.count() == every.count() == 20000 - 199
    assert shuffled(every) >= 19000 and shuffled(few) <= 400


def test_left_lookup_keeps_rows_and_renames(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    table = spark.createDataFrame([(1, "one"), (3, "three")], "id int, v string")
    got = L.left_lookup(left, table, {"k": "id"}, {"name": "v"})
    assert rows(got) == sorted([(1, "a", "one"), (2, "b", None), (None, "c", None)], key=repr)


def test_broadcast_only_with_a_proven_bound(spark):
    left = spark.range(10).withColumnRenamed("id", "k")
    table = spark.range(10).withColumn("x", F.lit(1))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        def plan(bound):
            df = L.left_lookup(left, table, {"k": "id"}, ["x"], bound)
            return df._jdf.queryExecution().executedPlan().toString()

        assert "BroadcastHashJoin" in plan(90)
        assert "BroadcastHashJoin" not in plan(None)
        assert "BroadcastHashJoin" not in plan(L.BROADCAST_ROWS + 1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unmatched_counts_weigh_rows_and_count_null_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 9), (8, 9), (None, 1)], "p int, d int")
    zones = spark.createDataFrame([(1,), (2,)], "z int")
    got = L.unmatched_counts(df, {"p_out": ("p", zones, "z", None), "d_out": ("d", zones, "z", None)})
    assert got.first() == (2, 2)
    assert L.unmatched_counts(df.limit(0), {"p_out": ("p", zones, "z", None)}).first() == (0,)


def test_orphans_and_key_sets(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (3,)], "k int")
    assert rows(L.orphan_rows(a, b, {"k": "k"})) == sorted([(2,), (None,)], key=repr)
    assert rows(L.missing_keys(b, a.na.drop(), ["k"])) == [(2,)]
    assert L.keyset_difference(a.na.drop(), b, ["k"]).first() == (1, 1)


def test_differing_with_null_and_tolerance(spark):
    df = spark.createDataFrame([(1.0, 1.005), (1.0, 1.02), (None, 1.0)], "a double, b double")
    def flags(**kw):
        return [r.v for r in df.select(L.differing(F.col("a"), F.col("b"), **kw).alias("v")).collect()]

    assert flags() == [True, True, None]
    assert flags(null_safe=True) == [True, True, True]
    assert flags(tolerance=0.01) == [False, True, None]
    assert flags(tolerance=0.01, null_safe=True) == [False, True, True]


def test_full_outer_mismatches(spark, rows):
    a = spark.createDataFrame([(1, 5, 1.0), (2, 5, 1.0), (3, 5, 1.0)], "d int, n int, m double")
    b = spark.createDataFrame([(1, 5, 1.005), (2, 6, 1.0), (4, 5, 1.0)], "d int, n int, m double")
    got = L.full_outer_mismatches(a, b, ["d"], {"n": "n"}, {"m": "m"})
    assert sorted(r.d for r in got.collect()) == [2, 3, 4]


def test_profile_counts_zero_on_nothing(spark):
    df = spark.createDataFrame([], "a int")
    got = A.profile(df, A.null_conditions(["a"]), row_count=F.count("*"))
    assert got.first().asDict() == {"row_count": 0, "a_nulls": 0}
    assert df.agg(A.total_or_zero("a")).first()[0] == 0.0


def test_side_by_side_needs_no_join(spark):
    a = spark.range(3).agg(F.count("*").alias("x"))
    b = spark.range(5).agg(F.count("*").alias("y"), F.max("id").alias("z"))
    both = A.side_by_side(a, b)
    assert both.first().asDict() == {"x": 3, "y": 5, "z": 4}
    assert "Join" not in both._jdf.queryExecution().executedPlan().toString()


def test_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a")], "k int, t string")
    assert rows(A.duplicate_groups(df, ["k", "t"])) == sorted([(1, "a", 2), (None, "a", 2)], key=repr)
    assert A.duplicate_group_count(df, ["k", "t"], "n").first() == (2,)


def test_shares_of_zero_and_negative_totals(spark):
    df = spark.createDataFrame(
        [("zero", 1, 5.0), ("zero", 1, -5.0), ("refund", 3, 20.0), ("refund", 1, -10.0),
         ("one", 4, 8.0), ("none", 0, 0.0)],
        "d string, n int, m double",
    )
    got = A.share_of_total(df, ["d"], {"ns": "n", "ms": "m"}, positive_only=["ns"])
    by = {(r.d, r.m): (r.ns, r.ms) for r in got.collect()}
    assert by[("zero", 5.0)] == (0.5, 0.0)
    assert by[("refund", -10.0)] == (0.25, -1.0) and by[("refund", 20.0)] == (0.75, 2.0)
    assert by[("one", 8.0)] == (1.0, 1.0)
    assert by[("none", 0.0)] == (0.0, 0.0)


def test_grand_share(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n bigint")
    got = {r.k: r.s for r in A.grand_share(counts, "n", "s").collect()}
    assert got == {"a": 33.33, "b": 66.67}


def test_top_by_breaks_ties_on_the_key(spark):
    df = spark.createDataFrame([(3, 5), (1, 5), (2, 5), (4, 9)], "k int, n int")
    assert [r.k for r in A.top_by(df, ["n"], ["k"], 3).collect()] == [4, 1, 2]
    plan = A.top_by(df, ["n"], ["k"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_overview_pads_missing_dates(spark):
    df = spark.sql("SELECT DATE'2023-01-01' AS d UNION ALL SELECT DATE'2023-01-05'")
    got = {r.dataset_name: r for r in A.overview({"dated": (df, "d"), "plain": (df, None)}).collect()}
    assert str(got["dated"].min_date) == "2023-01-01" and got["dated"].row_count == 2
    assert got["plain"].min_date is None and got["plain"].row_count == 2


@pytest.mark.parametrize("n", [0, 7])
def test_row_counts(spark, n):
    assert A.row_counts({"a": spark.range(n), "b": spark.range(2)}).first() == (n, 2)


def digest_rows(spark, n, salt=0):
    return spark.range(n).selectExpr(f"sha2(concat(id, '-{salt}'), 256) AS k", "int(id % 3) AS m")


def test_keysets_are_compared_by_digests(spark):
    left = digest_rows(spark, 5000)
    more = left.unionByName(spark.createDataFrame([("new", 1), (None, 2)], "k string, m int"))
    fewer = left.filter("k NOT LIKE '0%'")
    for a, b in ((left, left), (left, more), (more, left), (fewer, more), (left.limit(0), left), (left.limit(0), left.limit(0))):
        for within in ([], ["m"]):
            got = L.keyset_differences(a, b, ["k"], within, buckets=64).first()
            assert got == L.keyset_difference(a, b, ["k"]).first()
    moved = left.withColumn("m", F.col("m") + 1)
    assert L.keyset_differences(left, moved, ["k"], ["m"]).first() == (0, 0)
    assert L.keyset_differences(left, left.unionByName(left), ["k"]).first() == (0, 0)
    # {a, a, b} and {c, c, b} have equal counts and equal exclusive ors
    few = [spark.createDataFrame([(x,) for x in text], "k string") for text in ("aab", "ccb")]
    assert L.keyset_differences(*few, ["k"], buckets=1).first() == (1, 1)


def exchanged_rows(df):
    """Rows written to exchanges by what is executed, from the final plan's metrics."""
    df.collect()
    plan, out = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Exchange":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(out)


def test_equal_tables_exchange_no_keys(spark, tmp_path):
    digest_rows(spark, 100_000).write.parquet(str(tmp_path / "a"))
    left, right = (spark.read.parquet(str(tmp_path / "a")) for _ in range(2))
    assert exchanged_rows(L.keyset_difference(left, right, ["k"])) >= 200_000
    assert exchanged_rows(L.keyset_differences(left, right, ["k"], buckets=32)) < 2_000
    # a single deviation exchanges one bucket in 32 of either side
    assert exchanged_rows(L.keyset_differences(left, right.filter("k NOT LIKE '0000%'"), ["k"], buckets=4096)) < 2_000 * 50


def test_except_counts_are_those_of_except(spark):
    """Keys of any text, null, and copies; upper case, odd and no digits are not the bytes they resemble."""
    texts = ["", "ab", "AB", "Ab", "abc", "0abc", "0ABC", "zz", None, "ab", None, "\u00e9", "00", "0", " ab", "a" * 64]
    frames = [spark.createDataFrame([(x,) for x in t], "k string")
              for t in (texts, texts[1::2], texts[::3] + ["cd", "c", "cd"], [None], [])]
    numbers = [spark.createDataFrame([(x,) for x in t], "k int") for t in ([1, 2, 2, None], [10, 2])]
    for a in frames:
        for b in frames:
            assert except_counts(a, b, "k", "x", "y").first() == (a.subtract(b).count(), b.subtract(a).count())
    assert except_counts(*numbers, "k", "x", "y").first() == (2, 1)
    as_text = spark.createDataFrame([("2",), ("12",)], "k string")
    assert except_counts(numbers[0], as_text, "k", "x", "y").first() == (2, 1)


def test_except_counts_exchange_each_side_once(spark):
    """Copies go before the exchange, and no side goes through another one after it."""
    left = digest_rows(spark, 20_000)
    twice, right = left.unionByName(left).repartition(1), left.filter("k < '8'")
    df = except_counts(twice, right, "k", "x", "y")
    few = 200  # counts of tasks, and the rows of the test's own repartition on top
    assert exchanged_rows(df) <= 40_000 + 20_000 + right.count() + few
    assert df.first() == (20_000 - right.count(), 0)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "unhex(" in plan


def test_money_adds_up_to_the_cent(spark):
    cents = F.expr("id % 9973 * 7 - 31000")
    df = spark.range(1_000_000).select((F.col("id") % 3).alias("k"), cents.alias("cents"), (cents / 100).alias("money"))
    exact = {r.k: r.c / 100 for r in df.groupBy("k").agg(F.sum("cents").alias("c")).collect()}
    for parts in (1, 7):
        dealt = df.repartition(parts, F.rand(parts))
        assert {r.k: r.m for r in dealt.groupBy("k").agg(A.money_sum("money").alias("m")).collect()} == exact


def test_money_beyond_the_limit_and_no_numbers(spark):
    def total(*amounts):
        df = spark.createDataFrame([(a,) for a in amounts], "m double")
        return df.agg(A.money_sum("m")).first()[0]

    assert total() is None and total(None, None) is None
    assert total(0.1, None, 0.2) == 0.3 and total(-0.0) == 0.0
    assert total(1e300, 1.0, -1e300) == 1.0
    assert total(float("inf"), 1.0) == float("inf") and str(total(float("nan"), 1.0)) == "nan"


def test_many_rows_of_cents_show_a_cent_too_much(spark):
    n = 10**8  # with 10**9 it takes a minute
    fares = spark.range(0, n, 1, 8).select((F.expr("id % 10000") / 100).alias("m"))
    more = fares.union(spark.range(1).select(F.lit(0.01)))
    whole, off = (df.agg(A.money_sum("m").alias("m")).first().m for df in (fares, more))
    assert whole == n // 10000 * sum(range(10000)) / 100
    sides = spark.createDataFrame([(whole, whole), (whole, off)], "a double, b double")
    assert [r.d for r in sides.select(money_differs(F.col("a"), F.col("b")).alias("d")).collect()] == [False, True]
