import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripmart import schemas as S
from tripmart.functions import parsing
from tripmart.functions.calendar import calendar_attributes, minutes_between
from tripmart.functions.keys import payment_label, surrogate_key
from tripmart.operators import columns as C


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_timestamps_that_do_not_parse_become_null(spark):
    texts = ["2023-01-02 03:04:05", "2023-13-02 03:04:05", "2023-01-02", "", " ", None, "x",
             "2023-01-02T03:04:05", "2023-02-30 00:00:00"]
    got = values(spark, texts, parsing.parse_timestamp)
    assert got == [dt.datetime(2023, 1, 2, 3, 4, 5)] + [None] * 8


def test_wall_clock_times_survive_a_daylight_saving_gap(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = values(spark, ["2023-03-12 02:30:00"], parsing.parse_timestamp)
        assert got == [dt.datetime(2023, 3, 12, 2, 30)]
        df = spark.sql(
            "SELECT TIMESTAMP_NTZ'2023-03-12 01:30:00' a, TIMESTAMP_NTZ'2023-03-12 03:30:00' b"
        )
        assert df.select(minutes_between(F.col("a"), F.col("b"))).first()[0] == 120.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dates(spark):
    texts = ["2023-01-02", "2023/01/02", "2023-1-2", "2023-00-10", None]
    assert values(spark, texts, parsing.parse_date) == [dt.date(2023, 1, 2)] + [None] * 4


def test_integers_accept_a_decimal_form_and_keep_large_values(spark):
    texts = ["7", "7.0", "7.9", "-7.9", "9007199254740993", "abc", "", None, "1e400"]
    got = values(spark, texts, parsing.parse_integer)
    assert got == [7, 7, 7, -7, 9007199254740993, None, None, None, None]


@pytest.mark.parametrize("to", ["int", "bigint"])
def test_only_integer_text_is_cast_directly(spark, to):
    """Other text goes by way of a double: a failing cast takes as long as hundreds of good ones."""
    read = ["5", " 7\t", "\x7f+9\x00", "-3", "00012"]
    rest = ["5.0", "", " ", "-", "--5", "n/a", "1e3", "0x1p3", "NaN", "-Infinity", ".5", "1 2", "5L", "5\u0085", "\u00a05", None]
    df = spark.createDataFrame([(t,) for t in read + rest], "t string")
    sql, direct = parsing.typed_sql(df, "t", to), f"try_cast(`t` AS {to})"
    strict = sql.replace(direct, f"CAST(`t` AS {to})")
    assert strict != sql
    plain = f"coalesce({direct}, try_cast(try_cast(`t` AS double) AS {to}))"
    spark.conf.set("spark.sql.ansi.enabled", True)
    try:
        got = df.select(F.expr(strict), F.expr(plain), parsing.parse_integer(F.col("t"), to)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert all(a == b == c for a, b, c in got)
    assert [a for a, _, _ in got][:6] == [5, 7, 9, -3, 12, 5]
    edge = spark.createDataFrame([("9223372036854775808",), ("3000000000",), ("-2147483648",)], "t string")
    assert all(a == b for a, b in edge.select(F.expr(sql), F.expr(plain)).collect())


def test_typed_reads_text_and_narrows_typed_columns(spark):
    df = spark.createDataFrame([("1.0", 2.9)], "a string, b double")
    got = C.retype(df, {"a": "int", "b": "int"})
    assert got.dtypes == [("a", "int"), ("b", "int")]
    assert got.first() == (1, 2)


def test_narrowing_out_of_range_gives_null(spark):
    df = spark.createDataFrame([(1e12,), (float("nan"),)], "b double")
    assert [r.b for r in C.retype(df, {"b": "int"}).collect()] == [None, None]


def test_duration_uses_whole_seconds(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2023-01-01 00:00:00.9' a, TIMESTAMP_NTZ'2023-01-01 00:01:30.1' b"
    )
    assert df.select(minutes_between(F.col("a"), F.col("b"))).first()[0] == 1.5


def test_calendar_attributes_of_a_sunday(spark):
    parts = calendar_attributes(F.lit("2023-01-01").cast("date"))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first().asDict()
    assert row == {
        "year_num": 2023, "quarter_num": 1, "month_num": 1, "month_name": "January",
        "day_num_in_month": 1, "day_of_week_num": 1, "day_of_week_name": "Sunday",
        "is_weekend": True,
    }


def test_every_payment_label(spark):
    codes = [None, -1, 0, 1, 2, 3, 4, 5, 6, 7, 99]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, c int")
    got = [r.v for r in df.select("i", payment_label(F.col("c")).alias("v")).orderBy("i").collect()]
    assert got == ["Missing", "Missing", "Unknown", "Credit card", "Cash", "No charge", "Dispute",
                   "Unknown", "Voided trip", "Other", "Other"]


def test_null_and_empty_text_share_a_key_but_values_do_not(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("", "a"), ("a", "b")], "x string, y string")
    keys = [r.k for r in df.select(surrogate_key(["x", "y"]).alias("k")).collect()]
    assert keys[0] == keys[1] and len(set(keys)) == 3
    assert all(len(k) == 64 for k in keys)


def test_blank_rules(spark):
    texts = ["", "  ", None, " x "]
    assert values(spark, texts, parsing.is_blank) == [True, True, None, False]
    strict = values(spark, texts, lambda c: parsing.is_blank(c, null_is_blank=True))
    assert strict == [True, True, True, False]
    assert values(spark, texts, parsing.blank_to_null) == [None, None, None, " x "]


def test_identifiers(spark):
    texts = [" Trip Distance ", "2023 Fee$$", "__a--b__", "PULocationID"]
    want = ["trip_distance", "col_2023_fee", "a_b", "pulocationid"]
    assert values(spark, texts, parsing.sanitize_identifier) == want
    df = spark.createDataFrame([(1, 2, 3, 4)], [t for t in texts])
    assert C.sanitize_names(df).columns == want
    with pytest.raises(ValueError, match="clash"):
        C.sanitize_names(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))


def test_month_in_file_name(spark):
    texts = ["/d/year=2022-01/trips_2023-04.csv", "/d/trips.csv"]
    assert values(spark, texts, parsing.month_in_name) == ["2023-04", None]


def test_load_timestamp_spellings(spark):
    texts = ["2023-01-02 03:04:05", "2023-01-02", "01/02/2023 03:04:05", "01/02/2023", "20230102", "?"]
    day = dt.datetime(2023, 1, 2)
    moment = dt.datetime(2023, 1, 2, 3, 4, 5)
    assert values(spark, texts, parsing.load_timestamp) == [moment, day, moment, day, day, None]


def test_conform_cleans_cuts_and_orders(spark):
    contract = S.Contract.of("n bigint\nname varchar(3)\nd date\nt timestamp_ntz\nabsent double")
    df = spark.createDataFrame(
        [("abcdef", "5.0", "2023-01-02", "2023-01-02 03:04:05", "x"), ("  ", "?", "", "", "x"),
         ("a�b", None, None, None, "x")],
        "name string, n string, d string, t string, extra string",
    )
    got = C.conform(df, contract, ["absent"])
    assert got.columns == contract.names
    assert [tuple(r) for r in got.collect()] == [
        (5, "abc", dt.date(2023, 1, 2), dt.datetime(2023, 1, 2, 3, 4, 5), None),
        (None, None, None, None, None),
        (None, "a?b", None, None, None),
    ]


def test_ensure_columns_adds_drops_and_orders(spark):
    df = spark.createDataFrame([(1, "x")], "b int, c string")
    got = C.ensure_columns(df, ["a", "b"])
    assert got.dtypes == [("a", "string"), ("b", "int")] and got.first() == (None, 1)


def test_load_times_stay_on_the_wall_clock(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("03/12/2023 02:30:00",), ("20230312",), ("x",)], "t string")
        got = [r[0] for r in df.select(parsing.load_timestamp(F.col("t")).cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2023-03-12 02:30:00", "2023-03-12 00:00:00", None]


def test_conform_reports_what_it_cannot_read(spark):
    contract = S.Contract.of("n int\nd date\nt varchar(3)")
    df = spark.createDataFrame([("1", "2023-01-01", "a"), ("x", "01/02/2023", " "), (" ", "y", None)], "n string, d string, t string")
    with pytest.raises(ValueError, match="t"):
        C.conform(df.drop("t"), contract)
    assert C.conform(df.drop("t"), contract, ["t"]).columns == ["n", "d", "t"]
    bad = C.rejections(df, contract)
    row = df.agg(*[F.count_if(c).alias(k) for k, c in bad.items()]).first()
    assert row.asDict() == {"rejected_n": 1, "rejected_d": 1}
