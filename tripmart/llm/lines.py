"""Line dedup over the suffix array of line sequences. Built-in functions only.

Lines become integers; ranks of runs of 1, 2, 4 .. lines are found by prefix doubling: the rank of a
run is that of its pair of half runs among all pairs in order. Positions of equal rank are an interval
of the suffix array whose common prefix has at least that many lines; two overlapping runs of a power
of two identify a run of any length. Looked up are, for every line, the least qualifying run that
begins there and the least that ends there: all their occurrences but the first are deleted. That is
every line of every qualifying run i..j that occurs earlier, since for a line p of it either p..j
qualifies and has the least run that begins at p, or i..p does and has the least that ends at p, or
neither does and the least run that begins at i goes beyond p. Runs of lines that occur once leave
at the start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import field, join_same, numbered, stored, whole_row

_WORDS = r"[^\x20\x09-\x0D]+"


def _text_key(text: Column) -> Column:
    return F.xxhash64(text).alias("version")


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, version, seq, line_no, k1, k2, words): lines with a word, trimmed, by position.

    ``version`` is a hash of the text, so that rows with the same id and other text are told apart.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(
        F.transform(F.split(text, "\n"), lambda x, i: F.struct(F.btrim(x, F.lit(" \t\x0b\x0c\r")).alias("line"), i.alias("line_no"))),
        lambda s: s["line"] != "")
    rows = docs.select(F.col(id_col).alias("id"), _text_key(text), F.posexplode(lines).alias("seq", "s"))
    return rows.select(
        "id", "version", "seq", "s.line_no", F.xxhash64("s.line").alias("k1"),
        F.xxhash64(F.lit(1), "s.line").alias("k2"), F.regexp_count("s.line", F.lit(_WORDS)).alias("words"))


def _rank(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """Add the rank of the key among the keys that occur twice or more; others leave."""
    repeated = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return rows.join(numbered(repeated, [F.col(k) for k in key], name), key)


def repeated_runs(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 50,
    min_lines: int = 3,
) -> DataFrame:
    """(id, version, first_line, last_line, n_lines, first_id): runs of lines to delete.

    A run qualifies with ``min_words`` words or ``min_lines`` lines in all. Every occurrence of a
    repeated qualifying run is deleted but the first by (id, version, line); ``first_id`` has that
    one. Overlapping and adjoining runs are given as one. Lines are compared without white space at
    their ends; lines without other characters neither count nor separate. Null and empty texts have
    no lines. Rows equal in id and text are one document. Other columns are not read.
    """
    lines = stored(line_table(docs, id_col, text_col), "lines")
    document = Window.partitionBy("id", "version").orderBy("seq")
    base = stored(_rank(lines, ["k1", "k2"], "rank").select("id", "version", "seq", "line_no", "words", "rank"), "line-ranks")

    def least(step: int, new: bool) -> Column:
        """Length of the least qualifying run from a line on, repeated lines only, without a gap.

        ``new`` leaves out runs that do not qualify without this line.
        """
        total, choices = F.lit(0), []
        for d in range(min_lines):
            total = total + F.max("words").over(document.rangeBetween(step * d, step * d))  # null beyond a gap
            enough = (total >= min_words) | ((total >= 0) & F.lit(d + 1 == min_lines))
            choices.append(F.when(enough, F.when(total - F.col("words") >= min_words, d + 1).otherwise(0) if new else F.lit(d + 1)))
        return F.coalesce(*choices, F.lit(0))

    # a run that ends at a line and is the least from its beginning is there already
    both_ways = stored(base.withColumns({"ahead": least(1, False), "behind": least(-1, True)}), "least-lengths")
    starts = both_ways.filter("ahead > 0").select("id", "version", "seq", F.col("ahead").alias("need")).unionByName(
        both_ways.filter("behind > 0").select("id", "version", (F.col("seq") - F.col("behind") + 1).alias("seq"), F.col("behind").alias("need")))
    level, ranks, found = 1, base.select("id", "version", "seq", "rank"), []
    while True:
        # runs of level .. 2 level - 1 lines are two runs of ``level`` lines that may overlap
        here = starts.filter((F.col("need") >= level) & (F.col("need") < 2 * level))
        left = join_same(here, ranks, ["id", "version", "seq"])
        right = ranks.select("id", "version", F.col("seq").alias("_at"), F.col("rank").alias("tail"))
        pairs = join_same(
            left.withColumn("_at", F.col("seq") + F.col("need") - level), right, ["id", "version", "_at"])
        found.append(pairs.select("id", "version", "seq", "need", F.lit(level).alias("level"), "rank", "tail"))
        if 2 * level > min_lines:
            break
        doubled = ranks.withColumn("tail", F.max("rank").over(document.rangeBetween(level, level))).filter("tail is not null")
        ranks = stored(
            _rank(doubled.withColumnRenamed("rank", "head"), ["head", "tail"], "rank").select("id", "version", "seq", "rank"),
            "run-ranks")
        level *= 2
    runs = found[0]
    for more in found[1:]:
        runs = runs.unionByName(more)
    runs = stored(runs, "least-runs")
    key = ["need", "level", "rank", "tail"]
    place = F.struct("id", "version", "seq")
    # the least and the greatest place are found before the shuffle already, however frequent a run is
    first = (
        runs.groupBy(*key).agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(F.col("first") != F.col("last")).drop("last")
    )
    later = runs.join(first, key).filter(place != F.col("first"))
    spans = later.groupBy("id", "version", "seq").agg(
        F.max("need").alias("need"), F.max_by("first", "need").alias("first"))
    reach = F.coalesce(F.max(F.col("seq") + F.col("need")).over(document.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    merged = (
        spans.withColumn("opens", (F.col("seq") > reach).cast("int"))
        .withColumn("run", F.sum("opens").over(document))
        .groupBy("id", "version", "run")
        .agg(F.min("seq").alias("from"), F.max(F.col("seq") + F.col("need") - 1).alias("to"), F.min_by("first", "seq").alias("first"))
    )
    # back from places among lines with words to lines of the text
    line_of = base.select("id", "version", "seq", "line_no").distinct()
    begin = join_same(merged, line_of.select("id", "version", F.col("seq").alias("from"), F.col("line_no").alias("first_line")), ["id", "version", "from"])
    both = join_same(begin, line_of.select("id", "version", F.col("seq").alias("to"), F.col("line_no").alias("last_line")), ["id", "version", "to"])
    return both.select(
        F.col("id").alias(id_col), "version", "first_line", "last_line",
        (F.col("to") - F.col("from") + 1).cast("long").alias("n_lines"), F.col("first.id").alias("first_id"))


def delete_runs(docs: DataFrame, runs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines of ``runs`` taken out of the text; all columns and rows stay.

    Columns may have any names. Null texts stay null; a text all of whose lines go is empty. Rows equal
    in id and text lose the same lines, null ids being equal.
    """
    spans = runs.groupBy(F.col(id_col).alias("id"), "version").agg(
        F.array_sort(F.collect_list(F.struct("first_line", "last_line"))).alias("spans"))
    keyed = docs.select(
        F.col(id_col).alias("id"), _text_key(F.coalesce(F.col(text_col), F.lit(""))), whole_row(docs).alias("row"))
    text = field("row", text_col)
    left = F.filter(
        F.split(text, "\n"), lambda x, i: ~F.exists("spans", lambda s: (i >= s["first_line"]) & (i <= s["last_line"])))
    cut = F.when(F.col("spans").isNull(), text).otherwise(F.array_join(left, "\n"))
    return join_same(keyed, spans, ["id", "version"], "left").select(
        *[(cut if c == text_col else field("row", c)).alias(c) for c in docs.columns])
