"""Benchmark decontamination by winnowing.

Fingerprints of a text are the smallest k-gram keys of its sliding windows of w k-grams, so any two
texts that share w + k - 1 words share a fingerprint inside that span. Training and test
fingerprints are joined and each hit is extended to the windows around it, which are compared as
text. Test items of fewer words than a window are one k-gram of their own length (w = 1).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import bit_table, has_bits, sha256_of_list, stored
from tripmart.llm.words import Words, arrow_rows, chunks

_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_HITS = pa.list_(
    pa.struct([("k", pa.int32()), ("key", pa.int64()), ("at", pa.int64()), ("before", pa.int32()),
               ("words", pa.string())])
)
_SCANNED = pa.schema([("row_no", pa.int64()), ("id", pa.int64()), ("n_words", pa.int64()), ("hits", _HITS)])
_SCANNED_DDL = (
    "row_no long, id long, n_words long,"
    " hits array<struct<k:int,key:long,at:long,before:int,words:string>>"
)


def winnow(words: Words, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and keys of the k-grams that are the least of some window of w k-grams.

    Ties are all kept, so the choice depends on a window's content alone.
    """
    at, keys = words.grams(k)
    if w == 1 or not len(at):
        return at, keys
    row = np.full(len(words) + w, _TOP)
    row[at] = keys
    least = row[: len(words)].copy()
    for d in range(1, w):
        np.minimum(least, row[d : len(words) + d], out=least)
    whole = np.arange(len(words)) + w + k - 1 <= words.ends
    chosen = np.zeros(len(words), bool)
    for d in range(w):
        n = len(words) - d
        chosen[d:] |= whole[:n] & (row[d : len(words)] == least[:n])
    chosen = np.flatnonzero(chosen)
    return chosen, row[chosen]


def _item_windows(window: int, k: int):
    """Every window of an item with the fingerprints inside it."""
    schema = pa.schema([("item", pa.string()), ("n", pa.int32()), ("window", pa.string()),
                        ("k", pa.int32()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(arrow_rows(batches), 1):
            words = Words([t for _, t in part])
            at, keys = winnow(words, k, window - k + 1)
            out = []
            for (item, _), first, count in zip(
                part, words.first.tolist(), words.counts.tolist(), strict=True
            ):
                if 0 < count < window:
                    whole = Words([words.join(first, first + count)]).grams(count)[1]
                    out.append((item, count, words.join(first, first + count), count, whole.view(np.int64).tolist()))
                for s in range(first, first + count - window + 1):
                    a, b = np.searchsorted(at, [s, s + window - k + 1])
                    out.append((item, window, words.join(s, s + window), k, keys[a:b].view(np.int64).tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True) if out else [[]] * 5, schema.types, strict=True)], schema=schema)

    return run


def _scan(lengths: list[tuple[int, int]], window: int, known):
    """Per document: number of words, and fingerprints that the test side may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(arrow_rows(batches), 2):
            words = Words([r[2] for r in part])
            hits: list[list[dict]] = [[] for _ in part]
            for k, w in lengths:
                at, keys = winnow(words, k, w)
                maybe = has_bits(known.value, keys)
                for a, key in zip(at[maybe].tolist(), keys[maybe].view(np.int64).tolist(), strict=True):
                    text = int(words.text_of[a])
                    first = int(words.first[text])
                    left = max(first, a - (w - 1))
                    right = min(int(words.ends[a]), a + k + w - 1)
                    hits[text].append({"k": k, "key": key, "at": a - first, "before": a - left,
                                       "words": words.join(left, right)})
            columns = [pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()),
                       pa.array(words.counts, pa.int64()), pa.array(hits, _HITS)]
            schema = _SCANNED
            if len(part[0]) > 3:
                columns.append(pa.array([r[3] for r in part], pa.int64()))
                schema = schema.append(pa.field("version", pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def benchmark_overlap(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    k: int = 5,
    versions: bool = False,
) -> DataFrame:
    """Words of each document that lie in an occurrence of a window of a test item.

    Returns per row of ``docs``: id, ``n_words``, ``n_hit``, ``spans`` (first word and length of
    each occurring window), ``items`` (sorted ids, as strings, of the items with such windows).
    A window is ``window`` consecutive words; an item of fewer words, but not none, is one window.
    Null and empty texts have no words and no hits; an item without id counts under the id ''.
    With ``versions`` there is ``version`` as well, a hash of the text, as ids alone may name several texts.
    Repeated rows and ids give one result row each; other columns are neither read nor returned.
    """
    if not 1 <= k <= window:
        raise ValueError("k must lie between 1 and window")
    spark = docs.sparkSession
    test = stored(
        items.select(F.coalesce(F.col(item_id_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).alias("text"))
        .mapInArrow(_item_windows(window, k), "item string, n int, window string, k int, keys array<long>"),
        "item-windows",
    )
    short = [r.n for r in test.filter(F.col("n") < window).select("n").distinct().collect()]  # < window
    prints = test.select("k", F.explode("keys").alias("key")).distinct()
    known = spark.sparkContext.broadcast(bit_table(prints))
    lengths = [(k, window - k + 1), *((n, 1) for n in sorted(short))]
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    fields, version = _SCANNED_DDL, []
    if versions:
        rows = rows.withColumn("version", F.xxhash64(F.coalesce("text", F.lit(""))))
        fields, version = _SCANNED_DDL + ", version long", ["version"]
    scanned = stored(rows.mapInArrow(_scan(lengths, window, known), fields), "doc-fingerprints")
    hits = scanned.select("row_no", F.explode("hits").alias("hit")).select("row_no", "hit.*")
    # a fingerprint of k words lies in the windows that begin up to window - k words before it
    reach = F.when(F.col("n") == window, F.lit(window - k)).otherwise(0)
    spans = (
        hits.join(prints, ["k", "key"], "left_semi")
        .withColumn("n", F.when(F.col("k") == k, F.lit(window)).otherwise(F.col("k")))
        .withColumn("word", F.split("words", " "))
        .withColumn("shift", F.explode(F.sequence(F.lit(0), F.least("before", reach))))
        .withColumn("from", F.col("before") - F.col("shift"))
        .filter(F.col("from") + F.col("n") <= F.size("word"))
        .select("row_no", "n", (F.col("at") - F.col("shift")).alias("begin"),
                F.array_join(F.slice("word", F.col("from") + 1, F.col("n")), " ").alias("window"))
    )
    if k in short:  # an item of exactly k words is a window by itself
        spans = spans.union(
            hits.filter(F.col("k") == k).join(prints, ["k", "key"], "left_semi").select(
                "row_no", F.lit(k).alias("n"), F.col("at").alias("begin"),
                F.array_join(F.slice(F.split("words", " "), F.col("before") + 1, F.lit(k)), " ").alias("window")))
    windows = test.groupBy("n", "window").agg(F.collect_set("item").alias("items"))
    found = (
        spans.join(windows, ["n", "window"])
        .groupBy("row_no")
        .agg(F.array_sort(F.collect_set(F.struct("begin", F.col("n").cast("long").alias("length")))).alias("spans"),
             F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["begin"] + s["length"] - F.greatest(acc["to"], s["begin"]))).alias("n"),
            F.greatest(acc["to"], s["begin"] + s["length"]).alias("to")),
        lambda acc: acc["n"],
    )
    no_spans = F.array().cast("array<struct<begin:bigint,length:bigint>>")
    return (
        scanned.select("row_no", "id", "n_words", *version).join(found, "row_no", "left")
        .select(F.col("id").alias(id_col), "n_words", F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
                F.coalesce("spans", no_spans).alias("spans"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items"), *version)
    )


def with_digest(overlap: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return overlap.select(
        id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        sha256_of_list(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
