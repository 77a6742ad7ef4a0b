"""Documents to training mix in five stages; each is written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a frame; all but the last have the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import field, matching, stored, whole_row
from tripmart.llm.decontaminate import benchmark_overlap
from tripmart.llm.lines import delete_runs, repeated_runs
from tripmart.llm.mixing import mix_sources
from tripmart.llm.quality import judge_quality
from tripmart.llm.similar import similar_texts

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _row_of(docs: DataFrame) -> DataFrame:
    """(row, id, version): columns may have any names; null ids are equal, a null text is as an empty one."""
    version = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("id"), version.alias("version"))


def _columns_of(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[field("row", c).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; null and empty texts are rejected.

    Each row is judged by its text, repeated rows and ids alike. An empty table gives an empty one.
    """
    rows = docs.select(whole_row(docs).alias("row"), F.col("text").alias("text"))
    return _columns_of(judge_quality(rows, carry=["row"]).filter("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are taken out; a document left without a word goes.

    ``n_chars``, where there is one, follows the text, in its own type. Null and empty texts have no
    word. Of equal runs the first by (id, hash of text, line) stays; repeated rows are one document.
    """
    cleaned = delete_runs(docs, repeated_runs(docs))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the least id.

    Ties and null ids (first) go by a hash of the text; rows equal in id and text are one document, of
    which one row stays. Texts without words are each a class of their own.
    """
    keys = ["id", "version"]
    keyed = _row_of(docs)
    gone = similar_texts(docs).filter(~F.col("first")).select(F.col("doc_id").alias("id"), "version")
    left = matching(keyed, gone, keys, "left_anti")
    # rows equal in id and text are one document
    again = stored(
        keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeated-rows")
    if not again.isEmpty():
        once = matching(left, again, keys, "left_semi").dropDuplicates(keys)
        left = matching(left, again, keys, "left_anti").unionByName(once)
    return _columns_of(left, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go, each known by id and text, as ids may be null or repeated.

    Null and empty texts have none and stay; so does everything if the benchmark is empty.
    """
    hit = (
        benchmark_overlap(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), versions=True)
        .filter("n_hit > 0").select(F.col("doc_id").alias("id"), "version")
    )
    return _columns_of(matching(_row_of(docs), hit, ["id", "version"], "left_anti"), docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it, repeats counted.

    These are ``n_whole`` copies of the text and its first ``n_part`` words once more. Null and empty
    texts give none; a null source is one of its own; an empty table gives an empty result.
    """
    return mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

# Estimated rule accuracies and classes of near duplicates go beyond SQL; the tests compare the
# stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
