"""Registered queries over the given tables; each applies one operator with its usual options."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripmart.llm import decontaminate, secrets
from tripmart.llm.common import new_folder
from tripmart.llm.fingerprints import as_string, compared_with_edits
from tripmart.llm.html_text import page_texts
from tripmart.llm.lines import repeated_runs
from tripmart.llm.merkle import tampered_documents
from tripmart.llm.mixing import mix_sources
from tripmart.llm.quality import judge_quality
from tripmart.llm.similar import similar_texts
from tripmart.llm.tokens import token_counts
from tripmart.llm.units import repeated_passages
from tripmart.llm.urls import url_host, url_verdicts
from tripmart.llm.whitening import whitened_vectors

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counts = token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return counts.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit")
    )


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.with_digest(
        decontaminate.benchmark_overlap(
            table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
        )
    )


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_texts(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query
def op4_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_runs(table(spark, sf_dir, "documents")).drop("version")


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def captures_and_lists(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures with a fetch day and list changes, both worked out from the pages themselves.

    The given pages have no dates and come with no lists, so page p is fetched on day 37 p mod 365 of
    2024, and the lists change on days that follow from a host's first page.
    """
    day = lambda c: F.date_add(F.lit("2024-01-01").cast("date"), c.cast("int")).cast("timestamp")
    captures = pages.select("page_id", "url", day(F.col("page_id") * 37 % 365).alias("fetched_at"))
    hosts = (
        pages.select("page_id", "url", url_host(F.col("url")).alias("host"))
        .filter("host <> ''").groupBy("host").agg(F.min("page_id").alias("m"))
    )
    path = F.concat_ws("/", "host", F.element_at(F.array(*map(F.lit, ["en", "de", "fr", "es"])), (F.col("m") % 4 + 1).cast("int")))
    opened, closed, again = F.col("m") * 13 % 200, F.col("m") * 13 % 200 + 20 + F.col("m") % 50, F.col("m") * 13 % 200 + 90
    change = lambda name, verdict, key, action, at: F.struct(
        F.lit(name).alias("list"), F.lit(verdict).alias("verdict"), key.alias("key"), F.lit(action).alias("action"), day(at).alias("at"))
    entries = hosts.select(F.explode(F.array(
        change("hosts", "block", F.col("host"), "add", opened),
        change("hosts", "block", F.col("host"), "remove", closed),
        change("hosts", "block", F.col("host"), "add", again),
        change("sections", "allow", path, "add", opened + 10),
        change("sections", "allow", path, "remove", again + 30),
        change("domains", "block", F.substring_index("host", ".", -3), "add", opened + 150),
        change("domains", "block", F.substring_index("host", ".", -3), "remove", closed + 150),
    )).alias("e")).select("e.*")
    return captures, entries


@query
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(*captures_and_lists(table(spark, sf_dir, "pages"))).drop("fetched_at")


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = secrets.BlobLedger(spark, new_folder(spark, "secret-ledger"))
    return secrets.with_digest(secrets.secret_findings(table(spark, sf_dir, "documents"), ledger))


@query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("source", "n_whole", "n_part")


@query
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(table(spark, sf_dir, "pages"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("version")


@query
def op11_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compared_with_edits(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", as_string(F.col("entries")).alias("fingerprint"),
        as_string(F.col("edited_entries")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_vectors(table(spark, sf_dir, "embeddings"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampered_documents(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
