"""Shared folder tables and small expressions used by several operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names."""
    shared = shared_folder(spark)
    if shared is None:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.conf.get("spark.app.id", "app")
    return f"{shared}/tripmart-llm/{app}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back.

    Cuts lineage: a lost executor costs a retry of tasks, not of what lies before the table.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns in one, so that no name of theirs meets a helper column's."""
    return F.struct(*[df[f"`{c}`"].alias(c) for c in df.columns])


def field(row: str, name: str) -> Column:
    return F.col(row).getField(name)


def sha256_of_list(values: Column) -> Column:
    """Lower-case hex of the values joined by commas."""
    return F.sha2(F.concat_ws(",", values), 256)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the position of every row in the order, from 0, as ``name``; no task sees all rows.

    Rows are dealt by ranges of the order; only the ranges' row counts reach the driver.
    """
    ranged = stored(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)),
        "numbered",
    )
    sizes = sorted(map(tuple, ranged.groupBy("_part").agg(F.count(F.lit(1))).collect()))
    before, offsets = 0, []
    for part, size in sizes:
        offsets.append((part, before))
        before += size
    starts = df.sparkSession.createDataFrame(offsets, "_part int, _before long")
    return (
        ranged.join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn(name, F.col("_before") + F.col("_row")).drop("_part", "_row", "_before")
    )


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null being equal to null; the keys appear once."""
    right = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys]
    return left.join(right, same, how).drop(*[f"_same_{k}" for k in keys])


BIT_TABLE = 26  # leading bits of a key that number its flag


def bit_table(keys: DataFrame, bits: int = BIT_TABLE) -> np.ndarray:
    """A flag for the leading ``bits`` of every ``key``: with 26 of them 8 MB, whatever there is.

    It lets tasks set most rows aside early that a join would drop later; what passes still meets
    that join, so with many keys it only passes more.
    """
    first = F.expr(f"shiftrightunsigned(key, {64 - bits})")
    words = (
        keys.select((first / 64).cast("int").alias("place"), (first % 64).cast("int").alias("bit"))
        .groupBy("place").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"))
    ).toArrow()
    table = np.zeros((1 << bits) // 64, "<i8")
    table[words["place"].to_numpy()] = words["mask"].to_numpy()
    return table.view(np.uint8)


def has_bits(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the unsigned 64-bit keys have their flag set."""
    bits = 8 * len(table)
    at = (keys >> np.uint64(65 - bits.bit_length())).astype(np.int64)
    return (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def matching(
    df: DataFrame, decisions: DataFrame, keys: list[str], how: str, bound: int = 1_000_000
) -> DataFrame:
    """Rows of ``df`` with (``left_semi``) or without (``left_anti``) a decision, null equal to null.

    Decisions are counted: up to ``bound`` rows of keys go to every executor and wide rows stay where
    they are; more are joined by shuffling.
    """
    decided = stored(decisions.select(*keys).distinct(), "decisions")
    small = decided.agg(F.count(F.lit(1))).first()[0] <= bound
    return join_same(df, F.broadcast(decided) if small else decided, keys, how)
