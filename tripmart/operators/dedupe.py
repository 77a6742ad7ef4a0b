"""One row per key, chosen by a total order."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import shared_folder

REPEATS_BOUND = 1_000_000  # hashes of repeated keys that are sent to every executor, 8 bytes each


def dedupe_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """Keep the first row of every key under ``order_by`` (default: all other columns).

    The order makes the kept row the same on every run and after a lost executor.  ``rank = 1``
    lets Spark drop losing copies on the map side (WindowGroupLimit before the exchange), so a
    key with a third of all rows sends one row per map task, not its whole group.
    """
    ties = [c for c in (order_by or df.columns) if c not in keys] or list(keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ties))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def repeated_hashes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """8-byte hashes that more than one row's key has; counted on the map side first."""
    return (
        df.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("_hash")
    )


def dedupe_few_copies(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    bound: int = REPEATS_BOUND,
) -> DataFrame:
    """The rows of ``dedupe_by_key``, without a shuffle of rows whose key occurs once.

    First the keys' hashes are counted, which shuffles 16 bytes a row, and those that repeat are
    written to the shared folder.  If there are up to ``bound`` of them, rows with such a hash go
    through the window, as a collision is told apart there; all others pass by in place.  With more,
    or without a shared folder, all rows go through the window.  ``df`` is read three times, so it
    should be a stored table or near one, and must give the same rows each time.
    """
    spark = df.sparkSession
    shared = shared_folder(spark)
    if shared is None:
        return dedupe_by_key(df, keys, order_by)
    path = f"{shared}/tripmart/{spark.conf.get('spark.app.id')}/repeated-hashes-{uuid.uuid4().hex}"
    repeated_hashes(df, keys).write.parquet(path)
    repeated = spark.read.schema("_hash long").parquet(path)
    found = repeated.count()  # from the footers
    if found > bound:
        return dedupe_by_key(df, keys, order_by)
    if not found:
        return df
    order = list(order_by or df.columns)
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    few = F.broadcast(repeated)  # counted above
    once = hashed.join(few, "_hash", "left_anti").drop("_hash")
    again = hashed.join(few, "_hash", "left_semi").drop("_hash")
    return once.unionByName(dedupe_by_key(again, keys, order))
