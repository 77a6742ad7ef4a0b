"""Parquet sinks that can be run again."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.aggregates import profile, row_counts
from tripmart.operators.columns import conform, rejections
from tripmart.schemas import Contract
from tripmart.sources.tables import VersionedTable


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), rebalance: bool = True
) -> int:
    """Replace an unpartitioned folder, or only the partitions present in ``df``.

    Returns the rows written, observed during the write; a number for logs, as a task that runs again
    may count twice. See ``VersionedTable`` for tables that change in one step.
    Partitioned output is rebalanced on the partition columns: adaptive execution splits a heavy
    month over many tasks and joins light ones, so a month is never bound to one task and tasks do
    not each write a file into every month. ``rebalance=False`` is for rows that already lie by
    those columns. Files are written with zstd, which halves keys in hex.
    """
    seen = Observation()
    watched = df.observe(seen, F.count("*").alias("rows"))
    if partition_by:
        dealt = watched.hint("rebalance", *partition_by) if rebalance else watched
        writer = (
            dealt.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
        )
    else:
        writer = watched.write.mode("overwrite")
    writer.option("compression", "zstd").parquet(path)
    return seen.get["rows"]


def export_flat(
    source: DataFrame, path: str, contract: Contract, files: int, source_rows: int | None = None
) -> DataFrame:
    """Contract columns of a stored table as ``files`` unpartitioned files, reconciled.

    Returns one row: rows of the source, rows found in the export. Both are counted in what is stored:
    ``source_rows`` where the table's commit has them, else by the footers of the source.
    """
    source.select(*contract.names).coalesce(files).write.mode("overwrite").parquet(path)
    return reconciled(source if source_rows is None else source_rows, source.sparkSession.read.parquet(path))


def reconciled(source: DataFrame | int, exported: DataFrame) -> DataFrame:
    """One row: rows of the source, rows of the export, their difference."""
    found = exported.agg(F.count("*").alias("exported_rows"))
    if isinstance(source, int):
        row = found.select(F.lit(source).cast("bigint").alias("source_rows"), "exported_rows")
    else:
        row = row_counts({"source_rows": source, "exported_rows": exported})
    return row.withColumn("violations", F.abs(F.col("source_rows") - F.col("exported_rows")))


class RunLoader:
    """Loads several batches per target in one run: the first replaces, the rest append.

    What a run has loaded is part of the target's commits, so a loader started again with the same
    ``run`` neither replaces nor doubles anything: batches that are there are passed over. Batches
    without a name are known by their place in the run. With ``truncate=False`` a run only appends.
    """

    def __init__(self, spark: SparkSession, truncate: bool = True, run: str | None = None):
        self._spark = spark
        self._truncate = truncate
        self._run = run or uuid.uuid4().hex
        self._loaded: Counter[str] = Counter()

    def load(
        self, batch: DataFrame, path: str, contract: Contract, max_rejects: int | None = 0, name: str | None = None
    ) -> bool:
        """Add a batch; False where the target already has it.

        Refuses a batch with more than ``max_rejects`` unreadable values before it writes.
        """
        self._loaded[path] += 1
        name = name or f"{self._run}/{self._loaded[path]}"
        table = VersionedTable(self._spark, path)
        state = table.current()
        fresh = state is None or (self._truncate and state.run != self._run)
        if not fresh and state.has_batch(name):
            return False
        bad = rejections(batch, contract)
        if bad and max_rejects is not None:
            counts = profile(batch, bad).first().asDict()
            if sum(counts.values()) > max_rejects:
                raise ValueError(f"{path}: {dict(filter(lambda x: x[1], counts.items()))}")
        rows = conform(batch, contract)
        if fresh:
            table.replace(rows, self._run, name)
        else:
            table.append(rows, self._run, name)
        return True

    def read(self, path: str, contract: Contract) -> DataFrame:
        return VersionedTable(self._spark, path).read(contract.ddl)
