"""Stored tables that change in one step and outlive a job that dies.

A table's folder holds ``data`` and ``commits``. Every write puts its files into a new folder below
``data`` and touches nothing else. What the table consists of is said by its last commit: one small file
with a line for each part (partition, version folder, rows, bytes, files) and each batch loaded. One task
writes that file, and it shows up whole or not at all, so a job that dies leaves the table as it was and
files that nobody reads. Row counts come from the footers of the files that were stored.

A table has one writer at a time; of two that commit the same number the later one fails. The driver
holds a table's parts, of which there are as many as partitions and appended batches.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LINES = (
    "kind string, partition string, version string, rows bigint, bytes bigint, files bigint,"
    " run string, batch string, ddl string"
)
_VERSION = "stored_version"
log = logging.getLogger(__name__)


class CommitConflict(RuntimeError):
    """Another writer has committed the same number first; the table holds its state."""


@dataclass(frozen=True)
class Part:
    """Files of one partition from one write."""

    partition: str
    version: str
    rows: int
    bytes: int
    files: int


@dataclass(frozen=True)
class Batch:
    """A batch that is in the table."""

    batch: str
    version: str
    rows: int


@dataclass(frozen=True)
class State:
    """What a commit says."""

    number: int
    ddl: str = ""
    run: str | None = None
    parts: tuple[Part, ...] = ()
    batches: tuple[Batch, ...] = field(default=())

    @property
    def rows(self) -> int:
        return sum(p.rows for p in self.parts)

    def has_batch(self, batch: str | None) -> bool:
        return batch is not None and any(b.batch == batch for b in self.batches)


def month_partitions(months: Iterable[str], columns: Sequence[str]) -> list[str]:
    """Partition folders of ``YYYY-MM`` months under a year and a month column."""
    year, month = columns
    return [f"{year}={int(m[:4])}/{month}={int(m[5:])}" for m in months]


class VersionedTable:
    """A table below ``path``, partitioned by ``partition_by``."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)

    def _folder(self, version: str) -> str:
        return f"{self.path}/data/{_VERSION}={version}"

    # -- commits -----------------------------------------------------------------------------

    def _last(self, number: int | None = None) -> tuple[int, str] | None:
        """(number, id) of the last commit, or of the one with ``number``; looks at names only."""
        listing = (
            self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.json")
        )
        try:
            found = listing.load(f"{self.path}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        names = found.select(F.regexp_extract("path", r"/commits/([0-9]+-[0-9a-f]+)/", 1).alias("id"))
        named = names.withColumn("number", F.substring_index("id", "-", 1).cast("bigint"))
        if number is not None:
            named = named.filter(F.col("number") == number)
        # of two with one number the first in order is the one that counts, for every reader
        row = named.groupBy("number").agg(F.min("id").alias("id")).orderBy(F.desc("number")).first()
        return row and (row.number, row.id)

    def current(self) -> State | None:
        """The state of the last commit; None where nothing was ever committed."""
        last = self._last()
        if last is None:
            return None
        number, name = last
        lines = self.spark.read.schema(_LINES).json(f"{self.path}/commits/{name}").collect()
        head = next(r for r in lines if r.kind == "table")
        return State(
            number, head.ddl, head.run,
            tuple(Part(r.partition, r.version, r.rows, r.bytes, r.files) for r in lines if r.kind == "part"),
            tuple(Batch(r.batch, r.version, r.rows) for r in lines if r.kind == "batch"),
        )

    def _commit(self, state: State) -> State:
        """Make ``state`` the table's; one file, written by one task."""
        lines = [("table", None, None, None, None, None, state.run, None, state.ddl)]
        lines += [("part", p.partition, p.version, p.rows, p.bytes, p.files, None, None, None) for p in state.parts]
        lines += [("batch", None, b.version, b.rows, None, None, None, b.batch, None) for b in state.batches]
        name = f"{state.number:012d}-{uuid.uuid4().hex}"
        rows = self.spark.createDataFrame(lines, _LINES).coalesce(1)
        rows.write.json(f"{self.path}/commits/{name}")
        if self._last(state.number) != (state.number, name):
            raise CommitConflict(f"{self.path}: commit {state.number} was made by another writer")
        return state

    # -- writes ------------------------------------------------------------------------------

    def _write(self, df: DataFrame, version: str) -> tuple[Part, ...]:
        """Files of a new version, and what their footers say."""
        if self.partition_by:
            writer = df.hint("rebalance", *self.partition_by).write.partitionBy(*self.partition_by)
        else:
            writer = df.write
        writer.parquet(self._folder(version))
        return self._counted(df, version)

    def _counted(self, df: DataFrame, version: str) -> tuple[Part, ...]:
        """Rows, bytes and files by partition folder; no column is read, so footers answer."""
        stored = self.spark.read.schema(df.schema).parquet(self._folder(version))
        path = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
        per_file = stored.groupBy(path.alias("path"), F.col("_metadata.file_size").alias("size")).agg(
            F.count("*").alias("rows"))
        partition = F.regexp_extract("path", f"/{_VERSION}={version}/(?:(.+)/)?[^/]+$", 1)
        found = per_file.groupBy(partition.alias("partition")).agg(
            F.sum("rows").alias("rows"), F.sum("size").alias("bytes"), F.count("*").alias("files")).collect()
        if not found and not self.partition_by:
            return (Part("", version, 0, 0, 0),)
        return tuple(Part(r.partition, version, r.rows, r.bytes, r.files) for r in sorted(found))

    def _put(self, df: DataFrame, keep, run: str | None = None, batch: str | None = None) -> State:
        """Write ``df`` as a new version and commit it together with the parts that ``keep`` chooses."""
        before = self.current() or State(0)
        version = f"{before.number + 1:012d}-{uuid.uuid4().hex}"
        parts = self._write(df, version)
        kept, batches = keep(before, {p.partition for p in parts})
        if batch is not None:
            batches = (*batches, Batch(batch, version, sum(p.rows for p in parts)))
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        return self._commit(State(before.number + 1, ddl, run, (*kept, *parts), batches))

    def replace(self, df: DataFrame, run: str | None = None, batch: str | None = None) -> State:
        """The table becomes ``df``. It may be read from the table itself."""
        return self._put(df, lambda before, new: ((), ()), run, batch)

    def replace_partitions(self, df: DataFrame, also: Iterable[str] = ()) -> State:
        """Partitions in ``df`` and those named in ``also`` become what ``df`` has of them.

        Replacing some and emptying others is one commit; all others stay as they are.
        """
        wanted = set(also)
        return self._put(
            df, lambda before, new: (tuple(p for p in before.parts if p.partition not in new | wanted), before.batches))

    def append(self, df: DataFrame, run: str | None = None, batch: str | None = None) -> State:
        """Add rows. A batch that the table already has is not added again."""
        before = self.current()
        if before and before.has_batch(batch):
            log.info("%s: batch %s was loaded before", self.path, batch)
            return before
        return self._put(df, lambda state, new: (state.parts, state.batches), run, batch)

    # -- reads -------------------------------------------------------------------------------

    def state(self) -> State:
        found = self.current()
        if found is None:
            raise FileNotFoundError(f"{self.path}: no committed table")
        return found

    def folders(self) -> list[str]:
        """Folders that hold the table's present files."""
        return [f"{self._folder(p.version)}/{p.partition}".rstrip("/") for p in self.state().parts if p.files]

    def read(self, ddl: str | None = None) -> DataFrame:
        """The rows of the last commit; later commits do not change what the frame reads.

        Without ``ddl`` the columns are those of the last write.
        """
        state = self.state()
        paths = [f"{self._folder(p.version)}/{p.partition}".rstrip("/") for p in state.parts if p.files]
        schema = ddl or state.ddl
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*paths).drop(_VERSION)

    def rows(self, partitions: Iterable[str] | None = None) -> int:
        """Rows as the commit has them, of all or of the named partitions; nothing is read."""
        wanted = None if partitions is None else set(partitions)
        return sum(p.rows for p in self.state().parts if wanted is None or p.partition in wanted)

    def row_counts(self) -> DataFrame:
        """(partition, row_count, bytes, files) of the last commit."""
        parts = [(p.partition, p.rows, p.bytes, p.files) for p in self.state().parts]
        listed = self.spark.createDataFrame(parts, "partition string, row_count bigint, bytes bigint, files bigint")
        return listed.groupBy("partition").agg(*[F.sum(c).alias(c) for c in ("row_count", "bytes", "files")])

    def vacuum(self) -> list[str]:
        """Empty the folders of versions that the table no longer consists of; returns their names.

        Frames read before and not yet used up lose their files, so this is for times without readers.
        Folders of versions above the last commit may belong to a write that goes on and stay.
        """
        state = self.state()
        used = {p.version for p in state.parts}
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{self.path}/data")
        found = listing.filter("length > 0").select(
            F.regexp_extract("path", f"/{_VERSION}=([0-9a-f-]+)/", 1).alias("version")).distinct().collect()
        gone = sorted(r.version for r in found if r.version not in used and int(r.version.split("-")[0]) <= state.number)
        nothing = self.spark.createDataFrame([], "line string")
        for version in gone:
            nothing.write.mode("overwrite").text(self._folder(version))
        return gone
