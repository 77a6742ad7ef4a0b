"""A local session for tests and benchmarks; clusters bring their own."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that ``spark.checkpoint.dir`` names for tables that all executors share.

    Where it is unset, a local session gets a temporary folder of its own and any other gets none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        return None
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="tripmart-"))
    return _OWN[0]


@contextmanager
def in_steps(spark: SparkSession) -> Iterator[None]:
    """For tables made in several writes: the shuffle files of each go when it has ended, not when the driver
    happens to collect its garbage, and what it wrote is read in small parts, which are sorted in memory."""
    wanted = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "16m",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def local_session(cores: int = 8, memory: str = "8g", **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tripmart")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # inputs of one row group leave all shuffled rows with one map task; a local read of
        # that shuffle would leave them with one task again
        .config("spark.sql.adaptive.localShuffleReader.enabled", "false")
        # call-site capture costs about a millisecond per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
