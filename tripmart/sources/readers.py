"""Scans of raw and stored data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas as S
from tripmart.functions import parsing
from tripmart.operators import columns as C


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the file each row came from; call directly on a scan."""
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def require_files(
    spark: SparkSession, paths: str | Sequence[str], label: str, pattern: str | None = None
) -> None:
    """An error when no file is there.  Looks at file names only, and only for a first one."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        listing = listing.option("pathGlobFilter", pattern)
    try:
        found = listing.load(paths if isinstance(paths, str) else list(paths)).select("length")
        if not found.isEmpty():
            return
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    raise FileNotFoundError(f"{label}: no input files at {paths}")


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    names: Sequence[str] | None = None,
    *,
    pattern: str | None = None,
    infer: bool = False,
    sep: str = ",",
    encoding: str = "UTF-8",
    lineage: bool = True,
    label: str = "csv",
) -> DataFrame:
    """Headered CSV.

    With ``names`` every field is a nullable string under an explicit schema, which Spark binds by
    position (see ``header_report`` for the check that positions are right).  Without, the header
    gives the names and ``infer`` decides on types.  ``pattern`` makes the search recursive.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    if names:
        reader = reader.schema(", ".join(f"`{n}` string" for n in names))
    elif infer:
        reader = reader.option("inferSchema", True).option("preferDate", True)
    if pattern:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    require_files(spark, paths, label, pattern)
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    return with_source_file(df) if lineage else df


def read_trips_csv(spark: SparkSession, paths, **options) -> DataFrame:
    return read_csv(spark, paths, S.TRIPS_RAW.names, label="trips", **options)


def read_weather_csv(spark: SparkSession, paths, **options) -> DataFrame:
    return read_csv(spark, paths, S.WEATHER_RAW.names, label="weather", **options)


def read_zones_csv(spark: SparkSession, paths, **options) -> DataFrame:
    return read_csv(spark, paths, S.ZONE_FILE_COLUMNS, label="zones", **options)


def read_stored(spark: SparkSession, path: str, label: str, schema: str | None = None) -> DataFrame:
    """A Parquet folder; partition folders become columns.  Missing or empty is an error."""
    require_files(spark, path, label, "*.parquet")
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def register_views(spark: SparkSession, folders: Mapping[str, str]) -> None:
    """Name stored Parquet folders so that SQL can use them."""
    for name, path in folders.items():
        read_stored(spark, path, name).createOrReplaceTempView(name)


def normalize_trip_source(df: DataFrame) -> DataFrame:
    """Monthly source columns (mixed case, optional ones absent) to the canonical raw trips.

    Values that do not convert become null; times keep whole seconds.
    """
    wanted = S.TRIPS_RAW.names
    named = C.rename_ignoring_case(df, wanted)
    C.require_columns(named, [n for n in wanted if n not in S.TRIP_FILE_OPTIONAL], "trip source")
    out = []
    for field in S.TRIPS_RAW:
        if field.name not in named.columns:
            column = F.lit(None).cast(field.type)
        elif field.type == "timestamp_ntz":
            column = parsing.whole_seconds(parsing.any_timestamp(named, field.name))
        else:
            column = parsing.typed(named, field.name, field.type)
        out.append(column.alias(field.name))
    return named.select(*out)


def daily_schema(fields: Sequence[str] = tuple(S.WEATHER_RAW.names[1:])) -> T.StructType:
    """JSON document holding parallel arrays under ``daily``."""
    arrays = [T.StructField("time", T.ArrayType(T.StringType()))]
    arrays += [T.StructField(f, T.ArrayType(T.DoubleType())) for f in fields]
    return T.StructType([T.StructField("daily", T.StructType(arrays))])


def read_daily_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(daily_schema()).option("multiLine", True).json(path)


def parallel_array_report(
    docs: DataFrame, id_columns: Sequence[str], fields: Sequence[str], root: str = "daily"
) -> DataFrame:
    """Per document and field: its length, the expected length, and whether it may be used."""
    expected = F.size(F.col(f"{root}.time"))
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"{root}.{f}").isNotNull().alias("present"),
                F.coalesce(F.size(f"{root}.{f}"), F.lit(-1)).alias("length"),
                F.coalesce(expected, F.lit(-1)).alias("expected_length"),
            )
            for f in ["time", *fields]
        ]
    )
    listed = docs.select(*id_columns, F.inline(rows))
    ok = F.col("present") & (F.col("length") == F.col("expected_length")) & (F.col("length") > 0)
    return listed.withColumn("is_usable", ok)


def flatten_parallel_arrays(
    docs: DataFrame, id_columns: Sequence[str], fields: Sequence[str], root: str = "daily"
) -> DataFrame:
    """One row per array position; documents with an absent or short array give no rows."""
    size = F.size(F.col(f"{root}.time"))
    usable = size > 0
    for f in fields:
        usable = usable & F.coalesce(F.size(f"{root}.{f}") == size, F.lit(False))
    zipped = F.arrays_zip(*[F.col(f"{root}.{f}").alias(f) for f in ["time", *fields]])
    flat = docs.filter(usable).select(*id_columns, F.inline(zipped))
    return flat.withColumnRenamed("time", "date")


def header_report(
    spark: SparkSession,
    paths: str | Sequence[str],
    expected: Sequence[str],
    sanitized: bool = False,
    sep: str = ",",
    pattern: str | None = None,
) -> DataFrame:
    """Per file: does its header equal ``expected`` in order, and how many records follow.

    Header and records are those of a CSV reader with one record a line: cells may be quoted, blank
    lines are no records.  Every file is read once, by all tasks that have a split of it, and
    reduced on the cluster, so none is gathered into one task.  An empty file has neither.
    """
    paths = paths if isinstance(paths, str) else list(paths)

    def reader(kind: str):
        found = spark.read.format(kind)
        if pattern:
            found = found.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
        return found.load(paths)

    text = reader("text")
    # the listing that Spark plans the read by knows empty files too, which no scan opens
    listed = spark.createDataFrame([(path,) for path in text.inputFiles()], "path string")
    same = lambda path: F.regexp_replace(path, "^file:/+", "file:///").alias("source_file")
    files = listed.select(same("path"))
    lines = text.select(
        same("_metadata.file_path"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    # one column more than expected tells a longer header
    schema = ", ".join(f"c{i} string" for i in range(len(expected) + 1))
    cells = F.from_csv("value", schema, {"sep": sep})
    names = [cells[f"c{i}"] for i in range(len(expected))]
    if sanitized:
        names = [parsing.sanitize_identifier(n) for n in names]
    is_header = cells[f"c{len(expected)}"].isNull()
    for name, wanted in zip(names, expected, strict=True):
        is_header = is_header & name.eqNullSafe(F.lit(wanted))
    # read order and verdict in one number: the smallest belongs to the first line, and a
    # number (unlike a struct) keeps this a hash aggregate
    verdict = F.monotonically_increasing_id() * 2 + F.when(is_header, 0).otherwise(1)
    counted = (
        lines.withColumn("verdict", F.when(F.col("block") == 0, verdict))
        .groupBy("source_file")
        .agg(
            F.min("verdict").alias("verdict"),
            # the reader trims all characters up to the blank, and takes the first line for the header
            F.count_if(F.col("value").rlike(r"[^\x00-\x20]")).alias("filled"),
        )
    )
    report = files.join(counted, "source_file", "left")
    rows = F.greatest(F.coalesce("filled", F.lit(0)) - 1, F.lit(0)).cast("long")
    return report.select(
        "source_file",
        F.coalesce(F.col("verdict") % 2 == 0, F.lit(False)).alias("header_ok"),
        rows.alias("data_rows"),
        (rows > 0).alias("has_rows"),
    )


def bronze_ready(df: DataFrame) -> DataFrame:
    """Lineage for frames that carry none: the current file where Spark knows it."""
    if "source_file" in df.columns:
        return df
    return df.withColumn("source_file", F.input_file_name())


def month_of_file(df: DataFrame, pattern: str = parsing.MONTH_IN_FILE_NAME) -> DataFrame:
    """Best applied to rows already grouped by file: the path is searched once per row."""
    return df.withColumn("file_month", parsing.month_in_name(F.col("source_file"), pattern))
