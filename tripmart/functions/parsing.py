"""Text to typed values.  A value that does not parse becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The accepted text formats.
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
# Every text that a direct cast to an integer reads.  The cast makes an error of any other, at more than
# a hundred microseconds a value, before it becomes null.
INTEGER_PATTERN = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*\z"
MONTH_IN_FILE_NAME = r"(\d{4}-\d{2})[^/]*$"


def parse_timestamp(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` as wall-clock time, so no time zone can move it."""
    return F.when(text.rlike(TIMESTAMP_PATTERN), text.try_cast("timestamp_ntz"))


def parse_date(text: Column) -> Column:
    return F.when(text.rlike(DATE_PATTERN), text.try_cast("date"))


def parse_integer(text: Column, to: str = "bigint") -> Column:
    """Exact for integer text; ``1.0`` (an integer column that held nulls) also reads as 1."""
    whole = F.when(text.rlike(INTEGER_PATTERN), text.try_cast(to))
    return F.coalesce(whole, text.try_cast("double").try_cast(to))


def typed_sql(df: DataFrame, name: str, to: str) -> str:
    """SQL expression for column ``name`` of ``df`` as type ``to``.

    Text is parsed; a column that is typed already (Parquet input) is only narrowed, which
    keeps comparisons on it simple enough to reach the scan.
    """
    have = df.schema[name].dataType
    if have.simpleString() == to:
        return f"`{name}`"
    cast = f"try_cast(`{name}` AS {to})"
    if not isinstance(have, T.StringType):
        return cast
    if to == "timestamp_ntz":
        return f"CASE WHEN `{name}` RLIKE r'{TIMESTAMP_PATTERN}' THEN {cast} END"
    if to == "date":
        return f"CASE WHEN `{name}` RLIKE r'{DATE_PATTERN}' THEN {cast} END"
    if to in ("int", "bigint"):
        whole = f"CASE WHEN `{name}` RLIKE r'{INTEGER_PATTERN}' THEN {cast} END"
        return f"coalesce({whole}, try_cast(try_cast(`{name}` AS double) AS {to}))"
    return cast


def typed(df: DataFrame, name: str, to: str) -> Column:
    return F.expr(typed_sql(df, name, to))


def load_timestamp(text: Column) -> Column:
    """Load-time reading of timestamps: any of the usual spellings, on the wall clock.

    Other spellings are rearranged as text; parsing them as instants would move times that the
    session's zone skips.
    """
    text = F.trim(text)
    iso = F.regexp_replace(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})( .*)?$", "$3-$1-$2$4")
    iso = F.regexp_replace(iso, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return iso.try_cast("timestamp_ntz")


def any_timestamp(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return load_timestamp(column)
    return column.try_cast("timestamp_ntz")


def whole_seconds(moment: Column) -> Column:
    """Drop the fraction of a second, staying on wall-clock time."""
    fraction = F.extract(F.lit("SECOND"), moment) % 1
    return moment - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def printable(text: Column) -> Column:
    """Replacement characters left by a lossy decode become question marks."""
    return F.regexp_replace(text, "�", "?")


def is_blank(text: Column, null_is_blank: bool = False) -> Column:
    """Blank after trimming; whether null counts is the caller's choice."""
    return F.trim(F.coalesce(text, F.lit(""))) == "" if null_is_blank else F.trim(text) == ""


def month_in_name(path: Column, pattern: str = MONTH_IN_FILE_NAME) -> Column:
    """The ``yyyy-MM`` in a path, null when there is none; by default in the file's own name."""
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def sanitize_identifier(text: Column) -> Column:
    """Lower case, runs of other characters to one underscore, no edge underscores,
    ``col_`` before a leading digit."""
    squeezed = F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "_")
    bare = F.trim(squeezed, F.lit("_"))
    return F.when(bare.rlike("^[0-9]"), F.concat(F.lit("col_"), bare)).otherwise(bare)
