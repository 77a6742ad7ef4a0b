"""Shaping the columns of a frame: presence, order, names, types."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions import parsing
from tripmart.schemas import Contract


def ensure_columns(df: DataFrame, names: Sequence[str], kind: str = "string") -> DataFrame:
    """Exactly ``names``, in order; absent ones become typed nulls."""
    have = set(df.columns)
    return df.selectExpr(
        *[f"`{n}`" if n in have else f"CAST(NULL AS {kind}) AS `{n}`" for n in names]
    )


def rename_ignoring_case(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Give columns that differ from a wanted name only in case that name."""
    by_lower = {w.lower(): w for w in wanted}
    return df.withColumnsRenamed(
        {c: by_lower[c.lower()] for c in df.columns if c.lower() in by_lower}
    )


def require_columns(df: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    """``df`` itself, or an error naming what is missing.  Needs no job."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{label}: missing required columns {missing}")
    return df


def retype(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Replace columns by their typed form, one projection for all of them."""
    return df.selectExpr(
        *[
            f"{parsing.typed_sql(df, n, types[n])} AS `{n}`" if n in types else f"`{n}`"
            for n in df.columns
        ]
    )


def conform(df: DataFrame, contract: Contract, optional: Sequence[str] = ()) -> DataFrame:
    """Names, order, types and text lengths of a load contract.

    Text is cleaned as a bulk load would: blank becomes null, undecodable characters are
    replaced, over-long values are cut to the declared length in characters.  An absent column is
    an error unless ``optional``; unreadable values become null, see ``rejections``.
    """
    require_columns(df, [f.name for f in contract if f.name not in optional], "load")
    out = []
    for field in contract:
        if field.name not in df.columns:
            column = F.lit(None).cast(field.type)
        elif field.type == "string":
            column = parsing.printable(parsing.blank_to_null(F.col(field.name).cast("string")))
            if field.max_chars:
                column = F.left(column, F.lit(field.max_chars))
        elif field.type.startswith("timestamp") and _is_text(df, field.name):
            column = parsing.load_timestamp(F.col(field.name)).try_cast(field.type)
        elif field.type == "date" and _is_text(df, field.name):
            column = parsing.load_timestamp(F.col(field.name)).try_cast("date")
        else:
            column = parsing.typed(df, field.name, field.type)
        out.append(column.alias(field.name))
    return df.select(*out)


def rejections(df: DataFrame, contract: Contract) -> dict[str, Column]:
    """Per column of ``df``, the rows whose value ``conform`` cannot read and turns into null."""
    typed = conform(df, contract, contract.names)
    plan = {}
    for field in contract:
        if field.type != "string" and field.name in df.columns and _is_text(df, field.name):
            if field.type.startswith("timestamp") or field.type == "date":
                value = parsing.load_timestamp(F.col(field.name)).try_cast(typed.schema[field.name].dataType)
            else:
                value = parsing.typed(df, field.name, field.type)
            plan[f"rejected_{field.name}"] = (
                parsing.blank_to_null(F.col(field.name)).isNotNull() & value.isNull()
            )
    return plan


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def sanitize_names(df: DataFrame) -> DataFrame:
    """Columns renamed by the identifier rule; a clash is an error rather than a silent merge."""
    names = []
    for name in df.columns:
        bare = re.sub("[^a-z0-9]+", "_", name.strip().lower()).strip("_")
        names.append(f"col_{bare}" if bare[:1].isdigit() else bare)
    if len(set(names)) != len(names):
        raise ValueError(f"column names clash after sanitising: {names}")
    return df.toDF(*names)


def trim_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: F.trim(n) for n in names})


def fill_zero(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.selectExpr(
        *[f"coalesce(`{n}`, 0.0D) AS `{n}`" if n in names else f"`{n}`" for n in df.columns]
    )
