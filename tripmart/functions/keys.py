"""Surrogate keys and code labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart import schemas as S


def surrogate_key(columns: Sequence[str], separator: str = S.KEY_SEPARATOR) -> Column:
    """SHA-256 over the text of ``columns``; null and empty text give the same key."""
    parts = ", ".join(f"coalesce(CAST(`{c}` AS string), '')" for c in columns)
    return F.expr(f"sha2(concat_ws('{separator}', {parts}), 256)")


def payment_label(code: Column) -> Column:
    """Display name of a payment code, by lookup in a literal map."""
    entries = [F.lit(x) for pair in S.PAYMENT_LABELS.items() for x in pair]
    known = F.create_map(*entries)[code]
    return F.when(code.isNull(), F.lit(S.PAYMENT_LABEL_MISSING)).otherwise(
        F.coalesce(known, F.lit(S.PAYMENT_LABEL_OTHER))
    )


def payment_code(code: Column) -> Column:
    return F.coalesce(code, F.lit(S.PAYMENT_CODE_MISSING))
