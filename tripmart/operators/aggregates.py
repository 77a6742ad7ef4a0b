"""One-pass profiles, duplicates, shares, labelled unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Money is added up in whole ten-thousandths, apart from amounts beyond the limit and what is no number.
MONEY_UNITS = 10_000
MONEY_LIMIT = 1e11


def money_units(column: str) -> Column:
    """Sum of an amount in whole ten-thousandths as a bigint; overflow is an error, not a wrong sum."""
    amount = F.col(column)
    whole = F.rint(amount * MONEY_UNITS).cast("bigint")
    return F.sum(F.when(F.abs(amount) < MONEY_LIMIT, whole))


def money_rest(column: str) -> Column:
    """Sum of the amounts that ``money_units`` leaves out; null where there are none, as there should be."""
    amount = F.col(column)
    return F.sum(F.when(~(F.abs(amount) < MONEY_LIMIT), amount))


def money_of(units: Column, rest: Column) -> Column:
    """The amount as a double again, null if there was none."""
    exact = units / F.lit(float(MONEY_UNITS))
    return F.coalesce(exact + rest, exact, rest)


def money_sum(column: str) -> Column:
    """Sum of amounts, the same to the last bit in whatever order and partitions they are added.

    Each amount counts to a ten-thousandth; a sum of doubles drifts with the number of rows.
    """
    return money_of(money_units(column), money_rest(column))


def total_or_zero(column: str) -> Column:
    return F.coalesce(money_sum(column), F.lit(0.0))


def profile(df: DataFrame, conditions: Mapping[str, Column], **others: Column) -> DataFrame:
    """One row in one pass: ``others`` as given, then how many rows meet each condition.

    ``count_if`` gives 0 on an empty frame where a conditional sum would give null.
    """
    counted = [F.count_if(c).alias(n) for n, c in conditions.items()]
    return df.agg(*[c.alias(n) for n, c in others.items()], *counted)


def null_conditions(names: Sequence[str], suffix: str = "_nulls") -> dict[str, Column]:
    return {f"{n}{suffix}": F.col(n).isNull() for n in names}


def overview(datasets: Mapping[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Row count and first / last date per dataset; no date column gives typed nulls."""
    parts = []
    for name, (df, day) in datasets.items():
        first, last = (
            (F.min(day), F.max(day)) if day else (F.lit(None).cast("date"), F.lit(None).cast("date"))
        )
        parts.append(
            df.agg(
                F.lit(name).alias("dataset_name"),
                F.count("*").alias("row_count"),
                first.alias("min_date"),
                last.alias("max_date"),
            )
        )
    return stacked(parts)


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Columns of several one-row frames in one row, without a join.

    The frames are stacked with nulls for each other's columns; ``max`` picks the only value.
    """
    both = stacked(rows)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def row_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of every dataset."""
    return side_by_side(*[df.agg(F.count("*").alias(name)) for name, df in datasets.items()])


def duplicate_groups(df: DataFrame, keys: Sequence[str], name: str = "duplicate_count") -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


def duplicate_group_count(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return duplicate_groups(df, keys).agg(F.count("*").alias(name))


def share_of_total(
    df: DataFrame, within: Sequence[str], shares: Mapping[str, str], positive_only: Sequence[str] = ()
) -> DataFrame:
    """Each value over its group's sum (new name -> column), 0.0 where the sum is 0.

    For names in ``positive_only`` a negative sum also gives 0.0.  Meant for aggregated rows:
    a group must be small enough for one task, such as the codes of one day.
    """
    group = Window.partitionBy(*within)
    out = {}
    for name, column in shares.items():
        total = F.sum(column).over(group)
        usable = total > 0 if name in positive_only else total != 0
        out[name] = F.when(usable, F.try_divide(F.col(column).cast("double"), total)).otherwise(0.0)
    return df.withColumns(out)


def grand_share(counts: DataFrame, column: str, name: str, digits: int = 2) -> DataFrame:
    """Percent of the grand total as a scalar subquery, so rows are not drawn into one task."""
    total = counts.agg(F.sum(column)).scalar()
    return counts.withColumn(name, F.round(F.lit(100.0) * F.col(column) / total, digits))


def top_by(df: DataFrame, measures: Sequence[str], tie_break: Sequence[str], k: int) -> DataFrame:
    """Largest ``k`` rows; the key as last sort column makes ties repeatable."""
    order = [F.col(m).desc() for m in measures] + [F.col(t).asc() for t in tie_break]
    return df.orderBy(*order).limit(k)


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})
