"""Joins of large frames to keyed tables, and comparisons of key sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a keyed table that may be broadcast by hint: more than five centuries of days.
BROADCAST_ROWS = 200_000


def left_lookup(
    df: DataFrame,
    table: DataFrame,
    on: Mapping[str, str],
    columns: Mapping[str, str] | Sequence[str] = (),
    row_bound: int | None = None,
) -> DataFrame:
    """Left join adding ``columns`` of ``table`` (given by name, or as new name -> name).

    ``table`` must hold one row per key.  It is broadcast by hint only when the caller can prove
    ``row_bound`` (say, days of a date window); without a proof the choice stays with Spark's
    own size check, static for files and adaptive for everything else.
    """
    wanted = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    marks = {f"_key{i}": right for i, right in enumerate(on.values())}
    side = table.selectExpr(
        *[f"`{c}` AS {mark}" for mark, c in marks.items()],
        *[f"`{c}` AS `_new_{n}`" for n, c in wanted.items()],
    )
    if row_bound is not None and row_bound <= BROADCAST_ROWS:
        side = F.broadcast(side)
    condition = F.expr(" AND ".join(f"`{x}` = {m}" for x, m in zip(on, marks, strict=True)))
    kept = [f"`{c}`" for c in df.columns if c not in wanted]
    return df.join(side, condition, "left").selectExpr(
        *kept, *[f"`_new_{n}` AS `{n}`" for n in wanted]
    )


def orphan_rows(df: DataFrame, table: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of ``df`` whose key is null or absent from ``table``."""
    keys = table.select(*[F.col(r).alias(f"_key{i}") for i, r in enumerate(on.values())])
    condition = [F.col(left) == F.col(f"_key{i}") for i, left in enumerate(on)]
    return df.join(keys, condition, "left_anti")


def unmatched_counts(
    df: DataFrame,
    checks: Mapping[str, tuple[str, DataFrame, str, int | None]],
    conditions: Mapping[str, Column] | None = None,
    total: str | None = None,
) -> DataFrame:
    """One row: per name, the rows of ``df`` whose column has no partner in a keyed table.

    ``checks`` maps an output name to (column, keyed table, its key, proven row bound).  Rows are
    first counted per combination of the key columns, so neither a hot key nor a large table can
    pull the rows of ``df`` through a join.  ``conditions`` are counted in the same pass, and all
    rows under the name ``total``.
    """
    conditions = conditions or {}
    keys = list(dict.fromkeys(column for column, *_ in checks.values()))
    groups = df.groupBy(*keys).agg(
        F.count("*").alias("_rows"), *[F.count_if(c).alias(f"_met_{n}") for n, c in conditions.items()]
    )
    for name, (column, table, key, bound) in checks.items():
        found = table.select(key).withColumn("_there", F.lit(True))
        groups = left_lookup(groups, found, {column: key}, {f"_found_{name}": "_there"}, bound)
    return groups.agg(
        *[
            F.coalesce(
                F.sum(F.when(F.col(f"_found_{n}").isNull(), F.col("_rows"))), F.lit(0)
            ).alias(n)
            for n in checks
        ],
        *[F.coalesce(F.sum(f"_met_{n}"), F.lit(0)).alias(n) for n in conditions],
        *([F.coalesce(F.sum("_rows"), F.lit(0)).alias(total)] if total else []),
    )


def missing_keys(have: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``wanted`` absent from ``have``.

    Both sides are made distinct first: the partial aggregate shrinks hot keys before the
    exchange and the anti join reuses that partitioning.
    """
    return (
        wanted.select(*keys).distinct().join(have.select(*keys).distinct(), list(keys), "left_anti")
    )


def keyset_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys only on the left, keys only on the right, from a single aggregation."""
    per_key = stacked_sides(left, right, keys).groupBy(*keys).agg(
        F.bool_or("_left").alias("_in_left"), F.bool_or(~F.col("_left")).alias("_in_right")
    )
    return per_key.agg(
        F.count_if(~F.col("_in_right")).alias("only_left"),
        F.count_if(~F.col("_in_left")).alias("only_right"),
    )


def packed_key(key: str) -> dict[str, Column]:
    """A text key as two columns that are equal where it is: the bytes of small hex digits, any other text as it is.

    Digests in hex take half the room as bytes, and no codec makes their digits shorter.
    """
    in_hex = F.coalesce(F.lower(F.hex(F.unhex(key))) == F.col(key), F.lit(False))
    return {"_bytes": F.when(in_hex, F.unhex(key)), "_text": F.when(~in_hex, F.col(key))}


DIGEST_BUCKETS = 4096


def key_bucket(keys: Sequence[str], buckets: int = DIGEST_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def key_digests(
    df: DataFrame, keys: Sequence[str], within: Sequence[str] = (), buckets: int = DIGEST_BUCKETS
) -> DataFrame:
    """One row per group of ``within`` and bucket: how many keys, and sums over two hashes of each.

    The sums do not depend on order, are added up on the map side, and differ for different key
    collections but for a chance of about 2**-128. They add up, too: digests of months or files that
    are kept can be summed instead of reading the rows again.
    """
    hashes = {"a": F.xxhash64(*keys), "b": F.xxhash64(F.lit(1), *keys)}
    halves = {}
    for name, h in hashes.items():
        halves[f"{name}0"] = h.bitwiseAND(F.lit(0xFFFFFFFF))
        halves[f"{name}1"] = F.shiftrightunsigned(h, 32)
    hashed = df.select(*within, key_bucket(keys, buckets).alias("bucket"), *[c.alias(n) for n, c in halves.items()])
    return hashed.groupBy(*within, "bucket").agg(
        F.count("*").alias("n"), *[F.sum(n).alias(n) for n in halves]
    )


def differing_buckets(left: DataFrame, right: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Groups and buckets whose digests are not the same on both sides."""
    at = [*within, "bucket"]
    sums = [c for c in left.columns if c not in at]
    sides = stacked_sides(left, right, [*at, *sums])
    both = sides.groupBy(*at, *sums).agg(F.count("*").alias("sides"))
    return both.filter("sides = 1").select(*at).distinct()


def stacked_sides(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    return left.select(*columns, F.lit(True).alias("_left")).unionByName(
        right.select(*columns, F.lit(False).alias("_left"))
    )


def keyset_differences(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    within: Sequence[str] = (),
    buckets: int = DIGEST_BUCKETS,
) -> DataFrame:
    """``keyset_difference``, comparing keys only where the digests of both sides differ.

    Both sides are first reduced to digests of ``buckets`` per group of ``within`` (columns of both
    sides, few values, such as year and month). Only keys of differing buckets are exchanged, none at
    all for equal tables, and a table with few deviations exchanges the keys that share their buckets.
    A key that moved to another group is no difference. Null keys are equal to each other.
    """
    differ = differing_buckets(
        key_digests(left, keys, within, buckets), key_digests(right, keys, within, buckets), within
    ).withColumnsRenamed({c: f"_at_{c}" for c in [*within, "bucket"]})
    same = F.col("_bucket") == F.col("_at_bucket")
    for c in within:
        same = same & F.col(f"_in_{c}").eqNullSafe(F.col(f"_at_{c}"))

    def suspects(df: DataFrame) -> DataFrame:
        bucket = key_bucket(keys, buckets).alias("_bucket")
        rows = df.select(*keys, bucket, *[F.col(c).alias(f"_in_{c}") for c in within])
        # at most one row for each group and bucket; the size is known when the join is planned
        return rows.join(differ, same, "left_semi").select(*keys)

    return keyset_difference(suspects(left), suspects(right), keys)


def differing(
    left: Column,
    right: Column,
    null_safe: bool = False,
    tolerance: float | None = None,
    relative: float = 0.0,
) -> Column:
    """Do two values differ?  Null on either side is no difference unless ``null_safe``."""
    if tolerance is not None:
        slack = F.lit(tolerance) + F.lit(relative) * F.greatest(F.abs(left), F.abs(right))
        apart = F.abs(left - right) > slack
        if null_safe:
            return F.coalesce(apart, left.isNull() != right.isNull())
        return apart
    return ~left.eqNullSafe(right) if null_safe else left != right


def any_of(conditions: Sequence[Column]) -> Column:
    """OR of the conditions, a null one counting as false."""
    combined = F.lit(False)
    for condition in conditions:
        combined = combined | F.coalesce(condition, F.lit(False))
    return combined


def full_outer_mismatches(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    exact: Mapping[str, str] | None = None,
    close: Mapping[str, str] | None = None,
    tolerance: float = 0.01,
    relative: float = 0.0,
) -> DataFrame:
    """Rows on one side only, or with differing values (left name -> right name)."""
    exact, close = exact or {}, close or {}
    a = left.select(*keys, *[F.col(c).alias(f"l_{c}") for c in [*exact, *close]], F.lit(1).alias("_l"))
    b = right.select(
        *keys, *[F.col(c).alias(f"r_{c}") for c in [*exact.values(), *close.values()]],
        F.lit(1).alias("_r"),
    )
    bad = [F.col("_l").isNull(), F.col("_r").isNull()]
    bad += [differing(F.col(f"l_{x}"), F.col(f"r_{y}")) for x, y in exact.items()]
    bad += [
        differing(F.col(f"l_{x}"), F.col(f"r_{y}"), tolerance=tolerance, relative=relative)
        for x, y in close.items()
    ]
    return a.join(b, list(keys), "full_outer").filter(any_of(bad)).drop("_l", "_r")
