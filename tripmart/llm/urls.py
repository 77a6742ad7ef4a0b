"""URL filters by dated lists: a capture is judged by the entries active when it was fetched.

List changes become validity intervals. Captures are reduced to their distinct (key, fetch time)
pairs, keys being the host, its parent domains and the path prefixes; an as-of join finds the interval
of each list that holds at that time. Both sides carry the time bucket, so a key meets only the
intervals around its own time and a busy host is spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import stored


def url_host(url: Column) -> Column:
    """Lower-cased host without user and port; empty if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.lower(F.coalesce(F.rtrim(found, F.lit(".")), F.lit("")))


def url_keys(url: Column) -> Column:
    """Host, parent domains and ``host/path`` prefixes of whole segments; none for other texts."""
    host = url_host(url)
    labels = F.split(host, r"\.")
    path = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    steps = F.filter(F.split(path, "/"), lambda s: s != "")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    prefixes = F.when(F.size(steps) > 0, F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda k: F.concat_ws("/", host, F.slice(steps, F.lit(1), k))))
    none = F.array().cast("array<string>")
    keys = F.array_distinct(F.concat(domains, F.coalesce(prefixes, none)))
    return F.when(host == "", none).otherwise(F.coalesce(keys, none))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, verdict, key, valid_from, valid_to) of (list, verdict, key, action, at).

    An ``add`` opens the entry and a ``remove`` closes it from that instant on; at the same instant
    the removal counts. Adding what is there and removing what is not changes nothing. ``valid_to``
    is exclusive and null while the entry is open. Rows without key or time are void.
    """
    entry = Window.partitionBy("list", "verdict", "key").orderBy("at")
    state = (
        entries.filter(F.col("key").isNotNull() & F.col("at").isNotNull() & F.col("action").isin("add", "remove"))
        .groupBy("list", "verdict", "key", "at").agg(F.bool_and(F.col("action") == "add").alias("active"))
        .withColumn("was", F.coalesce(F.lag("active").over(entry), F.lit(False)))
        .filter(F.col("active") != F.col("was"))
        .withColumn("valid_to", F.lead("at").over(entry))
    )
    return state.filter("active").select("list", "verdict", "key", F.col("at").alias("valid_from"), "valid_to")


def url_verdicts(
    captures: DataFrame,
    entries: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    time_col: str = "fetched_at",
    bucket: str = "month",
) -> DataFrame:
    """(id, url, time, host, n_active, matched, blocked) of every capture.

    ``entries`` has list, verdict ('block' or 'allow'), key, action ('add' or 'remove') and at, of
    the type of the captures' time. ``n_active`` counts the entries active for the capture;
    ``matched`` is the longest key among them, whose verdict decides, a block before an allow.
    Without url, host, time or active entry a capture is not blocked and ``matched`` is null.
    Repeated rows and ids give one result row each; other columns are neither read nor returned.
    """
    rows = stored(  # row numbers must not change between the two uses
        captures.select(
            F.monotonically_increasing_id().alias("row_no"), F.col(id_col).alias("id"), F.col(url_col).alias("url"),
            F.col(time_col).alias("at")),
        "captures")
    keyed = rows.filter(F.col("at").isNotNull()).select("row_no", "at", F.explode(url_keys(F.col("url"))).alias("key"))
    period = lambda c: F.date_trunc(bucket, c)
    pairs = keyed.select("key", "at").distinct().withColumn("bucket", period(F.col("at")))
    seen = rows.agg(period(F.min("at")).alias("first"), period(F.max("at")).alias("last")).first()
    intervals = validity_intervals(entries)
    if seen.first is None:
        spread = intervals.withColumn("bucket", F.lit(None).cast("timestamp")).limit(0)
    else:
        first, last = F.lit(seen.first), F.lit(seen.last)
        begin = F.greatest(period(F.col("valid_from")), first)
        end = F.least(period(F.coalesce(F.col("valid_to"), last)), last)
        step = F.expr(f"interval 1 {bucket}")
        spread = intervals.withColumn(
            "bucket", F.explode(F.when(begin <= end, F.sequence(begin, end, step))))
    active = (
        pairs.join(spread, ["key", "bucket"])
        .filter((F.col("at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to"))))
        .groupBy("key", "at")
        .agg(F.count(F.lit(1)).alias("entries"), F.max((F.col("verdict") == "block").cast("int")).alias("block"))
    )
    judged = (
        keyed.join(active, ["key", "at"])
        .groupBy("row_no")
        .agg(F.sum("entries").alias("n_active"),
             F.max(F.struct(F.length("key").alias("length"), "key", "block")).alias("best"))
    )
    return rows.join(judged, "row_no", "left").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("at").alias(time_col),
        url_host(F.col("url")).alias("host"), F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.col("best.key").alias("matched"), (F.coalesce("best.block", F.lit(0)) == 1).alias("blocked"))
