"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

Blocks are given to sources by the highest quotients target / (2 a + 1), a being the blocks a source
already has, and a source's blocks to its shards in the same way by their sizes. What a shard cannot
take of its blocks goes to other shards of its source. Within a shard of a
source the documents stand in a seeded order, cut into blocks of words that run on from the last
document to the first; the quota says how many blocks are taken. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import join_same, numbered, stored

_SPACE = r"\x20\x09-\x0D"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{_SPACE}]+")), F.lit(0)).cast("long")


def sainte_lague(cells: DataFrame, group: list[str], key: list[str], votes: str, seats: str) -> DataFrame:
    """(key, quota): the seats of each group dealt to its cells by the highest quotients.

    ``seats`` is a column with the number of seats, the same in all rows of a group; ``key`` names a
    cell and decides between equal quotients. For a divisor d that gives n seats to c cells with
    votes v in all, v / (n + c/2) <= d <= v / (n - c/2). So all but about one quotient per cell are
    known to win or lose beforehand, and a group has about two candidate rows per cell.
    """
    whole = Window.partitionBy(*group)
    v, n = F.col(votes).cast("double"), F.col(seats).cast("double")
    total, half = F.sum(v).over(whole), F.count(F.lit(1)).over(whole) / 2
    sure = F.greatest(F.lit(0), F.ceil(v * (n - half) / total - 0.5) - 1).cast("long")
    most = (F.floor(v * (n + half) / total + 0.5) + 1).cast("long")
    order = Window.partitionBy(*group).orderBy(
        F.desc("quotient"), *[F.asc_nulls_last(k) for k in key if k not in group], "a")
    return (
        cells.filter((F.col(votes) > 0) & (F.col(seats) > 0))
        .withColumns({"sure": sure, "most": most})
        .withColumn("left", F.col(seats) - F.sum("sure").over(whole))
        .withColumn("a", F.explode(F.sequence("sure", "most")))
        .withColumn("quotient", v / (2 * F.col("a") + 1))
        .withColumn("wins", (F.row_number().over(order) <= F.col("left")).cast("long"))
        .groupBy(*key).agg((F.first("sure") + F.sum("wins")).alias("quota"))
    )


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """(source, source_size, target) of (source, source_size).

    Sources in code point order, null last, have the weights in turn. They divide ``share`` of all
    sizes by weight; no target is above ``most`` times the source's size, and the excess goes to the
    others by weight until none is above.
    """
    listed = F.array(*[F.lit(int(w)) for w in weights])
    ranked = stored(
        numbered(sizes, [F.asc_nulls_last("source")], "rank")
        .withColumn("weight", F.element_at(listed, (F.col("rank") % len(weights) + 1).cast("int"))),
        "source-weights",
    )
    limit = F.col("source_size") * most
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    above, level = 0, (0.0, 1)
    open_ = F.lit(False)  # sources known to be at their limit
    while True:
        row = ranked.agg(
            F.sum(F.when(open_, limit).otherwise(0)).alias("held"),
            F.sum(F.when(open_, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not row.weight:
            break
        level = (total - (row.held or 0), row.weight)
        open_ = F.col("weight") * F.lit(level[0]) > limit * F.lit(level[1])
        now = ranked.filter(open_).count()
        if now == above:
            break
        above = now
    target = F.when(open_, limit.cast("double")).otherwise(F.col("weight") * F.lit(float(level[0])) / F.lit(level[1]))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    block_words: int = 64,
    shard_words: int = 1 << 17,
    seed: int = 0,
    carry: Sequence[str] = (),
) -> DataFrame:
    """How many words of each document the mix takes, repeats counted.

    Returns per row of ``docs``: id, ``source``, ``size`` (words), ``source_size``, ``target`` (of
    the source), ``taken`` (0 to ``most`` times ``size``) and the columns ``carry``. What is taken are
    ``n_whole`` copies of the document and its first ``n_part`` words once more. A source has as
    many shards as it has ``shard_words``, so a large one is worked on by many tasks and a small one
    is not cut into shards below a block. Null and empty texts have size 0 and take 0; null is a source of its
    own. Rows with the same id lie in the same shard; equal rows may swap their amounts. The result
    depends on rows and seed only, not on their order or partitions. Other columns are not read.
    """
    seeded = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"), seeded.alias("place"),
        F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(None).cast("int").alias("carried"),
    )
    sized = rows if carry else stored(rows.drop("carried"), "doc-sizes")
    narrow = stored(rows.select("source", "size", "place"), "doc-sizes") if carry else sized
    sharded = stored(
        narrow.groupBy("source").agg(F.sum("size").alias("_size"))
        .select("source", "_size", F.greatest(F.lit(1), F.ceil(F.col("_size") / shard_words)).cast("long").alias("_shards")),
        "source-shards",
    )
    row = sharded.agg(F.sum("_size"), F.count(F.lit(1))).first()
    total = row[0] or 0
    shards = sharded.drop("_size")
    if row[1] <= 1_000_000:
        shards = F.broadcast(shards)
    shard = (F.conv(F.substring("place", 1, 8), 16, 10).cast("long") % F.col("_shards")).alias("shard")
    cells = stored(
        join_same(narrow, shards, ["source"]).groupBy("source", shard).agg(F.sum("size").alias("cell_size")), "mix-cells"
    )
    sources = cells.groupBy("source").agg(F.sum("cell_size").alias("source_size"))
    targets = stored(source_targets(sources, weights, share, most), "source-targets")
    blocks = int(total * share / block_words + 0.5)
    by_source = sainte_lague(
        targets.withColumns({"all": F.lit(0), "seats": F.lit(blocks)}), ["all"], ["source"], "target", "seats"
    ).withColumnRenamed("quota", "seats")
    dealt = join_same(cells, by_source, ["source"])
    quotas = sainte_lague(dealt, ["source"], ["source", "shard"], "cell_size", "seats")
    given, limit = F.coalesce("quota", F.lit(0)) * block_words, F.col("cell_size") * most
    # what is above a cell's limit fills the room of its source's other cells in turn
    source = Window.partitionBy("source")
    before = source.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    room = F.greatest(F.lit(0), limit - given)
    over = F.sum(F.greatest(F.lit(0), given - limit)).over(source)
    more = F.least(room, F.greatest(F.lit(0), over - F.coalesce(F.sum(room).over(before), F.lit(0))))
    plan = join_same(cells, quotas, ["source", "shard"], "left").withColumn("amount", F.least(given, limit) + more)
    plan = join_same(plan, targets, ["source"])
    full = join_same(sized, shards, ["source"]).select("*", shard).drop("_shards")
    # position of a document's first word in its cell
    order = Window.partitionBy("source", "shard").orderBy("place", "id", "size")
    start = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    full = full.withColumn("start", start)
    rest = F.col("amount") % F.col("cell_size") - F.col("start")
    n_whole = F.when(F.col("size") > 0, F.expr("amount div cell_size")).otherwise(0)
    n_part = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least("size", rest))).otherwise(0)
    return (
        join_same(full, plan, ["source", "shard"])
        .select(F.col("id").alias(id_col), "source", "size", "source_size", "target",
                (n_whole * F.col("size") + n_part).cast("long").alias("taken"), n_whole.cast("long").alias("n_whole"),
                n_part.cast("long").alias("n_part"), *[F.col(f"carried.{c}").alias(c) for c in carry])
    )
