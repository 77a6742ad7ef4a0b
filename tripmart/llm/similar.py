"""N-gram Jaccard join of texts by the chosen-path method.

A text is the set of its word 5-grams, with a sketch of ``WIDTH`` minima of different hashes: each is
a token sampled from the set, and two sets agree in one with probability equal to their Jaccard
similarity. All sets start in one bucket; a bucket is split on sampled tokens, ``BRANCHES`` at a time,
so that sets sharing one go on together. Buckets of few sets, and those that a split leaves together,
are compared pair by pair; runs are repeated until the target recall. Equal sets are joined before.

* A pair is compared in the first bucket that both sets share and nowhere else, so nothing has to be
  deduplicated. Only sets with a likely partner in a bucket are sent there in full.
* A bucket of any size is compared in blocks, each pair of blocks in a task of its own. No pairs are
  put out: a block gives each of its sets a number of links and the least set it is connected to.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import bit_table, has_bits, join_same, stored
from tripmart.llm.hashing import scramble, span_keys
from tripmart.llm.words import Words, arrow_rows, chunks

WIDTH = 64
BRANCHES = 2
#: Sketch places that each level of splitting may sample from.
LEVELS = ((0, 8), (8, 24), (24, 44), (44, 64))

_SKETCH = pa.schema([("id", pa.int64()), ("version", pa.int64()), ("n", pa.int64()), ("a", pa.int64()),
                     ("b", pa.int64()), ("sketch", pa.list_(pa.int32()))])


def shingle_sets(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle key) of all distinct shingles, sorted, and where each text begins.

    A text of fewer than k words, but not none, is one shingle.
    """
    words = Words(texts)
    at, keys = words.grams(k)
    owner = words.text_of[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        first, count = words.first[short], words.counts[short]
        owner = np.concatenate([owner, short])
        keys = np.concatenate([keys, span_keys(words.keys, first, first + count)])
    order = np.lexsort((keys, owner))
    owner, keys = owner[order], keys[order]
    if len(keys):
        new = np.append(True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1]))
        owner, keys = owner[new], keys[new]
    return owner, keys, np.searchsorted(owner, np.arange(len(texts) + 1))


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(arrow_rows(batches), 2):
            _, keys, edge = shingle_sets([t for *_, t in part], k)
            n = np.diff(edge)
            some = np.flatnonzero(n)
            a, b = np.zeros(len(part), np.uint64), np.zeros(len(part), np.uint64)
            sketch = np.zeros((len(part), WIDTH), np.uint32)
            if len(some):
                at = edge[some]
                a[some] = np.add.reduceat(scramble(keys, 101), at)
                b[some] = np.bitwise_xor.reduceat(scramble(keys, 102), at)
                for j in range(WIDTH):
                    sketch[some, j] = np.minimum.reduceat((scramble(keys, j) >> np.uint64(32)).astype(np.uint32), at)
            flat = pa.array(sketch.view(np.int32).ravel())
            offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * WIDTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()),
                 pa.array(n), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                 pa.ListArray.from_arrays(offsets, flat)], schema=_SKETCH)

    return run


def runs_for(recall: float, similarity: float) -> int:
    """Runs needed for pairs at the threshold: in one run a pair stays together down any number of
    levels with probability q = 1 - (1 - s q) ** BRANCHES at least; runs are independent."""
    q = 1.0
    for _ in range(200):
        q = 1 - (1 - similarity * q) ** BRANCHES
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - q)))


def chosen_paths(sets: DataFrame, runs: int, few: int) -> DataFrame:
    """(path, node, size): the buckets to compare, each with two sets or more, of (node, sketch)."""
    value = lambda place: F.element_at("sketch", (place + 1).cast("int"))
    first, last = LEVELS[0]
    if runs * BRANCHES > last - first:
        raise ValueError(f"at most {(last - first) // BRANCHES} runs")
    start = F.array(*[
        F.xxhash64(F.lit(r), F.lit(j), value(F.lit(r * BRANCHES + j))) for r in range(runs) for j in range(BRANCHES)])
    rows = sets.select("node", F.lit(None).cast("long").alias("parent_size"), F.explode(start).alias("path"))
    leaves = None
    for level in range(1, len(LEVELS) + 1):
        rows = stored(rows.distinct(), "paths")
        size = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        sized = rows.join(size, "path")
        # few enough to compare, or a split that no longer splits
        stay = (F.col("size") <= few) | F.coalesce(2 * F.col("size") > F.col("parent_size"), F.lit(False))
        if level == len(LEVELS):
            stay = F.lit(True)
        done = sized.filter(stay).select("path", "node", "size")
        leaves = done if leaves is None else leaves.union(done)
        if level == len(LEVELS):
            break
        low, high = LEVELS[level]
        places = [low + F.pmod(F.xxhash64("path", F.lit(level)) + j * ((high - low) // BRANCHES), F.lit(high - low)) for j in range(BRANCHES)]
        rows = (
            sized.filter(~stay).join(sets.select("node", "sketch"), "node")
            .select("node", F.col("size").alias("parent_size"),
                    F.explode(F.array(*[F.xxhash64("path", F.lit(j), value(p)) for j, p in enumerate(places)])).alias("path"))
        )
    return leaves


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _matrix(group: pa.Table, name: str) -> np.ndarray:
    column = group[name].combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, -1)


def _likely(group: pa.Table, similarity: float) -> np.ndarray:
    """Pairs (i < j) that are compared in this bucket and may be similar."""
    m = group.num_rows
    sketch = _matrix(group, "sketch")
    n = group["n"].to_numpy().astype(np.int64)
    side = group["side"].to_numpy()
    path = group["path"][0].as_py()
    # 4.5 standard deviations below the expected agreement of a pair at the threshold
    least = WIDTH * similarity - 4.5 * math.sqrt(WIDTH * similarity * (1 - similarity))
    paths = group["paths"].to_pylist() if m <= 3 else None
    out = []
    for i0 in range(0, m, 128):
        i1 = min(m, i0 + 128)
        agree = np.zeros((i1 - i0, m), np.uint8)
        for t in range(WIDTH):
            agree += sketch[i0:i1, t, None] == sketch[None, :, t]
        small = np.minimum(n[i0:i1, None], n[None, :])
        large = np.maximum(n[i0:i1, None], n[None, :])
        ok = (agree >= least) & (small >= similarity * large - 1e-9)
        ok &= np.arange(m)[None, :] > np.arange(i0, i1)[:, None]
        if group["split"][0].as_py():
            ok &= side[i0:i1, None] != side[None, :]
        i, j = np.nonzero(ok)
        out.append(np.stack([i + i0, j], 1))
    pairs = np.concatenate(out)
    if not len(pairs):
        return pairs
    # the first path that both have
    paths = group["paths"].to_pylist()
    if len(pairs) <= 64:
        mine = [min(set(paths[i]).intersection(paths[j])) == path for i, j in pairs.tolist()]
        return pairs[np.array(mine, bool)]
    wide = max(map(len, paths))
    table = np.full((m, wide), np.iinfo(np.int64).max)
    for k, p in enumerate(paths):
        table[k, : len(p)] = sorted(p)
    earlier = np.zeros(len(pairs), bool)
    before = table < path
    for c in range(wide):
        use = before[:, c]
        if not use.any():
            continue
        v = table[pairs[:, 0], c]
        has = before[pairs[:, 0], c]
        for d in range(wide):
            earlier |= has & (table[pairs[:, 1], d] == v)
    return pairs[~earlier]


_KEYS = ["path", "bi", "bj"]


def _partners(similarity: float):
    """Sets of a bucket with a likely partner there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for group in groups(batches, _KEYS):
            pairs = _likely(group, similarity)
            if len(pairs):
                held.append(group.take(pa.array(np.unique(pairs))))
                rows += held[-1].num_rows
            if rows > 2000:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    return run


def _overlaps(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs."""
    if len(pairs) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in pairs.tolist()], np.int64)
    size = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), size)
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [c, c + width])
        part = np.zeros((len(sets), width), np.float32)
        part[row[a:b], column[a:b] - c] = 1
        total += part @ part.T
    return total[pairs[:, 0], pairs[:, 1]].astype(np.int64)


_LINKS = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("docs", pa.int64()), ("least", pa.int64())])


def _verify(similarity: float):
    """Per block: each set's links, the documents behind them, and the least set it is connected to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, _KEYS):
            # equal rows of the input bring the same set more than once
            _, once = np.unique(group["node"].to_numpy(), return_index=True)
            group = group.take(pa.array(np.sort(once)))
            pairs = _likely(group, similarity)
            if not len(pairs):
                continue
            sets = [np.frombuffer(x.as_py(), np.uint64) for x in group["members"]]
            n = np.array([len(s) for s in sets], np.int64)
            shared = _overlaps(sets, pairs)
            union = n[pairs[:, 0]] + n[pairs[:, 1]] - shared
            pairs = pairs[shared >= similarity * union - 1e-9]
            if not len(pairs):
                continue
            node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
            m = len(node)
            links = np.bincount(pairs.ravel(), minlength=m)
            docs = np.zeros(m, np.int64)
            np.add.at(docs, pairs[:, 0], copies[pairs[:, 1]])
            np.add.at(docs, pairs[:, 1], copies[pairs[:, 0]])
            least = node.copy()
            while True:
                low = np.minimum(least[pairs[:, 0]], least[pairs[:, 1]])
                new = least.copy()
                np.minimum.at(new, pairs[:, 0], low)
                np.minimum.at(new, pairs[:, 1], low)
                if (new == least).all():
                    break
                least = new
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[hit]), pa.array(links[hit]), pa.array(docs[hit]), pa.array(least[hit])], schema=_LINKS)

    return run


def _members(k: int, known):
    """The sets of the rows (id, version, key, text) whose key has its flag set."""
    schema = pa.schema([("id", pa.int64()), ("version", pa.int64()), ("members", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def wanted():
            for batch in batches:
                keys = batch.column(2).to_numpy().view(np.uint64)
                yield batch.take(pa.array(np.flatnonzero(has_bits(known.value, keys))))

        for part in chunks(arrow_rows(wanted()), 3):
            _, keys, edge = shingle_sets([t for *_, t in part], k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()),
                 pa.array([keys[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary())],
                schema=schema)

    return run


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of (u, v): the least node of each connected component.

    Alternates two steps that keep the components: every node hands its larger neighbours, then its
    smaller ones, to the least node around it. Ends when all edges point at their component's least.
    """
    edges = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("v", "m").union(small.select("u", "m")).toDF("u", "v").filter("u <> v").distinct()
        small = stored(small, "edges")
        state = "count(*)", "sum(cast(xxhash64(u, v) as decimal(38, 0)))"
        if edges.selectExpr(*state).first() == small.selectExpr(*state).first():
            return small.select(F.col("u").alias("node"), F.col("v").alias("component"))
        edges = small


def similar_texts(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    similarity: float = 0.8,
    recall: float = 0.999,
    few: int = 64,
    block: int = 512,
) -> DataFrame:
    """(id, version, class_id, n_links, n_links_text, n_grams, first) of every row of ``docs``.

    Two rows are linked if the sets of their word ``k``-grams (A-Z lower-cased; runs of ASCII letters
    and digits and of other characters) have a Jaccard similarity of ``similarity`` or more. ``n_links`` counts
    linked rows, ``n_links_text`` linked rows' distinct sets, ``class_id`` is the least id of the class,
    nulls first. ``first`` marks the row of each class that stays: the least by (id, version), where
    ``version`` is a hash of the text; of equal rows all are marked. A text of fewer than ``k`` words is
    one gram; without words (null, empty) a row is a class of its own and linked to none.
    Each pair is found with probability ``recall`` at least; what is found is exact. Other columns
    are neither read nor returned.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))
    sketches = stored(
        rows.mapInArrow(_sketches(k), "id long, version long, n long, a long, b long, sketch array<int>"), "sketches")
    key = ["a", "b", "n"]
    sets = stored(
        sketches.filter("n > 0").groupBy(*key)
        .agg(F.min(F.struct("id", "version")).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()), "distinct-sets")
    leaves = stored(chosen_paths(sets, runs_for(recall, similarity), few), "buckets")
    paths = leaves.groupBy("node").agg(F.array_sort(F.collect_set("path")).alias("paths"))
    # blocks of a large bucket meet in pairs; every set goes to the pairs that its block is in
    parts = F.ceil(F.col("size") / block).cast("int")
    mine = F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")).cast("int")
    meet = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(F.least(F.col("mine"), other).alias("bi"), F.greatest(F.col("mine"), other).alias("bj"),
                               (F.col("mine") > other).cast("int").alias("side")))
    placed = (
        leaves.withColumn("parts", parts).withColumn("mine", mine)
        .select("path", "node", F.explode(meet).alias("p"))
        .select("path", "node", "p.*", (F.col("p.bi") != F.col("p.bj")).alias("split"))
    )
    fields = "path long, node long, bi int, bj int, side int, split boolean, n long, copies long, sketch array<int>, paths array<long>"
    names = [f.split()[0] for f in fields.split(", ")]
    info = sets.select("node", "n", "copies", "sketch").join(paths, "node")
    likely = stored(
        placed.join(info, "node").select(*names)
        .repartition(*_KEYS).sortWithinPartitions(*_KEYS).mapInArrow(_partners(similarity), fields), "likely")
    # full sets of likely partners only; most rows are set aside before anything is sent
    wanted = sets.join(likely.select("node").distinct(), "node", "left_semi").select("node", "first.id", "first.version")
    known = docs.sparkSession.sparkContext.broadcast(
        bit_table(wanted.select(F.xxhash64("id", "version").alias("key"))))
    members = rows.select("id", "version", F.xxhash64("id", "version").alias("key"), "text").mapInArrow(
        _members(k, known), "id long, version long, members binary")
    links = stored(
        likely.join(join_same(wanted, members, ["id", "version"]).select("node", "members"), "node")
        .select(*names, "members")
        .repartition(*_KEYS).sortWithinPartitions(*_KEYS)
        .mapInArrow(_verify(similarity), "node long, links long, docs long, least long"), "links")
    component = connected(links.select(F.col("node").alias("u"), F.col("least").alias("v")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"), F.sum("docs").alias("docs"))
    known = (
        sets.drop("sketch").join(component, "node", "left").join(counts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    head = known.groupBy("component").agg(F.min("first").alias("head"))
    known = stored(known.join(head, "component").select(
        *key, "head", F.coalesce("links", F.lit(0)).alias("links"),
        (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("docs")), "classes")
    return (
        sketches.drop("sketch").join(known, key, "left")
        .select(
            F.col("id").alias(id_col), "version",
            F.when(F.col("n") > 0, F.col("head.id")).otherwise(F.col("id")).alias("class_id"),
            F.coalesce("docs", F.lit(0)).alias("n_links"), F.coalesce("links", F.lit(0)).alias("n_links_text"),
            F.col("n").alias("n_grams"),
            F.when(F.col("n") > 0, F.col("head").eqNullSafe(F.struct("id", "version"))).otherwise(True).alias("first"))
    )
