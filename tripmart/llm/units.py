"""Substring dedup by hashing units of text.

A line is a unit; within longer lines units end at content-defined words as well, so that a passage
gives the same units wherever in a line it stands. Units are normalised to their words, digests are
grouped globally, the earliest occurrence by (id, text, place) is kept and the others are removed.
Units at the ends of a passage may hold words from around it, so what adjoins removed units goes word
by word as far as it equals what adjoins their first copy; the texts of candidates are read again for
this. Offsets are those of the original text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import BIT_TABLE, bit_table, has_bits, join_same, stored
from tripmart.llm.hashing import span_keys
from tripmart.llm.words import Words, arrow_rows, chunks

_UNITS = pa.schema([("id", pa.int64()), ("version", pa.int64()), ("unit", pa.int64()), ("digest", pa.int64()),
                    ("begin", pa.int64()), ("end", pa.int64()), ("n_words", pa.int64()),
                    ("before", pa.int32()), ("after", pa.int32())])
_UNITS_DDL = "id long, version long, unit long, digest long, begin long, end long, n_words long, before int, after int"
_LONGEST = 64  # words of a unit
_FLAGS = 29  # most bits of the table of repeated digests, 64 MB; when full it only lets more units pass
_CHARS = 250_000  # characters of the texts that a task holds as arrays at a time
_SPACING = 16  # least words between boundaries at equal keys
_NEAR = 4  # words to both sides of a unit that tell whether it is worth extending
_EDGES = pa.list_(pa.struct([("key", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())]))


def unit_starts(words: Words, reach: int) -> np.ndarray:
    """First words of units: of texts, of lines, and where a word pair's key is a local minimum.

    The minimum is over ``reach`` words to both sides, so inside a passage units depend on the passage
    alone but for about ``reach`` words at its ends. Words of a short period have minima all alike:
    long units end at those, ``_SPACING`` words apart, and at ``_LONGEST`` words without any.
    """
    n = len(words)
    starts = np.zeros(n, bool)
    starts[words.first[words.counts > 0]] = True
    line = np.cumsum(words.data == 0x0A)
    at = line[words.begin]
    starts[1:] |= at[1:] != at[:-1]
    level = np.zeros(n, bool)
    if n > 2 * reach:
        key = span_keys(words.keys, np.arange(n - 1), np.arange(n - 1) + 2)
        text = words.text_of
        low = text[1:] == text[:-1]
        ties = low.copy()
        for d in range(1, reach + 1):
            other = text[d + 1 :] != text[: -d - 1]  # not within one text: no say
            low[d:] &= other | (key[d:] < key[:-d])
            low[:-d] &= other | (key[:-d] <= key[d:])
            ties[d:] &= other | (key[d:] <= key[:-d])
            ties[:-d] &= other | (key[:-d] <= key[d:])
        starts[:-1] |= low
        level[:-1] = ties
    first = np.flatnonzero(starts)
    size = np.diff(np.append(first, n))
    level = np.flatnonzero(level)
    for a, length in zip(first[size > _SPACING].tolist(), size[size > _SPACING].tolist(), strict=True):
        at, to = a, a + length
        while to - at > _SPACING:
            k = np.searchsorted(level, at + _SPACING)
            cut = int(level[k]) if k < len(level) else n
            cut = min(cut, at + _LONGEST)
            if cut >= to:
                break
            starts[cut] = True
            at = cut
    return np.flatnonzero(starts)


def _near(words: Words, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """32 bits of the words from ``at`` to ``to``, 0 for fewer than ``_NEAR`` of them."""
    whole = to - at == _NEAR
    bits = (span_keys(words.keys, at, to) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return np.where(whole, bits, 0).astype(np.int32)


def _digests(reach: int):
    """The digest of every unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(arrow_rows(batches), 0, _CHARS):
            words = Words([t for (t,) in part])
            if len(words):
                first = unit_starts(words, reach)
                keys = span_keys(words.keys, first, np.append(first[1:], len(words)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["digest"])

    return run


def _cut(reach: int, known):
    """The units whose digest has its flag set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(arrow_rows(batches), 2, _CHARS):
            words = Words([t for *_, t in part])
            if not len(words):
                continue
            first = unit_starts(words, reach)
            end = np.append(first[1:], len(words))
            digest = span_keys(words.keys, first, end)
            number = np.arange(len(first)) - np.searchsorted(words.text_of[first], words.text_of[first])
            told = has_bits(known.value, digest)
            first, end, digest, number = first[told], end[told], digest[told], number[told]
            text = words.text_of[first]
            # code points before each byte, counted from the start of the text
            points = np.concatenate([[0], np.cumsum((words.raw & 0xC0) != 0x80)])
            base = points[words.text_at[text]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part[k][0] for k in text.tolist()], pa.int64()),
                 pa.array([part[k][1] for k in text.tolist()], pa.int64()),
                 pa.array(number, pa.int64()),
                 pa.array(digest.view(np.int64)),
                 pa.array(points[words.begin[first]] - base, pa.int64()),
                 pa.array(points[words.end[end - 1]] - base, pa.int64()),
                 pa.array(end - first, pa.int64()),
                 pa.array(_near(words, np.maximum(first - _NEAR, words.first[text]), first)),
                 pa.array(_near(words, end, np.minimum(end + _NEAR, words.ends[first])))], schema=_UNITS)

    return run


def _edges(reach: int, skip: int):
    """Words before and after units: per asked (unit, side) keys and offsets, outwards from the unit.

    The first ``skip`` words are left out, and those from the ``most``-th on.
    """
    schema = pa.schema([("id", pa.int64()), ("version", pa.int64()), ("unit", pa.int64()), ("side", pa.int32()), ("words", _EDGES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(arrow_rows(batches), 2, _CHARS):
            words = Words([r[2] for r in part])
            if not len(words):
                continue
            first = unit_starts(words, reach)
            end = np.append(first[1:], len(words))
            of = np.searchsorted(words.text_of[first], np.arange(len(part)))
            points = np.concatenate([[0], np.cumsum((words.raw & 0xC0) != 0x80)])
            base = points[words.text_at[:-1]]
            asks, spans = [], []
            for k, (doc, version, _, asked) in enumerate(part):
                for ask in asked:
                    unit, side, most = ask["unit"], ask["side"], ask["most"]
                    u = of[k] + unit
                    if side == 0:
                        at = np.arange(first[u] - 1 - skip, max(words.first[k], first[u] - most) - 1, -1)
                    else:
                        at = np.arange(end[u] + skip, min(words.first[k] + words.counts[k], end[u] + most))
                    asks.append((doc, version, unit, side))
                    spans.append(at)
            if asks:
                at, edge = np.concatenate(spans), np.cumsum([0, *map(len, spans)])
                start = base[words.text_of[at]]
                listed = pa.StructArray.from_arrays(
                    [pa.array(words.keys.view(np.int64)[at]), pa.array(points[words.begin[at]] - start),
                     pa.array(points[words.end[at]] - start)], fields=list(_EDGES.value_type))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*asks, strict=True), schema.types, strict=False)]
                    + [pa.ListArray.from_arrays(pa.array(edge, pa.int32()), listed)], schema=schema)

    return run


def _flagged(known):
    """Rows whose key has its flag set, without the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            kept = batch.filter(pa.array(has_bits(known.value, keys)))
            yield kept.select([0, 1, 2])

    return run


def _equal_words(own: str, other: str) -> Column:
    """Words of ``own`` as far as their keys equal those in ``other``."""
    own, other = F.col(own), F.col(other)
    most = F.least(F.size(own), F.size(other))
    differs = F.filter(
        F.transform(F.slice(own, 1, most), lambda x, i: F.when(x["key"] != F.get(other, i), i)), lambda x: x.isNotNull())
    return F.slice(own, 1, F.coalesce(F.get(differs, 0), most))


_EDGE_LIST = "array<struct<key:bigint,begin:bigint,end:bigint>>"


_PART = ["id", "version", "run", "part"]
_LOOK = 16  # words next to a passage that are compared at first


def _asked_words(rows: DataFrame, asked: DataFrame, reach: int, skip: int) -> DataFrame:
    """(id, version, unit, side, words) for everything asked of the texts in ``rows``.

    Always dealt, also where few rows are asked for: next to a broadcast both Python steps would run in
    one task, with two workers for every core of an executor.
    """
    known = rows.sparkSession.sparkContext.broadcast(bit_table(asked.select(F.xxhash64("id", "version").alias("key"))))
    few = rows.withColumn("key", F.xxhash64("id", "version")).mapInArrow(_flagged(known), "id long, version long, text string")
    return join_same(few, asked.hint("merge"), ["id", "version"]).select("id", "version", "text", "asked").mapInArrow(
        _edges(reach, skip), f"id long, version long, unit long, side int, words {_EDGE_LIST}")


def _equal_ends(rows: DataFrame, parts: DataFrame, reach: int) -> DataFrame:
    """(id, version, run, part, side0, side1): words next to a part that equal those next to its first copy.

    A few words are fetched for every end; where all of them are equal, four times as many more, and so on.
    """
    of = lambda c, side: [F.col(c)[k].alias(f"_{k}") for k in ("id", "version", "unit")] + [F.col(f"most{side}").alias("most")]
    ends = [parts.filter(f"most{side} > 0").select(*_PART, F.lit(side).alias("side"), F.col(own).alias("unit"), *of(other, side))
            for side, own, other in ((0, "from", "first"), (1, "to", "final"))]
    unit = ["id", "version", "unit"]
    left, found, skip, step = stored(ends[0].union(ends[1]), "open-ends"), [], 0, _LOOK
    columns = left.columns
    while True:
        upto = F.least("most", F.lit(skip + step)).alias("most")
        both = left.select(*unit, "side", upto).union(left.select(*[f"_{k}" for k in unit], "side", upto))
        asked = stored(
            both.groupBy(*unit, "side").agg(F.max("most").alias("most"))
            .groupBy("id", "version").agg(F.collect_list(F.struct("unit", "side", "most")).alias("asked")), "asked-edges")
        edges = stored(_asked_words(rows, asked, reach, skip), "passage-edges")
        # rows equal in id and text give the same words
        if not edges.groupBy(*unit, "side").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            edges = edges.dropDuplicates([*unit, "side"])
        own = edges.withColumnRenamed("words", "_own")
        other = edges.select(*[F.col(k).alias(f"_{k}") for k in unit], "side", F.transform("words", lambda w: w["key"]).alias("_keys"))
        pairs = join_same(join_same(left, own, [*unit, "side"]), other, [*[f"_{k}" for k in unit], "side"])
        room = F.least("most", F.lit(skip + step)) - skip
        equal = F.slice(_equal_words("_own", "_keys"), F.lit(1), room)
        compared = stored(pairs.select(*columns, equal.alias("words")).withColumn("whole", F.size("words") == step), "equal-words")
        found.append(compared.select(*_PART, "side", F.lit(skip).alias("skip"), "words"))
        left = compared.filter(F.col("whole") & (F.col("most") > skip + step)).select(*columns)
        if left.isEmpty():
            break
        skip, step = skip + step, step * 4
    words = found[0]
    for more in found[1:]:
        words = words.union(more)
    side = lambda k: F.flatten(F.transform(F.sort_array(F.collect_list(F.when(F.col("side") == k, F.struct("skip", "words")))), lambda x: x["words"]))
    return words.groupBy(*_PART).agg(side(0).alias("side0"), side(1).alias("side1"))


def repeated_passages(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 24,
    reach: int = 4,
) -> DataFrame:
    """(id, version, begin, end, n_words, n_units, first_id, first_begin): passages to remove.

    A passage is a run of units that all occur earlier, somewhere, with the words next to it that
    equal those next to the first copy; shorter ones than ``min_words`` words stay. It is given in
    parts, one for each place of kept copies, that adjoin. Earlier is by (id, version, place), nulls
    first; ``version`` is a hash of the text, so rows equal in id and text are one document. ``begin``
    and ``end`` (exclusive) count code points of the original text; ``first_id`` and ``first_begin``
    tell where the kept copy of the part's first unit is. Null and empty texts have no units. Other
    columns are neither read nor returned.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))
    # digests alone tell which units occur again; the others are not looked at any further
    digests = rows.select("text").mapInArrow(_digests(reach), "digest long").groupBy("digest")
    again = stored(digests.agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("digest").alias("key")), "repeated-digests")
    bits = min(_FLAGS, max(BIT_TABLE, (4 * again.count()).bit_length()))
    known = docs.sparkSession.sparkContext.broadcast(bit_table(again, bits))
    units = stored(rows.mapInArrow(_cut(reach, known), _UNITS_DDL), "text-units")
    place = F.struct("id", "version", "unit", "begin", "before", "after")
    firsts = units.groupBy("digest").agg(F.min(place).alias("first"))
    later = (
        units.join(firsts, "digest").filter(place != F.col("first"))
        .select("id", "version", "unit", "begin", "end", "n_words", "before", "after", "first")
        # rows equal in id and text are one document; dealt as the windows below need them
        .repartition("id", "version").dropDuplicates(["id", "version", "unit"])
    )
    document = Window.partitionBy("id", "version").orderBy("unit")
    back = F.lag(F.struct("unit", "first")).over(document)
    follows = F.coalesce(F.col("unit") == back["unit"] + 1, F.lit(False))
    goes_on = follows & (F.col("first.unit") == back["first"]["unit"] + 1) & (
        F.col("first.id").eqNullSafe(back["first"]["id"])) & (F.col("first.version") == back["first"]["version"])
    parts = (
        later.withColumns({"opens": (~follows).cast("int"), "turns": (~goes_on).cast("int")})
        .withColumns({"run": F.sum("opens").over(document), "part": F.sum("turns").over(document)})
        .groupBy("id", "version", "run", "part")
        .agg(F.min("begin").alias("begin"), F.max("end").alias("end"), F.sum("n_words").alias("n_words"),
             F.count(F.lit(1)).alias("n_units"), F.min("unit").alias("from"), F.max("unit").alias("to"),
             F.min_by("first", "unit").alias("first"), F.max_by("first", "unit").alias("final"),
             F.min_by("before", "unit").alias("before"), F.max_by("after", "unit").alias("after"))
    )
    run = Window.partitionBy("id", "version", "run")
    ordered = run.orderBy("part")
    parts = parts.withColumns({
        "all_words": F.sum("n_words").over(run), "is_head": F.row_number().over(ordered) == 1,
        "next_begin": F.lead("begin").over(ordered),
        "back": F.lag(F.struct("first", "n_words")).over(ordered), "ahead": F.lead(F.struct("first", "n_words")).over(ordered)})
    # too few words and too few equal ones next to them on both sides: not worth the look
    left = F.col("is_head") & (F.col("before") != 0) & (F.col("before") == F.col("first.before"))
    right = F.col("next_begin").isNull() & (F.col("after") != 0) & (F.col("after") == F.col("final.after"))
    worth = F.max((F.col("all_words") + 2 * (_NEAR - 1) >= min_words) | left | right).over(run)
    # where the next words differ, fewer than ``_NEAR`` of them can be equal; towards a part of the same
    # passage only as many count as that one has, and only if it was first kept later
    def most(outer: Column, near: Column, other: str) -> Column:
        within = (near | (F.col(other)["n_words"] < _NEAR)) & (F.col("first") < F.col(other)["first"]) & (F.col(other)["n_words"] <= 2 * _LONGEST)
        far = F.when(near, 2 * _LONGEST).otherwise(_NEAR - 1)
        return F.when(outer, far).when(within, F.col(other)["n_words"]).otherwise(0).cast("int")

    near_left = (F.col("before") != 0) & (F.col("before") == F.col("first.before"))
    near_right = (F.col("after") != 0) & (F.col("after") == F.col("final.after"))
    parts = parts.withColumns({"most0": most(F.col("is_head"), F.coalesce(near_left, F.lit(False)), "back"),
                               "most1": most(F.col("next_begin").isNull(), F.coalesce(near_right, F.lit(False)), "ahead")})
    parts = stored(parts.withColumn("worth", worth).filter("worth").drop("worth", "back", "ahead", "before", "after"), "passage-parts")
    parts = join_same(parts, _equal_ends(rows, parts, reach), _PART, "left")
    nothing = F.array().cast(_EDGE_LIST)
    parts = parts.withColumns({side: F.coalesce(side, nothing) for side in ("side0", "side1")})
    # a part within the words that a part next to it and earlier kept goes on with belongs to that one
    prior = F.lag(F.struct("first", F.array_max(F.transform("side1", lambda w: w["end"])).alias("reach"))).over(ordered)
    after = F.lead(F.struct("first", F.array_min(F.transform("side0", lambda w: w["begin"])).alias("reach"))).over(ordered)
    opened, closed = F.min("begin").over(run), F.max("end").over(run)
    parts = parts.withColumns({
        "to_prior": F.coalesce((prior["first"] < F.col("first")) & (prior["reach"] >= F.col("end")), F.lit(False)),
        "to_next": F.coalesce((after["first"] < F.col("first")) & (after["reach"] <= F.col("begin")), F.lit(False)),
        "side0": F.filter("side0", lambda w: w["begin"] < opened), "side1": F.filter("side1", lambda w: w["end"] > closed)})
    stays = (~F.col("to_prior") & ~F.col("to_next")).cast("int")
    group = F.sum(stays).over(ordered) + F.when(F.col("to_next"), 1).otherwise(0)
    parts = parts.withColumn("group", F.greatest(F.lit(1), F.least(group, F.sum(stays).over(run)))).withColumns({
        "side0": F.max_by("side0", F.size("side0")).over(run), "side1": F.max_by("side1", F.size("side1")).over(run)})
    parts = parts.groupBy("id", "version", "run", "group").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), F.sum("n_words").alias("n_words"),
        F.sum("n_units").alias("n_units"), F.min_by("first", F.struct(F.col("to_prior") | F.col("to_next"), "part")).alias("first"),
        F.first("side0").alias("side0"), F.first("side1").alias("side1"))
    # at its ends a passage goes on, but not into those before and after it
    ordered = run.orderBy("group")
    along = Window.partitionBy("id", "version").orderBy("run", "group")
    none = F.slice("side0", 1, 0)
    parts = parts.withColumns({"next_begin": F.lead("begin").over(ordered), "begin_after": F.lead("begin").over(along),
                               "is_head": F.row_number().over(ordered) == 1})
    parts = parts.withColumn("side1", F.when(F.col("next_begin").isNull(), F.filter(
        "side1", lambda w: F.col("begin_after").isNull() | (w["end"] <= F.col("begin_after")))).otherwise(none))
    parts = parts.withColumn("reached", F.coalesce(F.array_max(F.transform("side1", lambda w: w["end"])), F.col("end")))
    parts = parts.withColumn("taken_before", F.lag("reached").over(along))
    parts = parts.withColumn("side0", F.when(F.col("is_head"), F.filter(
        "side0", lambda w: F.col("taken_before").isNull() | (w["begin"] >= F.col("taken_before")))).otherwise(none))
    parts = parts.withColumns({
        "begin": F.coalesce(F.array_min(F.transform("side0", lambda w: w["begin"])), F.col("begin")),
        "end": F.coalesce("next_begin", "reached"),
        "n_words": F.col("n_words") + F.size("side0") + F.size("side1")})
    return (
        parts.withColumn("all_words", F.sum("n_words").over(run)).filter(F.col("all_words") >= min_words)
        .select(F.col("id").alias(id_col), "version", "begin", "end", "n_words", "n_units",
                F.col("first.id").alias("first_id"), F.col("first.begin").alias("first_begin"))
    )


def remove_passages(docs: DataFrame, passages: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the passages taken out of the text, and ``kept_spans`` of the original text.

    ``kept_spans`` lists (begin, end) in code points, in order; all rows and columns stay.
    """
    spans = passages.groupBy(F.col(id_col).alias("_id"), F.col("version").alias("_version")).agg(
        F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("_cuts"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({"_id": F.col(id_col).cast("long"), "_version": F.xxhash64(text)})
    joined = join_same(keyed, spans, ["_id", "_version"], "left")
    cuts = F.coalesce("_cuts", F.array().cast("array<struct<begin:bigint,end:bigint>>"))
    edges_from = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda c: c["end"]))
    edges_to = F.concat(F.transform(cuts, lambda c: c["begin"]), F.array(F.length(text).cast("long")))
    kept = F.filter(F.zip_with(edges_from, edges_to, lambda a, b: F.struct(a.alias("begin"), b.alias("end"))), lambda s: s["end"] > s["begin"])
    pieces = F.transform("kept_spans", lambda s: F.substring(F.col(text_col), (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int")))
    return (
        joined.withColumn("kept_spans", kept)
        .withColumn(text_col, F.when(F.col("_cuts").isNull(), F.col(text_col)).otherwise(F.array_join(pieces, "")))
        .select(*[F.col(c) for c in docs.columns if c.lower() != "kept_spans"], "kept_spans")
    )
