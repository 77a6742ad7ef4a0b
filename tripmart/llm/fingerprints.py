"""Document fingerprints by I-Match over randomised lexicon subsets. Built-in functions only.

The lexicon holds the terms whose inverse document frequency lies in a band. Subsets of it are drawn by
bits of a seeded hash of the term, ``_GROUPS`` of them in each of several sizes, a smaller one lying in
the larger one of its group. A text's terms in a subset are sorted and hashed, and the fingerprint lists
the hashes of the subsets that hold any of its terms. Terms in no subset need neither a frequency nor a
lookup, so three quarters of all terms never leave the task that found them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import join_same, numbered, stored

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GROUPS = 32  # subsets of each size, told apart by the hash's lowest five bits
_DRAWN = 0b11 << 5  # bits that are 0 in the hash of every drawn term
_SIZES = (0, 0b11 << 7, 0b1111 << 7)  # further bits that are 0: one term in 128, 512, 2048
_HASH_BITS = 24
_WHOLE = 127  # number of the entry that stands for all terms
_KEYS = ["id", "version"]


def term_hashes(text: Column, seed: int = 0) -> Column:
    """Distinct seeded hashes of a text's words; A-Z are lower-cased.

    Texts are split at what lies between words, a third of the work of extracting each word; that
    leaves an empty word where a text begins or ends with such characters.
    """
    words = F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _BETWEEN), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(F.lit(seed), w)))


def drawn(hashes: Column) -> Column:
    """Terms that are in any subset."""
    return F.filter(hashes, lambda t: t.bitwiseAND(F.lit(_DRAWN)) == 0)


def lexicon(
    docs: DataFrame, *, text_col: str = "text", idf: tuple[float, float] = (2.3, 9.2), seed: int = 0
) -> DataFrame:
    """(term, df): drawn terms with idf = ln(documents / df) in the band, counted over all documents.

    A document has on average m distinct terms, and frequencies sum to m times the documents, so at
    most m * e**idf[1] terms are in the band, however many documents there are: 10 000 m with the
    usual band, of which a quarter are drawn. Null and empty texts count as documents without terms.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    terms = docs.select(F.explode(drawn(term_hashes(text, seed))).alias("term"))
    total = docs.select(F.lit(1)).count()
    value = F.log(F.lit(float(max(1, total))) / F.col("df"))
    counted = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return stored(counted.filter((value >= idf[0]) & (value <= idf[1])), "lexicon")


def subset_hashes(terms: Column) -> Column:
    """One whole number for each subset with any of the terms: its number, then 24 bits of hash."""
    masks = [_GROUPS - 1 | size for size in _SIZES]
    mask_of = F.array(*[F.lit(m).cast("long") for m in masks])
    group = lambda t: t.bitwiseAND(F.lit(_GROUPS - 1))
    numbers = F.array_distinct(F.flatten(F.transform(terms, lambda t: F.filter(
        F.array(*[F.when(t.bitwiseAND(F.lit(size)) == 0, group(t) + _GROUPS * k) for k, size in enumerate(_SIZES)]),
        lambda n: n.isNotNull()))))

    def signed(n: Column) -> Column:
        mask = F.get(mask_of, (n / _GROUPS).cast("int"))
        own = F.sort_array(F.filter(terms, lambda t: t.bitwiseAND(mask) == group(n)))
        return _entry(n, F.xxhash64(n, own))

    return F.sort_array(F.transform(numbers, signed))


def _entry(number: Column, key: Column) -> Column:
    bits = key.bitwiseAND(F.lit((1 << _HASH_BITS) - 1))
    return (number.cast("long") * (1 << _HASH_BITS) + bits).cast("int")


def likeness(a: Column, b: Column) -> Column:
    """Of the subsets that hold terms of either text, the share with equal hashes; 1.0 for two empty ones."""
    number = lambda x: F.transform(x, lambda v: F.shiftright(v, _HASH_BITS))
    either = F.size(F.array_union(number(a), number(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def as_string(entries: Column) -> Column:
    """Eight hex digits for each entry, in order."""
    return F.concat_ws("", F.transform(entries, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")))


def signed_texts(
    rows: DataFrame, known: DataFrame, *, seed: int = 0, carry: Sequence[str] = (), broadcast_rows: int = 4_000_000
) -> DataFrame:
    """(id, version, entries, *carry) of rows (id, version, text, *carry): their fingerprints.

    The lexicon goes to every executor if it has at most ``broadcast_rows`` terms (64 MB), else terms are
    joined by shuffling. A text without any term of the lexicon gets one entry with the hash of all its
    terms, one without terms gets none. Rows with the same (id, version) must be equal.
    """
    nothing = F.lit(0).cast("long")  # keeps texts without terms
    listed = rows.select(*_KEYS, *carry, term_hashes(F.col("text"), seed).alias("terms"))
    # before the terms are spread, else it is worked out for each of them
    listed = listed.select(
        *_KEYS, *carry, F.when(F.size("terms") > 0, F.xxhash64(F.sort_array("terms"))).alias("whole"),
        F.concat(drawn(F.col("terms")), F.array(nothing)).alias("terms"),
    )
    spread = listed.select(*_KEYS, *carry, "whole", F.explode("terms").alias("term"))
    wanted = known.select("term").unionByName(rows.sparkSession.range(1).select(nothing.alias("term")))
    if known.count() <= broadcast_rows:
        wanted = F.broadcast(wanted)
    found = spread.join(wanted, "term").groupBy(*_KEYS).agg(
        F.array_remove(F.collect_set("term"), 0).alias("terms"),
        *[F.first(c).alias(c) for c in ["whole", *carry]],
    )
    subsets = found.select(*_KEYS, subset_hashes(F.col("terms")).alias("subsets"), "whole", *carry)
    whole = F.array(_entry(F.lit(_WHOLE), F.col("whole")))
    entries = F.when((F.size("subsets") == 0) & F.col("whole").isNotNull(), whole).otherwise(F.col("subsets"))
    return subsets.select(*_KEYS, entries.alias("entries"), *carry)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))


def text_fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", idf: tuple[float, float] = (2.3, 9.2), seed: int = 0
) -> DataFrame:
    """(id, version, entries): the fingerprint of every text; ``version`` is a hash of the text.

    Equal texts have equal fingerprints. Null is the empty text. Rows equal in id and text give one row.
    Other columns are not read; an empty table gives no rows.
    """
    known = lexicon(docs, text_col=text_col, idf=idf, seed=seed)
    return signed_texts(_rows(docs, id_col, text_col), known, seed=seed).withColumnRenamed("id", id_col)


def compared_with_edits(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", idf: tuple[float, float] = (2.3, 9.2), seed: int = 0
) -> DataFrame:
    """Every document next to an edited version of it and to the next document.

    The edited text is the document with its last floor(n_chars / 2) code points replaced by the first as
    many (or all) of the next one. Documents follow each other by id, null first, then by a hash of their
    text; after the last comes the first. Rows equal in id and text are one document and get equal rows.
    Returns per row: id, ``n_chars``, ``edited_sha256``, ``entries``, ``edited_entries``, ``near_edited``,
    ``near_next``. Null is the empty text; an empty table gives no rows; other columns are not read.
    """
    rows = _rows(docs, id_col, text_col)
    known = lexicon(docs, text_col=text_col, idf=idf, seed=seed)
    narrow = rows.select(*_KEYS, F.length("text").cast("long").alias("n_chars"))
    single = narrow.groupBy(*_KEYS).agg(F.first("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    ranked = stored(numbered(single, [F.asc_nulls_first("id"), F.asc("version")], "rank"), "ranked-docs")
    total, repeated = ranked.agg(F.count(F.lit(1)), F.max("copies")).first()
    following = ranked.select(
        F.col("id").alias("next_id"), F.col("version").alias("next_version"),
        ((F.col("rank") + max(1, total) - 1) % max(1, total)).alias("rank"))
    pairs = stored(ranked.join(following, "rank").drop("rank"), "next-docs")
    half = F.expr("n_chars div 2")
    own = join_same(rows, pairs.select(*_KEYS, "n_chars"), _KEYS).select(
        *_KEYS, F.expr("left(text, int(n_chars - n_chars div 2))").alias("head"))
    asked = pairs.select(
        F.col("next_id").alias("id"), F.col("next_version").alias("version"),
        F.struct("id", "version").alias("of"), half.cast("int").alias("room"))
    tail = join_same(rows, asked, _KEYS).select("of.*", F.expr("left(text, room)").alias("tail"))
    if (repeated or 0) > 1:
        own, tail = own.dropDuplicates(_KEYS), tail.dropDuplicates(_KEYS)
    edited = join_same(own, tail, _KEYS).select(*_KEYS, F.concat("head", "tail").alias("text"))
    edited = edited.withColumn("edited_sha256", F.sha2("text", 256))
    changed = signed_texts(edited, known, seed=seed, carry=["edited_sha256"]).withColumnRenamed("entries", "edited_entries")
    prints = stored(signed_texts(rows, known, seed=seed), "fingerprints")
    others = prints.select(*[F.col(c).alias(f"next_{c}") for c in prints.columns])
    both = join_same(join_same(join_same(pairs, prints, _KEYS), changed, _KEYS), others, ["next_id", "next_version"])
    found = both.select(
        *_KEYS, "copies", "n_chars", "edited_sha256", "entries", "edited_entries",
        likeness(F.col("entries"), F.col("edited_entries")).alias("near_edited"),
        likeness(F.col("entries"), F.col("next_entries")).alias("near_next"))
    if (repeated or 0) > 1:
        found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copy")
    return found.drop("copies", "version").withColumnRenamed("id", id_col)
