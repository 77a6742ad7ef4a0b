import hashlib
import math
import random
import struct
from collections import Counter

import xxhash
from brute import words

from pyspark.sql import functions as F

from tripmart.llm.fingerprints import as_string, compared_with_edits, lexicon, likeness, term_hashes, text_fingerprints

BAND = (0.4, 3.0)


def chain(seed, *parts):
    for p in parts:
        seed = xxhash.xxh64_intdigest(p, seed)
    return seed


def long(x):
    return struct.pack("<Q", x % (1 << 64))


def term(word):
    return chain(42, struct.pack("<i", 0), word.encode())


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def terms(text):
    return {term(w) for w in words(text)}


def known_terms(texts, band=BAND):
    df = Counter(t for text in texts for t in terms(text))
    return {t: n for t, n in df.items() if (t >> 5) & 3 == 0 and band[0] <= math.log(len(texts) / n) <= band[1]}


def entries(text, known):
    found = terms(text)
    out = {}
    for k, zero in enumerate((0, 3 << 7, 15 << 7)):
        for j in range(32):
            own = sorted((signed(t) for t in found if t in known and t & 31 == j and t & zero == 0))
            if own:
                out[32 * k + j] = chain(42, long(32 * k + j), *map(long, own)) & 0xFFFFFF
    if not out and found:
        out[127] = chain(42, *[long(t) for t in sorted(map(signed, found))]) & 0xFFFFFF
    return [n << 24 | x for n, x in sorted(out.items())]


def near(a, b):
    places = {x >> 24 for x in a} | {x >> 24 for x in b}
    return len(set(a) & set(b)) / len(places) if places else 1.0


def documents(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = [(3 * k, " ".join(rng.choice(vocabulary[: rng.choice([40, 400])]) for _ in range(rng.choice([0, 1, 5, 60, 300])))) for k in range(n)]
    rows += [(1000, None), (1001, ""), (1002, "... !"), (1003, rows[4][1]), (1004, "Éa ß́ 𝒳𝒳 W1 w1"), (None, "null id w3 w4"), (4, rows[5][1])]
    return rows + [(4, "tie w9"), (1005, "w1 " * 100_000 + "w7")]


def test_fingerprints_and_edits_equal_brute_force(spark):
    rows = documents()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, id int, version string").repartition(3)
    known = known_terms([t or "" for _, t in rows])
    assert {(r.term % (1 << 64)): r.df for r in lexicon(df, idf=BAND).collect()} == known
    own = {(r.doc_id, tuple(r.entries)) for r in text_fingerprints(df, idf=BAND).collect()}
    assert own == {(k, tuple(entries(t or "", known))) for k, t in rows}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(chain(42, (r[1] or "").encode()))))
    want = []
    for k, (doc, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = entries(text, known), entries(edited, known), entries(following, known)
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, near(a, b), near(a, c)))
    got = compared_with_edits(df, idf=BAND).select(
        "doc_id", "n_chars", "edited_sha256", "entries", "edited_entries", "near_edited", "near_next").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_repeated_rows_are_one_document_each_gets_a_row(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "d e f")], "doc_id long, text string")
    got = sorted((r.doc_id, r.edited_sha256) for r in compared_with_edits(df, idf=(0, 9)).collect())
    assert [k for k, _ in got] == [1, 1, 2] and got[0] == got[1]
    assert got[0][1] == hashlib.sha256(b"a bd ").hexdigest() and got[2][1] == hashlib.sha256(b"d ea ").hexdigest()


def test_one_document_and_empty_table(spark):
    df = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    row = compared_with_edits(df).first()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
    assert compared_with_edits(df.limit(0)).collect() == [] and text_fingerprints(df.limit(0)).collect() == []


def test_likeness_falls_with_the_share_of_changed_terms(spark):
    rng = random.Random(3)
    base = [f"t{k}" for k in range(300)]
    texts = [" ".join(base)] + [" ".join(base[: 300 - n] + [f"u{n}-{k}" for k in range(n)]) for n in (0, 3, 30, 150, 300)]
    filler = [" ".join(rng.choice(base) for _ in range(3)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts + filler)), "doc_id long, text string")
    found = text_fingerprints(df, idf=(0.5, 9)).filter("doc_id < 6").withColumn("s", as_string(F.col("entries")))
    first = found.filter("doc_id = 0").select(F.col("entries").alias("a"), F.lit(1).alias("one"))
    got = {r.doc_id: r.x for r in found.withColumn("one", F.lit(1)).join(first, "one").select("doc_id", likeness(F.col("a"), F.col("entries")).alias("x")).collect()}
    assert got[0] == got[1] == 1.0 and got[1] > got[2] > got[3] > got[4] > got[5] == 0
    assert len({r.s for r in found.filter("doc_id < 2").collect()}) == 1


def test_words_are_split_off_not_extracted(spark):
    """Extracting each word took most of the query's time; empty words at a text's ends are none."""
    texts = ["", " ", "--a", "A b\nB.", "\u00c9t\u00e9 \u212a\U0001f600x!", "\u0000x\u007f", "a-b-a ", "\u00a0c\u2003d"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", term_hashes(F.col("text")).alias("h"))
    for r in df.collect():
        assert {x % (1 << 64) for x in r.h} == terms(r.text) and len(r.h) == len(terms(r.text))
    assert "regexp_extract_all" not in df._jdf.queryExecution().executedPlan().toString()
