import random

import brute
import numpy as np

from tripmart.llm.decontaminate import benchmark_overlap, with_digest, winnow
from tripmart.llm.words import Words


def test_words_equal_the_pattern():
    texts = ["Ab-c D9 é漢x\x7fy", "", None, "_a_ B", "ß" * 3 + "!", "tail"]
    w = Words(texts)
    got = [[w.join(i, i + 1) for i in range(f, f + n)] for f, n in zip(w.first, w.counts, strict=True)]
    assert got == [brute.words(t) for t in texts]
    assert len(set(Words(["same same"]).keys.tolist())) == 1


def test_every_shared_span_shares_a_fingerprint():
    rng = random.Random(3)
    for _ in range(50):
        span = " ".join(rng.choice("abc") for _ in range(10))
        a, b = (Words([" ".join(rng.choice("abcdef") for _ in range(30)) + f" {span} " + "x y z"]) for _ in "ab")
        assert np.intersect1d(winnow(a, 5, 6)[1], winnow(b, 5, 6)[1]).size


def test_overlap_equals_brute_force(spark):
    rng = random.Random(5)
    word = lambda n: " ".join(rng.choice(["a", "b", "C", "é", "1"]) for _ in range(n))
    items = [(k, word(rng.choice([0, 1, 4, 5, 5, 9, 10, 14, 25]))) for k in range(9)]
    items += [(9, None), (10, ""), (10, word(12)), (1, items[1][1])]
    items = [(k, t) for k, t in items if not t or len(t.split()) not in (1,)]
    docs = [(k, word(rng.choice([0, 3, 10, 40, 300]))) for k in range(40)] + [(40, None), (41, ""), (0, "a b c d e")]
    docs += [(100 + k, f"{word(7)}. {t}, {word(9)} {t}") for k, t in items if t]
    d = spark.createDataFrame([(k, t, "z") for k, t in docs], "doc_id long, text string, spans string").repartition(3)
    i = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, n int")
    got = benchmark_overlap(d, i).collect()
    want = sorted((k, *brute.overlap(t, items)) for k, t in docs)
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got) == want


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [(r.n_hit, r["items"]) for r in benchmark_overlap(d, i.limit(0)).collect()] == [(0, []), (0, [])]
    assert benchmark_overlap(d.limit(0), i).collect() == []
    assert with_digest(benchmark_overlap(d, i)).filter("contaminated").count() == 1
