import random
import re
from collections import Counter

from tripmart.llm.quality import RULES, fit_votes, judge_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + d for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for d in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered), failed)


def texts():
    rng = random.Random(2)
    parts = ["a", "b", "é😀", "c", "\n", "\n", "  ", "\t", "*", "##", "<|>", " x", "d ", "\x0b", "\x85", " "]
    out = ["", None, " \n\t", "a b c d e a b c d e", "a a a a a a", "a a a a a", "l\nl\n\nl \nl", "x" * 3000, "w " * 6000]
    return out + ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.choice([8, 40, 200]))) for _ in range(150)]


def test_measures_equal_brute_force(spark):
    rows = [(k, t, "x") for k, t in enumerate(texts() * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string").repartition(3)
    got = judge_quality(df).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(rows[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.kept and r.base_failed)


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(4)
    prose = [" ".join(rng.choice("the of and river stone light under moving water house old".split()) + rng.choice("abcdefgh") for _ in range(60)) + "." for _ in range(80)]
    symbols = [" ".join(w + "***" for w in p.split()) for p in prose[:12]]
    shouted = [p.upper() + "!!" for p in prose[12:20]]
    rows = [(k, t) for k, t in enumerate(prose + symbols + shouted)]
    got = {r.doc_id: r.kept for r in judge_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k] for k in range(len(prose)))
    assert not any(got[k] for k in range(len(prose), len(prose) + len(symbols)))


def test_model_recovers_rates():
    rng = random.Random(6)
    right = (0.9, 0.7, 0.8)
    counts = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.7
        counts[tuple((1 if (rng.random() < r) == good else -1) if rng.random() < 0.8 else 0 for r in right)] += 1
    model = fit_votes(counts)
    assert abs(model.good - 0.7) < 0.05
    assert all(abs(model.accuracy(j) - r) < 0.05 for j, r in enumerate(right))


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, text string")
    assert judge_quality(df.limit(0)).collect() == []
    assert sorted((r.doc_id, r.kept) for r in judge_quality(df).filter("doc_id = 1").collect()) == [(1, False)] * 2
    assert judge_quality(df, rules=RULES[:1]).count() == 3
