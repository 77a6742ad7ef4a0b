import random
from collections import Counter, defaultdict

from tripmart.llm.mixing import mix_sources, sainte_lague


def documents(seed=3, n=400):
    rng = random.Random(seed)
    rows = [(k, " \t\n".join(["w"] * rng.choice([0, 1, 5, 80, 700])), rng.choice(["b", "a", "é", "a", "a", None])) for k in range(n)]
    return rows + [(n, None, "a"), (n + 1, "", "zero"), (None, "x y", "b"), (3, rows[3][1], rows[3][2])]


def levels(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, left = set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        rest = left - sum(most * sizes[s] for s in full)
        unit = rest / sum(weight[s] for s in open_)
        above = {s for s in open_ if unit * weight[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else unit * weight[s] for s in names}
        full |= above


def test_targets_and_amounts(spark):
    rows = documents()
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, size int").repartition(4)
    got = mix_sources(df, shard_words=5000, block_words=16).collect()
    size, taken = Counter(), Counter()
    for r in got:
        size[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    assert len(got) == len(rows) and sum(size.values()) == sum(len((t or "").split()) for _, t, _ in rows)
    want = levels(size)
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6
    shards = sum(size.values()) // 5000 + 1
    for s in size:
        assert abs(taken[s] - want[s]) <= 16 * shards
    again = mix_sources(df.repartition(7), shard_words=5000, block_words=16).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_seats_go_by_the_highest_quotients(spark):
    rng = random.Random(7)
    cells = [(g, k, rng.choice([0, 1, 5, 5, 60, 900]), 37 if g == "x" else 3) for g in "xy" for k in range(9)]
    df = spark.createDataFrame(cells, "g string, k int, votes int, seats int")
    got = {(r.g, r.k): r.quota for r in sainte_lague(df, ["g"], ["g", "k"], "votes", "seats").collect()}
    want = defaultdict(int)
    for g in "xy":
        own = {k: v for c, k, v, _ in cells if c == g}
        for _ in range(37 if g == "x" else 3):
            k = max(own, key=lambda k: (own[k] / (2 * want[g, k] + 1), -k))
            want[g, k] += 1
    assert {k: q for k, q in got.items() if q} == {c: q for c, q in want.items() if q}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_sources(df).collect() == []
    assert [r.taken for r in mix_sources(df.union(spark.createDataFrame([(1, None, "a")], df.schema))).collect()] == [0]


def test_carried_columns(spark):
    df = spark.createDataFrame([(1, "a b", "s", "en")], "doc_id long, text string, source string, target string")
    assert [(r.text, r.taken) for r in mix_sources(df, carry=["text"], block_words=1).collect()] == [("a b", 3)]


def test_sources_meet_their_targets_however_many_shards(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(["w"] * rng.randint(5, 15)), "rare") for k in range(300)]
    rows += [(1000 + k, " ".join(["w"] * 500), "big") for k in range(200)] + [(k, " ".join(["w"] * rng.randint(1, 150)), "some") for k in range(2000, 2200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    for shard_words in (1 << 17, 1000, 100, 10):
        got = mix_sources(df, weights=(1, 3, 1), shard_words=shard_words).collect()
        assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
        for source in ("rare", "big", "some"):
            of = [r for r in got if r.source == source]
            assert abs(sum(r.taken for r in of) - of[0].target) <= 3 * 64, (shard_words, source)
