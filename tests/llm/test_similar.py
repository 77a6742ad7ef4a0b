import random

import brute
import pytest

from tripmart.llm.similar import connected, runs_for, similar_texts


def grams(text, k):
    w = brute.words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def expected(docs, k=5, similarity=0.8):
    """{id: (class, links)}; docs have distinct ids."""
    sets = {d: grams(t, k) for d, t in docs}
    ids = sorted(sets)
    head = {d: d for d in ids}
    links = dict.fromkeys(ids, 0)

    def find(d):
        while head[d] != d:
            d = head[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both >= similarity * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                    links[a] += 1
                    links[b] += 1
                    x, y = find(a), find(b)
                    head[max(x, y)] = min(x, y)
    return {d: (find(d), links[d]) for d in ids}


def corpus(seed, groups, size):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    common = " ".join(word() for _ in range(9))
    docs = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([60, 150, 400]))]
        for _ in range(size):
            text = base[:]
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                text[rng.randrange(len(text))] = word()
            docs.append(common + ".\n" + " ".join(text).capitalize())
    docs += [None, "", " .", "one two", "One, two!", "one two three four five", "ONE two three four five"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("few,block", [(64, 512), (4, 5)])
def test_links_and_classes_equal_brute_force(spark, few, block):
    docs = corpus(11, 40, 5) + [(1000 + k, t) for k, t in corpus(12, 1, 60)]
    df = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id long, text string, class_id string").repartition(5)
    got = {r.doc_id: (r.class_id, r.n_links) for r in similar_texts(df, few=few, block=block, recall=0.9999).collect()}
    assert got == expected(docs)


def test_one_row_of_each_class_stays(spark):
    docs = corpus(13, 10, 4)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = similar_texts(df).collect()
    kept = {r.doc_id for r in rows if r["first"]}
    alone = {d for d, t in docs if not grams(t, 5)}
    assert kept == {r.class_id for r in rows} | alone


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c!"), (2, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in similar_texts(df).collect()), key=repr)
    assert got == [(1, None, 2), (1, None, 2), (2, 2, 0), (None, None, 2)]
    assert similar_texts(df.limit(0)).collect() == []


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (103, 102), (101, 103)]
    got = dict(map(tuple, connected(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**dict.fromkeys(range(1, 61), 0), **dict.fromkeys((101, 102, 103), 100)}


def test_runs():
    assert runs_for(0.9, 0.8) == 1 and runs_for(0.999, 0.8) == 3
