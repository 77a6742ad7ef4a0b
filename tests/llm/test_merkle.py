import hashlib
import random
import zlib

import pytest

from tripmart.llm.merkle import Frontier, manifest, tampered_documents

DDL = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves):
    """Root, and per leaf the siblings with their side and the levels hashed alone."""
    level, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for path, i in zip(paths, at, strict=True):
            other = i ^ 1
            path.append(None if other >= len(level) else (other < i, level[other]))
        level = [h(*level[k : k + 2]) for k in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def fold(node, path):
    for step in path:
        node = h(node) if step is None else h(step[1], node) if step[0] else h(node, step[1])
    return node


def brute(rows):
    """{row number: (doc_id, leaf, subroot, root, proof, folded root, verified)}; leaves must differ."""
    groups = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    roots, paths = {}, {}
    for g in groups:
        own = sorted((k for k, r in enumerate(rows) if r[2] == g), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaf(rows[k])))
        roots[g], found = tree([leaf(rows[k]) for k in own])
        paths.update(zip(own, found, strict=True))
    root, tops = tree([roots[g] for g in groups])
    out = []
    for k, r in enumerate(rows):
        path = paths[k] + tops[groups.index(r[2])]
        hit = zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[0] is not None and r[3] is not None
        got = fold(leaf((*r[:3], r[3] + 1, r[4]) if hit else r), path)
        out.append((r[0], leaf(r), roots[r[2]], root, h(*[s[1] for s in path if s]), got, got == root))
    return sorted(out, key=repr)


def documents(seed, counts):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["a", "é", None]), g, rng.choice([None, 3, 50]), rng.choice([None, "", "x" * 9, "ß\n"]))
            for k, g in enumerate([g for g, n in counts.items() for _ in range(n)])]
    rng.shuffle(rows)
    return rows


MANY = {"a": 37, "b": 16, "é": 17, "": 1, None: 2}


@pytest.mark.parametrize(("counts", "levels"), [({"en": 1}, 12), ({"en": 4, None: 5}, 1), (MANY, 2), (MANY, 12), ({"x": 70}, 3)])
def test_manifest_equals_brute_force(spark, counts, levels):
    rows = documents(levels, counts)
    rows += [(None, "s", rows[0][2], 7, "no id"), (None, "s", rows[0][2], 8, "no id"), (rows[0][0], "again", rows[0][2], 1, "same id")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], DDL + ", tree int, witness string").repartition(3)
    got = tampered_documents(df, levels).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert any(not r.verified for r in got) or len(rows) < 10


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "s", "en", 2, "t")] * 3, DDL)
    got = tampered_documents(df).collect()
    one = leaf((1, "s", "en", 2, "t"))
    root = h(h(one, one), h(one))
    assert {(r.leaf, r.subroot, r.root) for r in got} == {(one, root, root)} and len(got) == 3
    assert tampered_documents(df.limit(0)).collect() == []


def test_one_document_has_an_empty_proof(spark):
    row = (4, "s", "en", 2, "t" * 300_000)
    got = tampered_documents(spark.createDataFrame([row], DDL)).first()
    assert (got.leaf, got.root, got.proof_sha256) == (leaf(row), leaf(row), h())


def test_appending_after_a_restart_gives_the_same_tree():
    leaves = [h(str(k)) for k in range(53)]
    whole = Frontier()
    for x in leaves:
        whole.append(x)
    for cut in (0, 1, 8, 31, 52):
        first = Frontier()
        for x in leaves[:cut]:
            first.append(x)
        later = Frontier(first.state())
        for x in leaves[cut:]:
            later.append(x)
        assert later.state() == whole.state()
        assert later.close() == tree(leaves)[0]
    assert whole.close() == tree(leaves)[0]


def test_any_fields_and_groups(spark):
    df = spark.createDataFrame([("b", 1, "k"), ("a", 2, "k")], "name string, v int, g string")
    got = {r.v: r for r in manifest(df, fields=["name"], group_col="g", order_col="name", carry=["v"]).collect()}
    a, b = leaf(("a",)), leaf(("b",))
    assert got[1].witness == ["<" + a] and got[2].witness == [">" + b] and got[1].root == h(a, b)
    assert got[1].other_leaf is None
