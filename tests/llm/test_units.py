import random

from pyspark.sql import functions as F

from tripmart.llm.units import _asked_words, remove_passages, repeated_passages


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijk") for _ in range(rng.randint(3, 9))) for _ in range(n))


def test_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(8)
    passages = [prose(rng, 55) for _ in range(30)]
    docs = []
    for k in range(90):
        host = prose(rng, 80).split()
        at = rng.randrange(len(host))
        docs.append((k, " ".join(host[:at]) + rng.choice([" ", "\n", ". "]) + passages[k % 30].upper() + " " + " ".join(host[at:])))
    docs += [(100 + k, "Same short line of some words.\n" + prose(rng, 60) + "\nSame short line of some words.") for k in range(40)]
    df = spark.createDataFrame([(k, t, 0) for k, t in docs], "doc_id long, text string, digest int").repartition(4)
    rows = repeated_passages(df).collect()
    assert {r.doc_id for r in rows} == set(range(30, 90))
    assert all(r.first_id == r.doc_id % 30 for r in rows)
    text = dict(docs)
    for r in rows:
        assert text[r.doc_id][r.begin : r.end].lower() in passages[r.doc_id % 30].lower()
    left = {r.doc_id: r for r in remove_passages(df, repeated_passages(df)).collect()}
    for k, t in docs:
        assert left[k].text == "".join(t[a:b] for a, b in left[k].kept_spans)
        if k < 30 or k >= 100:
            assert left[k].text == t


def test_copies_nulls_repeats_and_empty_table(spark):
    rng = random.Random(9)
    text = "Été! " + prose(rng, 50)
    rows = [(2, text), (1, text), (1, text), (3, None), (4, ""), (None, text + " and more"), (5, "w " * 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.begin, r.end, r.first_id) for r in repeated_passages(df).collect() if r.doc_id != 5)
    assert [(k, f) for k, _, _, f in got] == [(1, None), (2, None)]
    assert all(b == 0 for _, b, _, _ in got)
    assert remove_passages(df, repeated_passages(df)).count() == len(rows)
    assert repeated_passages(df.limit(0)).collect() == []


def test_short_passages_go_whole_and_split_runs_are_not_lost(spark):
    rng = random.Random(12)
    passages = [prose(rng, 51) for _ in range(60)]
    docs = [(k, f"{prose(rng, 40)} {passages[k % 60]} {prose(rng, 40)}") for k in range(120)]
    # a line between that stands earlier elsewhere
    frequent, one, two = "One frequent line here.", prose(rng, 16), prose(rng, 16)
    docs += [(1000 + k, f"{prose(rng, 30)}\n{frequent}\n{prose(rng, 30)}") for k in range(3)]
    docs += [(2000 + k, f"{prose(rng, 30)}\n{one}\n{frequent}\n{two}\n{prose(rng, 30)}") for k in range(2)]
    # words of a short period, at another phase
    docs += [(3000, f"{prose(rng, 30)} {'ping pong pang ' * 40} {prose(rng, 30)}"), (3001, f"{prose(rng, 30)} {'pong pang ping ' * 30} {prose(rng, 30)}")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    passages_found = repeated_passages(df)
    left = {r.doc_id: r.text for r in remove_passages(df, passages_found).collect()}
    text = dict(docs)
    for k in range(60):
        assert left[k] == text[k]
        assert left[60 + k].split() == text[60 + k].replace(passages[k], "").split()
    assert left[2000] == text[2000]
    assert one not in left[2001] and two not in left[2001] and frequent not in left[2001]
    assert left[3000].count("pong") < 30 and left[3001].count("pong") == 0
    assert len(left[3001].split()) == 60


def test_python_steps_on_texts_run_in_tasks_of_their_own(spark):
    """However few rows are asked for: a task with both steps holds two workers."""
    rows = spark.createDataFrame([(1, 7, "é one two\nthree four"), (2, 7, "one"), (None, 8, "Five six seven")],
                                 "id long, version long, text string")
    asked = spark.sql("""SELECT 1L AS id, 7L AS version, array(struct(1L AS unit, 0 AS side, 2 AS most), struct(0L AS unit, 1 AS side, 128 AS most)) AS asked
        UNION ALL SELECT NULL, 8L, array(struct(0L AS unit, 0 AS side, 128 AS most))""")
    words = _asked_words(rows, asked, 4, 0)
    between = words._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[1]
    assert "Exchange" in between and "Broadcast" not in between
    got = {(r.id, r.unit, r.side): [(w.begin, w.end) for w in r.words] for r in words.collect()}
    assert got == {(1, 1, 0): [(6, 9), (2, 5)], (1, 0, 1): [(10, 15), (16, 20)], (None, 0, 0): []}
    skipped = _asked_words(rows, asked, 4, 1).filter(F.col("side") == 1).first()
    assert [(w.begin, w.end) for w in skipped.words] == [(16, 20)]
