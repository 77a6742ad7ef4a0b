import random
import re

from tripmart.llm.lines import delete_runs, repeated_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, min_words, min_lines):
    """{(id, line_no)} in any qualifying run, however long, that occurs earlier; docs are [(id, text)]."""
    first, out = {}, set()
    for k, text in sorted(docs):
        lines = [(n, x.strip(" \t\x0b\x0c\r")) for n, x in enumerate((text or "").split("\n")) if x.strip(" \t\x0b\x0c\r")]
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                run = tuple(x for _, x in lines[i : j + 1])
                if first.setdefault(run, (k, i)) != (k, i) and (len(run) >= min_lines or sum(len(WORD.findall(x)) for x in run) >= min_words):
                    out |= {(k, n) for n, _ in lines[i : j + 1]}
    return out


def corpus(seed):
    rng = random.Random(seed)
    lines = ["a", "b c", "c d e", " d", "", "  ", "é " * 12, "long " * 7, "x y"]
    docs = [(k, "\n".join(rng.choice(lines) for _ in range(rng.choice([0, 1, 4, 12, 30])))) for k in range(25)]
    return docs + [(25, None), (26, ""), (27, "\n\n"), (28, docs[3][1]), (29, "a\n" * 9), (30, "only here")]


def deleted(runs, docs):
    text = dict(docs)
    out = set()
    for r in runs.collect():
        lines = text[r.doc_id].split("\n")
        out |= {(r.doc_id, n) for n in range(r.first_line, r.last_line + 1) if lines[n].strip()}
    return out


def test_runs_equal_brute_force(spark):
    for seed, min_words, min_lines in ((1, 10, 3), (2, 7, 2), (3, 1000, 5), (4, 5, 1)):
        docs = corpus(seed)
        df = spark.createDataFrame([(k, t, "r") for k, t in docs], "doc_id long, text string, rank string").repartition(3)
        runs = repeated_runs(df, min_words=min_words, min_lines=min_lines)
        assert deleted(runs, docs) == brute(docs, min_words, min_lines)


def test_later_copies_go_and_the_rest_stays(spark):
    run = "one two three\nfour five\nsix"
    docs = [(1, f"x\n{run}\ny"), (2, f"{run}\n\nz"), (3, "clean\ntext"), (4, None), (None, "q")]
    df = spark.createDataFrame([(k, t, k) for k, t in docs], "doc_id long, text string, version long")
    got = {r.doc_id: (r.text, r.version) for r in delete_runs(df, repeated_runs(df)).collect()}
    assert got == {1: (docs[0][1], 1), 2: ("\nz", 2), 3: ("clean\ntext", 3), 4: (None, 4), None: ("q", None)}


def test_repeated_rows_are_one_document_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a\nb\nc")] * 2, "doc_id long, text string")
    assert repeated_runs(df).collect() == []
    assert delete_runs(df, repeated_runs(df)).count() == 2
    assert repeated_runs(df.limit(0)).collect() == []


def test_runs_of_every_length_go_whole(spark):
    long, tail = "word " * 60, "five words at the end"
    mixed = random.Random(5)
    for docs, min_words, min_lines in (
        ([(1, f"{long}\n{tail}\nx"), (2, f"{long}\n{tail}\ny")], 50, 3),
        ([(1, f"{long}\na\nb\nc\nx"), (2, f"p\n{long}\na\nb\ny"), (3, f"{long}\na\nb\nc")], 50, 3),
        (corpus(1), 10, 3), (corpus(2), 7, 2), (corpus(4), 5, 1), (corpus(5), 20, 6),
        ([(k, "\n".join(mixed.choice("abc") * 3 + " v" * mixed.choice([0, 0, 1, 4]) for _ in range(12))) for k in range(40)], 5, 4),
    ):
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        assert deleted(repeated_runs(df, min_words=min_words, min_lines=min_lines), docs) == brute(docs, min_words, min_lines)
