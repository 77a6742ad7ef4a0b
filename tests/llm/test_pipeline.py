import random
from pathlib import Path

import brute
import pytest
import test_lines
import test_quality
import test_similar

import corpus_pipeline


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    benchmark = [(k, line(30)) for k in range(4)]
    shared = line(60)
    docs = []
    for k in range(70):
        text = [line(rng.randint(8, 40)) for _ in range(rng.randint(2, 6))]
        if k % 9 == 1:
            text.insert(1, shared)
        if k % 13 == 2:
            text[0] = text[0][:20] + " " + benchmark[k % 4][1]
        docs.append("\n".join(text))
    for k in range(0, 30, 3):
        words = docs[k].split(" ")
        words[rng.randrange(len(words))] = word()
        docs.append(" ".join(words))
    docs += [docs[5], docs[6] + "\n", None, "", "short one", "w*** x### y$$$ z%%% " * 20, "LOUD!! " * 60]
    rng.shuffle(docs)
    rows = [(k, t, "en", f"src{k % 3}" if k % 11 else None, len(t or "")) for k, t in enumerate(docs)]
    return rows, benchmark


def test_stages_and_their_effects(spark, tmp_path, corpus):
    rows, benchmark = corpus
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    kept = {k: t for k, t, *_ in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        got = {r.doc_id: r.text for r in docs.collect()}
        before, kept = kept, got
        assert set(got) <= set(before)
        if name == "quality_rules":
            gone = set(before) - set(got)
            assert {k for k, t in before.items() if test_quality.brute(t)[-1]} <= gone
            assert all(test_quality.brute(before[k])[-1] or "***" in before[k] for k in gone)
            assert got == {k: before[k] for k in got}
        elif name == "line_dedup":
            cut = test_lines.brute(sorted(before.items()), 50, 3)
            want = {k: "\n".join(x for n, x in enumerate(t.split("\n")) if (k, n) not in cut) for k, t in before.items()}
            assert {k: t.strip() for k, t in want.items() if t.strip()} == {k: t.strip() for k, t in got.items()}
        elif name == "jaccard_join":
            classes = test_similar.expected(sorted(before.items()))
            assert set(got) == {c for c, _ in classes.values()}
        elif name == "decontamination":
            assert set(got) == {k for k, t in before.items() if not brute.overlap(t, benchmark)[1]}
    mix = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(mix) == set(kept)
    assert all(0 <= r.taken <= 2 * r.size == 2 * len(test_quality.WORD.findall(kept[k])) for k, r in mix.items())
    for source in {r.source for r in mix.values()}:
        of = [r for r in mix.values() if r.source == source]
        assert abs(sum(r.taken for r in of) - of[0].target) <= 64


def test_pipeline_stands_at_the_top():
    assert (Path(corpus_pipeline.__file__).parent / "__spark_entry__.py").exists()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "decontamination", "source_mix"]


def test_clean_documents_with_the_id_of_a_contaminated_one_stay(spark, tmp_path):
    item = "a b c d e f g h i j k l"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(1, f"x {item}"), (1, "clean"), (None, f"{item} y"), (None, "clean too"), (None, None), (2, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, left), key=repr) == sorted((r for r in rows if item not in (r[1] or "")), key=repr)


HELPERS = (
    "id version row spans _spans _id _version version_of_text n_words kept base_failed p_good word_chars n_symbols n_dup_lines"
    " n_repeat_words n_lines n_ended n_upper n_distinct _carried _text _code _vote_0 _rank first class_id n_links n_hit items source_size"
    " size place carried taken target shard start amount n_whole n_part seq line_no words rank k key a b x.y"
).split()


@pytest.mark.parametrize("empty", [False, True])
def test_stages_keep_columns_of_any_name(spark, tmp_path, corpus, empty):
    rows, benchmark = corpus
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    more = [(*r, *[f"{h}-{r[0]}" for h in HELPERS]) for r in rows]
    more += [(None, t, None, None, None, *HELPERS) for t in (None, rows[0][1])]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    schema = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{h}` string" for h in HELPERS)
    docs = spark.createDataFrame([] if empty else more, schema)
    plain = docs.select(*names)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        wide, narrow = stage(spark, docs, str(tmp_path)), stage(spark, plain, str(tmp_path))
        assert wide.schema == docs.schema or [f.dataType for f in wide.schema] == [f.dataType for f in docs.schema]
        assert wide.columns == docs.columns
        wide.write.parquet(str(tmp_path / f"wide{number}"))
        docs = spark.read.parquet(str(tmp_path / f"wide{number}"))
        got = docs.collect()
        assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == sorted(map(tuple, narrow.collect()), key=repr), name
        assert all(r[h] in (f"{h}-{r.doc_id}", h) for r in got for h in HELPERS)
        assert bool(got) != empty
        plain = docs.select(*names)
    mixed = corpus_pipeline.source_mix(spark, docs, str(tmp_path)).collect()
    assert len(mixed) == docs.count() and all(r.taken == r.n_whole * r.size + r.n_part for r in mixed)
