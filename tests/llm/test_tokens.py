import public_tokenizers
import pytest

from tripmart.llm.tokens import character_classes, load_tokenizer, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = [
    "", None, " ", "  ", "\n", " \n ", "a", "don't  stop", "'s'tx ''ll we've\n'll I'M", "'", " '", " 's",
    "x<|endoftext|>'s y", "<|endoftext|>", "<|endoftext|><|endoftext|> ", " <|endoftext|> a", "<|endoftext",
    "tab\t\tx  y z  w　", "naïve Ünïcödé 漢字かな 한국어 १२३ ²½Ⅷ", "😀😀 👩‍👩‍👧 ​‍", "áë",
    "word " * 3000, "é" * 5000, " " * 4000 + "x", "\x1c\x1f\x00\x85x", "it's 1999's 'tis", "end  ", "'re", "a're b'res",
    "1'll2've 3'd", "￾￿", "x" * 70_000,
]


def library(texts):
    found = load_tokenizer(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [len(x.ids) for x in found]


@pytest.mark.parametrize("chunk,block", [(2_000_000, 400_000), (50, 3)])
def test_counts_equal_the_library(spark, chunk, block):
    texts = TEXTS * 2
    df = spark.createDataFrame(
        [(k, t, 7) for k, t in enumerate(texts)], "doc_id long, text string, n_tokens int"
    ).repartition(3)
    got = token_counts(df, PATH, chunk_chars=chunk, block_pieces=block).collect()
    want = {
        k: (len((t or "").encode()), n) for k, (t, n) in enumerate(zip(texts, library(texts), strict=True))
    }
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want and len(got) == len(want)


def test_repeated_and_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert sorted(map(tuple, token_counts(df, PATH).collect()), key=repr) == [(1, 3, 2), (1, 3, 2), (None, 1, 1)]
    assert token_counts(df.limit(0), PATH).collect() == []


def test_classes_of_plain_characters():
    classes = character_classes(PATH)
    assert [int(classes[ord(c)]) for c in " \na1.é漢"] == [0, 0, 1, 2, 3, 1, 1]
