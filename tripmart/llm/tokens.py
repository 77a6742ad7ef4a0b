"""Token counts of whole texts by a byte-level BPE tokenizer, without materialising token ids.

1. Each task cuts its documents into pre-tokens and keeps, for blocks of documents, the distinct
   pieces and every document's piece frequencies (packed integers into the block's piece list).
2. The pieces of all blocks are dealt by piece; each distinct piece is tokenized once and only the
   number of its tokens goes back to the blocks.
3. Blocks are joined with their piece counts; a document's count is the sum of frequency x count.

A block is bounded by the number of its pieces and pairs, so no key gathers more than one entry per block and no
document is sent anywhere by itself.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored
from tripmart.llm.hashing import span_keys

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
# The contractions of the pre-tokenizer's pattern.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

_BLOCKS = (
    "block long, doc_id array<long>, n_bytes array<long>, extra array<long>,"
    " n_pieces array<long>, piece_at binary, freq binary, pieces array<string>"
)


@functools.lru_cache(maxsize=4)
def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def character_classes(path: str) -> np.ndarray:
    """Class of every code point, asked of the tokenizer's own pre-tokenizer.

    Unicode versions differ between libraries, so no other table is relied on.
    """
    split = load_tokenizer(path).pre_tokenizer.pre_tokenize_str
    table = np.full(0x110000, OTHER, np.uint8)
    # no version of Unicode assigns letters, numbers or blanks beyond plane 3
    left = np.setdiff1d(np.arange(0x40000), np.arange(0xD800, 0xE000))
    # a character that joins the run of the one before it is of the same class
    for before, cls in (("+", OTHER), ("a", LETTER), ("1", NUMBER)):
        joined = []
        for part in np.array_split(left, max(1, len(left) // 2048)):
            text = "".join(f"{before}{chr(c)}\n" for c in part)
            starts = np.zeros(len(text), bool)
            starts[[span[0] for _, span in split(text)]] = True
            joined.append(part[~starts[1::3]])
        of_class = np.concatenate(joined)
        table[of_class] = cls
        left = np.setdiff1d(left, of_class)
    table[left] = SPACE
    return table


def special_strings(path: str) -> list[str]:
    """Added tokens that the library cuts out of texts before anything else."""
    found = []
    for token in load_tokenizer(path).get_added_tokens_decoder().values():
        if token.lstrip or token.rstrip or token.single_word:
            raise ValueError(f"added token {token.content!r} absorbs or needs its surroundings")
        found.append(token.content)
    return sorted(found, key=len, reverse=True)


def cut(code: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in ``code``; segments begin at the positions ``first``."""
    n = len(code)
    cls = classes[code]
    at_start = np.zeros(n + 1, bool)
    at_start[first] = True
    at_start[n] = True
    begin = at_start.copy()
    begin[1:n] |= cls[1:] != cls[:-1]
    # the last white space before other text stands apart, and a blank goes with that text
    run = np.flatnonzero(begin[:n] & (cls != SPACE) & ~at_start[:n])
    run = run[cls[run - 1] == SPACE]
    begin[run - 1] = True
    begin[run] = code[run - 1] != 0x20
    quote = np.flatnonzero((code == 0x27) & begin[:n])
    if len(quote):
        padded = np.concatenate([code, np.zeros(3, code.dtype)])
        ends = np.cumsum(at_start[:n])
        for word in CONTRACTIONS:
            m = len(word)
            hit = quote[quote + m < n]
            hit = hit[ends[hit] == ends[hit + m]]
            for k, letter in enumerate(word, 1):
                hit = hit[padded[hit + k] == ord(letter)]
            begin[hit + 1] = False
            begin[hit + 1 + m] = True
    return np.flatnonzero(begin[:n])


def _pack_chunk(texts: list[str], specials: list[str], classes: np.ndarray) -> tuple:
    """(special strings, distinct pieces per text, piece places, frequencies, pieces)."""
    segments, owner, extra = [], [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        parts = [text]
        for special in specials:
            if special in text:
                before = len(parts)
                parts = [x for part in parts for x in part.split(special)]
                extra[k] += len(parts) - before
        kept = [x for x in parts if x]
        segments += kept
        owner += [k] * len(kept)
    if not segments:
        return extra, np.zeros(len(texts), np.int64), np.zeros(0, int), np.zeros(0, int), []
    joined = "".join(segments)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate([[0], np.cumsum([len(x) for x in segments])[:-1]]).astype(np.int64)
    begin = cut(code, first, classes)
    end = np.append(begin[1:], len(code))
    _, seen, place = np.unique(span_keys(code, begin, end), return_index=True, return_inverse=True)
    text_of = np.asarray(owner)[np.searchsorted(first, begin, side="right") - 1]
    pairs, freq = np.unique(text_of * len(seen) + place, return_counts=True)
    per_text = np.bincount(pairs // len(seen), minlength=len(texts))
    pieces = [joined[a:b] for a, b in zip(begin[seen].tolist(), end[seen].tolist(), strict=True)]
    return extra, per_text, pairs % len(seen), freq, pieces


def _ascending(per_text: np.ndarray, at: np.ndarray, freq: np.ndarray) -> tuple:
    """Piece places of each text in order, as gaps, which are small; frequencies likewise."""
    order = np.lexsort((at, np.repeat(np.arange(len(per_text)), per_text)))
    gaps = np.diff(at[order], prepend=0)
    first = (np.cumsum(per_text) - per_text)[per_text > 0]
    gaps[first] = at[order][first]
    return gaps, freq[order]


def _places(per_text: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """The piece places that ``_ascending`` has turned into gaps."""
    total = np.cumsum(gaps.astype(np.int64))
    first = (np.cumsum(per_text) - per_text)[per_text > 0]
    before = np.concatenate([[0], total])[first]
    return total - np.repeat(before, per_text[per_text > 0])


def _squeeze(values: np.ndarray) -> bytes:
    """Byte planes of unsigned 32-bit integers, compressed."""
    import zstandard

    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 3)


def _unsqueeze(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks(specials: list[str], classes, chunk_chars: int, block_pieces: int):
    schema = pa.schema(
        [("block", pa.int64()), ("doc_id", pa.list_(pa.int64())),
         ("n_bytes", pa.list_(pa.int64())), ("extra", pa.list_(pa.int64())),
         ("n_pieces", pa.list_(pa.int64())), ("piece_at", pa.binary()), ("freq", pa.binary()),
         ("pieces", pa.list_(pa.string()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = classes.value
        part, number, pairs = TaskContext.get().partitionId(), 0, 0
        places: dict[str, int] = {}  # the block's pieces, in order of their numbers
        rows: list[list] = [[], []]
        packed: list[tuple] = []
        texts: list[str] = []
        chars = 0

        def pack() -> None:
            nonlocal chars, pairs
            extra, per_text, at, freq, pieces = _pack_chunk(texts, specials, table)
            number_of = np.array([places.setdefault(p, len(places)) for p in pieces], np.int64)
            packed.append((extra, per_text, *_ascending(per_text, number_of[at], freq)))
            pairs += len(at)
            texts.clear()
            chars = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, pairs
            extra, per_text, at, freq = (np.concatenate(x) for x in zip(*packed, strict=True))
            row = {
                "block": [(part << 32) + number], "doc_id": [rows[0]], "n_bytes": [rows[1]],
                "extra": [extra], "n_pieces": [per_text], "piece_at": [_squeeze(at)],
                "freq": [_squeeze(freq)], "pieces": [list(places)],
            }
            batch = pa.RecordBatch.from_pydict(row, schema=schema)
            number, pairs = number + 1, 0
            rows[:] = [[], []]
            packed.clear()
            places.clear()
            return batch

        for batch in batches:
            for doc_id, n_bytes, text in zip(*batch.columns, strict=True):
                rows[0].append(doc_id.as_py())
                rows[1].append(n_bytes.as_py())
                texts.append(text.as_py() or "")
                chars += len(texts[-1])
                if chars >= chunk_chars or len(texts) >= 50_000:
                    pack()
                    if len(places) >= block_pieces or pairs >= 20 * block_pieces:
                        yield flush()
        if texts:
            pack()
        if packed:
            yield flush()

    return run


def _piece_tokens(path: str, flush_rows: int = 500_000):
    """Pieces sorted within the partition: each distinct one is tokenized once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        held: dict[int, list[tuple]] = {}
        rows, last, last_n = 0, None, 0

        def flush() -> pa.RecordBatch:
            out = [
                (block, _squeeze(np.concatenate([a for a, _ in parts])),
                 _squeeze(np.concatenate([b for _, b in parts])))
                for block, parts in held.items()
            ]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int64()),
                 pa.array([r[1] for r in out], pa.binary()),
                 pa.array([r[2] for r in out], pa.binary())], ["block", "at", "tokens"]
            )

        for batch in batches:
            piece = batch.column(0).to_pylist()
            blocks = batch.column(1).to_numpy()
            at = batch.column(2).to_numpy()
            new = [k for k, p in enumerate(piece) if p != (piece[k - 1] if k else last)]
            found = tokenizer.encode_batch_fast([piece[k] for k in new], add_special_tokens=False)
            n = np.zeros(len(piece), np.int64)
            counts = np.array([len(x) for x in found], np.int64)
            edges = np.array([*new, len(piece)], np.int64)
            n[: edges[0]] = last_n
            n[edges[0] :] = np.repeat(counts, np.diff(edges))
            last, last_n = piece[-1], int(n[-1])
            names, where = np.unique(blocks, return_inverse=True)
            order = np.argsort(where, kind="stable")
            cuts = np.cumsum(np.bincount(where))[:-1]
            for name, rows_of in zip(names.tolist(), np.split(order, cuts), strict=True):
                held.setdefault(name, []).append((at[rows_of], n[rows_of]))
            rows += len(piece)
            if rows >= flush_rows:
                rows = 0
                yield flush()
        if held:
            yield flush()

    return run


_SUMS = pa.schema([("row_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _sum_blocks(key, docs: pa.Table, counted: pa.Table) -> pa.Table:
    out = []
    for row in docs.to_pylist():
        per_text = np.array(row["n_pieces"], np.int64)
        at, freq = _places(per_text, _unsqueeze(row["piece_at"])), _unsqueeze(row["freq"])
        tokens = np.zeros(int(at.max()) + 1 if len(at) else 0, np.int64)
        for places, n in zip(counted["at"], counted["tokens"], strict=True):
            tokens[_unsqueeze(places.as_py())] = _unsqueeze(n.as_py())
        total = np.concatenate([[0], np.cumsum(tokens[at] * freq.astype(np.int64))])
        edges = np.concatenate([[0], np.cumsum(row["n_pieces"])]).astype(np.int64)
        sums = total[edges[1:]] - total[edges[:-1]] + np.array(row["extra"], np.int64)
        out.append(pa.table([row["doc_id"], row["n_bytes"], sums], schema=_SUMS))
    return pa.concat_tables(out) if out else _SUMS.empty_table()


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = 2_000_000,
    block_pieces: int = 400_000,
) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row of ``docs``, as the tokenizer file's library counts the text.

    Null text counts as empty (0 tokens). Special strings inside a text count as the library does
    by default: one token each. Repeated rows and ids give one result row each, a null id stays
    null; other columns of ``docs`` are neither read nor returned. No text is cut: one longer than
    ``chunk_chars`` is worked on by itself. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    classes = spark.sparkContext.broadcast(character_classes(tokenizer_path))  # 1.1 MB, fixed
    blocks = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
            F.col(text_col).alias("text"),
        ).mapInArrow(
            _blocks(special_strings(tokenizer_path), classes, chunk_chars, block_pieces), _BLOCKS
        ),
        "token-blocks",
    )
    counted = (
        blocks.select("block", F.posexplode("pieces").alias("at", "piece"))
        .select("piece", "block", "at")
        .repartition("piece")
        .sortWithinPartitions("piece")
        .mapInArrow(_piece_tokens(tokenizer_path), "block long, at binary, tokens binary")
    )
    return (
        blocks.drop("pieces").groupBy("block")
        .cogroup(counted.groupBy("block"))
        .applyInArrow(_sum_blocks, "row_id long, n_bytes long, n_tokens long")
        .withColumnRenamed("row_id", id_col)
    )
