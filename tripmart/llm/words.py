"""Words of whole texts as arrays: runs of ASCII digits and letters and of all non-ASCII characters.

A-Z are lower-cased. Every byte of a non-ASCII character is above 0x7F, so the work is on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tripmart.llm.hashing import span_keys

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[ord("0") : ord("9") + 1] = True
_IN_WORD[ord("a") : ord("z") + 1] = True
_IN_WORD[0x80:] = True


class Words:
    """Words of several texts, in order, with 64-bit keys; ``ends[i]`` ends the text of word i."""

    def __init__(self, texts: list[str | None]):
        data = "\n".join(t or "" for t in texts).encode("utf-8", "surrogatepass")
        self.raw = np.frombuffer(data, np.uint8)
        self.data = _LOWER[self.raw]
        inside = np.zeros(len(self.data) + 2, np.int8)
        inside[1:-1] = _IN_WORD[self.data]
        step = np.diff(inside)
        self.begin, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.keys = span_keys(self.data, self.begin, self.end)
        size = np.array([len((t or "").encode("utf-8", "surrogatepass")) for t in texts], np.int64)
        self.text_at = np.concatenate([[0], np.cumsum(size + 1)])
        edge = np.searchsorted(self.begin, self.text_at)
        self.first = edge[:-1]
        self.counts = np.diff(edge)
        self.text_of = np.repeat(np.arange(len(texts)), self.counts)
        self.ends = np.repeat(edge[1:], self.counts)

    def __len__(self) -> int:
        return len(self.begin)

    def join(self, a: int, b: int) -> str:
        """Words a to b, lower-cased, one blank between."""
        return " ".join(
            self.data[x:y].tobytes().decode("utf-8", "surrogatepass")
            for x, y in zip(self.begin[a:b].tolist(), self.end[a:b].tolist(), strict=True)
        )

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and keys of all runs of ``k`` words within a text."""
        at = np.flatnonzero(np.arange(len(self)) + k <= self.ends)
        return at, span_keys(self.keys, at, at + k)


def chunks(rows: Iterator[tuple], text_at: int, chars: int = 600_000) -> Iterator[list[tuple]]:
    """Rows in lists of about ``chars`` characters, a longer text by itself."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[text_at] or "") + 20
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def arrow_rows(batches) -> Iterator[tuple]:
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            yield tuple(x.as_py() for x in row)
