"""Substring deduplication by compressed FM-indexes (operator 5).

Removes every word that a window of ``LENGTH`` words covers whose word sequence also starts
anywhere else, in the same document too; windows are judged on the input.

The stretches that can hold a repeated window (``repeats.py``) are dealt to shards by anchor.
Each shard is indexed: the suffix array of its distinct stretches (as word numbers, with an
end mark after each) gives the Burrows-Wheeler transform, kept in a wavelet matrix of
packed bits with counts per 64 bits, so counting a word before a place takes one
step per bit of the word's number. The windows then stream through backward search,
side by side, from their last word to their first; a window whose interval shrinks to its own
place drops out, and those whose interval holds two places or more over ``LENGTH`` words are
reported.

Defined cases: a null text has no words; rows that repeat a doc_id are one document (each row
gets its result); rows without a doc_id stay whole and are no source; texts of fewer than
``LENGTH`` words stay whole; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofi.llm import repeats
from cofi.llm.common import SPACES, pieces
from cofi.llm.suffix import suffix_array
from cofi.session import materialize

LENGTH = 35
GRAM = 8
STREAM = 1 << 16  # windows searched side by side

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_BASE = 0x9E3779B97F4A7C15


class Words(repeats.Kind):
    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram

    def units(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        space = _SPACE[raw]
        start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        end = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
        # a word's hash: its bytes times powers of a base, from sums up to each place
        power = np.cumprod(np.full(len(raw), _BASE, np.uint64))
        upto = np.concatenate([[np.uint64(0)], np.cumsum(raw * power)])
        back = np.cumprod(np.full(len(raw), pow(_BASE, -1, 1 << 64), np.uint64))
        hashes = repeats.mix((upto[end] - upto[start]) * back[start])
        ends = np.cumsum([len(t) + 1 for t in texts])
        return hashes, np.concatenate([[0], np.searchsorted(start, ends)])

    def opened(self, text: bytes) -> list[bytes]:
        return text.split()

    def cut(self, opened: list[bytes], first: int, n: int) -> bytes:
        return b" ".join(opened[first:first + n])

    def part(self, stretch: bytes, i: int) -> bytes:
        return b" ".join(stretch.split(b" ")[i:i + self.length])


class WaveletMatrix:
    """Counts of a symbol before a place; one packed bit row per bit of the symbols' numbers."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        now = symbols
        for bit in reversed(range(max(1, top.bit_length()))):
            on = (now >> bit) & 1 == 1
            packed = np.packbits(on, bitorder="little")
            words = np.zeros(len(on) // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]])
            zeros = int(len(on) - on.sum())
            self.levels.append((bit, words, before, zeros))
            now = np.concatenate([now[~on], now[on]])
        every = np.arange(top + 1)
        self.start = self._follow(every, np.zeros(top + 1, np.int64))

    def _follow(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for bit, words, before, zeros in self.levels:
            word = place >> 6
            mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[word] + np.bitwise_count(words[word] & mask)
            place = np.where((symbol >> bit) & 1 == 1, zeros + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self._follow(symbol, place) - self.start[symbol]


class FmIndex:
    """Over a text of numbers from 0 to ``top`` that ends with 0, the end mark; patterns hold none."""

    def __init__(self, text: np.ndarray, top: int):
        order = suffix_array(text)
        self.wavelet = WaveletMatrix(text[order - 1], top)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.size = len(text)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with ``symbol`` put in front."""
        return (self.before[symbol] + self.wavelet.rank(symbol, low),
                self.before[symbol] + self.wavelet.rank(symbol, high))

    def occurs(self, text: np.ndarray, starts: np.ndarray, length: int, least: int = 2) -> np.ndarray:
        """Which of the patterns of ``length`` symbols of ``text`` from ``starts`` occur ``least`` times."""
        out = np.zeros(len(starts), bool)
        for at in range(0, len(starts), STREAM):
            own = np.arange(at, min(at + STREAM, len(starts)))
            low, high = np.zeros(len(own), np.int64), np.full(len(own), self.size, np.int64)
            for k in reversed(range(length)):
                low, high = self.extend(text[starts[own] + k], low, high)
                go = high - low >= least
                if not go.all():
                    own, low, high = own[go], low[go], high[go]
                if not len(own):
                    break
            out[own] = True
        return out


def repeated_windows(rows: dict[str, list], length: int) -> tuple[list[int], list[int], list[int]]:
    """(doc_id, first, n) runs of the windows of a shard that start at two places or more."""
    copies: dict[bytes, int] = {}
    for data, c in zip(rows["data"], rows["copies"]):
        copies[data] = copies.get(data, 0) + c
    data = list(copies)
    numbers: dict[bytes, int] = {}
    lists = [[numbers.setdefault(w, len(numbers) + 1) for w in d.split(b" ")] for d in data]
    sizes = np.array([len(x) for x in lists])
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(lists), np.int64)
    text[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))] = np.concatenate(lists)
    single = np.array([copies[d] == 1 for d in data])
    n = sizes - length + 1
    stretch = np.repeat(np.arange(len(data)), n)
    window = np.arange(len(stretch)) - np.repeat(np.cumsum(n) - n, n)
    found = ~single[stretch]  # a stretch at two places: all of its windows are
    ask = np.flatnonzero(single[stretch])
    if len(ask):
        found[ask] = FmIndex(text, len(numbers)).occurs(text, starts[stretch[ask]] + window[ask], length)
    begin = found & np.concatenate([[True], ~found[:-1] | (stretch[1:] != stretch[:-1])])
    end = found & np.concatenate([~found[1:] | (stretch[1:] != stretch[:-1]), [True]])
    runs: dict[bytes, list[tuple[int, int]]] = {}
    for a, b in zip(np.flatnonzero(begin).tolist(), np.flatnonzero(end).tolist()):
        runs.setdefault(data[stretch[a]], []).append((int(window[a]), b - a + 1))
    out = [(doc, first + a, k) for doc, first, d in zip(rows["doc_id"], rows["first"], rows["data"]) for a, k in runs.get(d, ())]
    return tuple(map(list, zip(*out))) if out else ([], [], [])


def repeated(docs: DataFrame, kind: Words, parts: int | None, hot: int = repeats.HOT, size: int | None = None) -> DataFrame:
    """(doc_id, first, n): runs of the windows that start at two places or more."""
    found = repeats.candidates(docs, kind, parts or repeats.default_parts(docs, size))
    stretches = materialize(repeats.segments(docs, found, kind), "fm-stretches", "zstd")
    length = kind.length

    def search(table: pa.Table) -> pa.Table:
        doc, first, n = repeated_windows({c: table.column(c).to_pylist() for c in ("doc_id", "first", "copies", "data")}, length)
        return pa.table({"doc_id": pa.array(doc, pa.int64()), "first": pa.array(first, pa.int32()), "n": pa.array(n, pa.int32())})

    dealt, alone = repeats.shards(stretches, kind, parts, hot)
    within = dealt.groupBy("shard").applyInArrow(search, "doc_id BIGINT, first INT, n INT")
    if alone is not None:
        within = within.unionAll(repeats.repeated_alone(alone, later=False))
    return within.unionAll(stretches.where("data IS NULL").select("doc_id", "first", "n"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, parts: int | None = None,
                   hot: int = repeats.HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, spans ARRAY<STRUCT<start, end>>, kept BINARY) per row of ``docs``: the
    removed ranges of words and the others, joined by one space."""
    kind = Words(length, gram)
    docs, names, size = repeats.told_apart(docs)
    windows = repeated(docs, kind, parts, hot, size)

    def finish(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in pieces(batch, max_bytes=repeats.BLOCK):
            ids, texts, spans = (c.to_pylist() for c in piece.columns)
            out: dict[str, list] = {c: [] for c in ("n_words", "n_removed", "spans", "kept")}
            for text, runs in zip(texts, spans):
                words = repeats.unpacked(text).split()
                gone = repeats.coverage(runs, length, len(words))
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                out["n_words"].append(len(words))
                out["n_removed"].append(int(gone.sum()))
                out["spans"].append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                out["kept"].append(b" ".join([w for w, g in zip(words, gone) if not g] if len(edge) else words))
            yield {"doc_id": ids} | out

    return repeats.named(repeats.with_spans(docs, windows, finish, "doc_id BIGINT, n_words BIGINT, n_removed BIGINT, "
                                                     "spans ARRAY<STRUCT<start: BIGINT, end: BIGINT>>, kept BINARY"), names)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
