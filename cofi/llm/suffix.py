"""Suffix-array deduplication (operator 6).

Removes every byte that a string of ``LENGTH`` bytes covers which also starts earlier:
in a document of smaller doc_id, or earlier in the same one. Matches never cross documents.

A suffix array over all bytes would have to move each suffix's place and key through a
shuffle at every level of the recursion, some forty times the input. So suffixes are first
dealt to shards by the anchors of ``repeats.py``, which keep every two places that can
begin the same ``LENGTH`` bytes together, and leave out the places whose anchor occurs once.
Each shard then runs the difference-cover algorithm: the suffixes at places 1 and 2 modulo 3
are sorted by triples of symbols, their names make a text of two thirds the length that is
sorted the same way, the remaining suffixes are sorted by first symbol and following rank,
and both are merged. Adjacent suffixes are compared over ``LENGTH`` bytes; of each run of equal
ones the earliest place stays.

Defined cases: a null text is an empty text; rows that repeat a doc_id are one document (each
row gets its result); rows without a doc_id stay whole and are no source; texts shorter than
``LENGTH`` stay whole; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofi.llm import repeats
from cofi.llm.common import pieces
from cofi.session import materialize

LENGTH = 100
GRAM = 32


class Bytes(repeats.Kind):
    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram

    def units(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        return np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64), bounds

    def opened(self, text: bytes) -> bytes:
        return text

    def cut(self, opened: bytes, first: int, n: int) -> bytes:
        return opened[first:first + n]

    def part(self, stretch: bytes, i: int) -> bytes:
        return stretch[i:i + self.length]


def names(a: np.ndarray, b: np.ndarray, c: np.ndarray, top: int) -> tuple[np.ndarray, int]:
    """(order-preserving names from 1 of the triples, how many): symbols are 0 to ``top``."""
    bits = top.bit_length()
    if (top + 1) ** 3 <= 1 << 25:  # few enough to be marked in a table
        key = (a * (top + 1) + b) * (top + 1) + c
        rank = np.zeros((top + 1) ** 3, np.int32)
        rank[key] = 1
        np.cumsum(rank, out=rank)
        return rank[key].astype(np.int64), int(rank[-1])
    if 3 * bits > 62:
        pair, a = np.unique((a << bits) | b, return_inverse=True)
        key = (a.astype(np.int64) << bits) | c
    else:
        key = (((a << bits) | b) << bits) | c
    kinds, name = np.unique(key, return_inverse=True)
    return name.astype(np.int64) + 1, len(kinds)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of ``s`` (numbers from 0) in the order of their suffixes."""
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    return _difference_cover(np.concatenate([s.astype(np.int64) + 1, [0, 0, 0]]), n, int(s.max()) + 1)


def _difference_cover(t: np.ndarray, n: int, top: int) -> np.ndarray:
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: t[i:n].tolist()), np.int64)
    # the sample; with n % 3 == 1 a place behind the end closes the first part of its text
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])
    name, kinds = names(t[sample], t[sample + 1], t[sample + 2], top)
    rank = np.zeros(n + 3, np.int64)
    if kinds == len(sample):
        rank[sample] = name
        ordered = np.empty(len(sample), np.int64)
        ordered[name - 1] = sample
    else:
        ordered = sample[_difference_cover(np.concatenate([name, [0, 0, 0]]), len(sample), kinds)]
        rank[ordered] = np.arange(1, len(sample) + 1)
    low = (len(sample) + 1).bit_length()
    first = lambda p: (t[p] << low) | rank[p + 1]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(first(rest))]
    # merge: against places 1 modulo 3 by one symbol and a rank, against 2 modulo 3 by two
    one, two = ordered[(ordered % 3 == 1) & (ordered < n)], ordered[ordered % 3 == 2]
    bits = top.bit_length()
    if 2 * bits + low <= 62:
        second = lambda p: (((t[p] << bits) | t[p + 1]) << low) | rank[p + 2]
        mine, other = second(rest), second(two)
    else:
        both = np.concatenate([rest, two])
        pair = np.unique((t[both] << bits) | t[both + 1], return_inverse=True)[1].astype(np.int64)
        key = (pair << low) | rank[both + 2]
        mine, other = key[:len(rest)], key[len(rest):]
    at = np.arange(len(rest)) + np.searchsorted(first(one), first(rest)) + np.searchsorted(other, mine)
    out = np.empty(n, np.int64)
    free = np.ones(n, bool)
    free[at] = False
    out[at] = rest
    out[free] = ordered[ordered < n]
    return out


def equal_prefixes(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` (8 or more) bytes from each place equal those from the place before it."""
    words = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view("<u8").ravel()
    same = np.ones(len(places), bool)
    same[0] = False
    for k in [*range(0, length - 7, 8), length - 8]:
        at = np.flatnonzero(same)
        same[at] = words[places[at] + k] == words[places[at - 1] + k]
    return same


def repeated_windows(rows: dict[str, list], length: int) -> tuple[list[int], list[int], list[int]]:
    """(doc_id, first, n) runs of the windows of a shard that also start earlier."""
    order = sorted(range(len(rows["doc_id"])), key=lambda i: (rows["doc_id"][i], rows["first"][i]))
    docs, firsts, ns, kept, seen = [], [], [], [], set()
    for i in order:
        if rows["data"][i] in seen:  # an equal stretch has its place earlier
            docs.append(rows["doc_id"][i])
            firsts.append(rows["first"][i])
            ns.append(rows["n"][i])
        else:
            seen.add(rows["data"][i])
            kept.append(i)
    data = [rows["data"][i] for i in kept]
    n = np.array([rows["n"][i] for i in kept], np.int64)
    text = np.frombuffer(b"\0".join(data), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])])[:-1]
    # a stretch ends below any byte: symbols are byte + 1, its end is 0
    symbols = text.astype(np.int64) + 1
    symbols[starts[1:] - 1] = 0
    stretch = np.repeat(np.arange(len(data)), n)
    window = np.arange(len(stretch)) - np.repeat(np.cumsum(n) - n, n)
    number = np.full(len(text), -1, np.int64)  # of the window that begins at a place; by (doc_id, first)
    number[starts[stretch] + window] = np.arange(len(stretch))
    suffixes = suffix_array(symbols)
    suffixes = suffixes[number[suffixes] >= 0]
    group = np.flatnonzero(~equal_prefixes(text, suffixes, length))
    found = number[suffixes]
    doc_rank = np.unique([rows["doc_id"][i] for i in kept], return_inverse=True)[1].astype(np.int64)
    first = np.array([rows["first"][i] for i in kept], np.int64)
    place = ((doc_rank[stretch] << 32) | (first[stretch] + window))[found]
    sizes = np.diff(np.append(group, len(found)))
    earliest = np.repeat(np.minimum.reduceat(place, group), sizes)
    flag = np.zeros(len(stretch), bool)
    flag[found] = place > earliest
    begin = flag & np.concatenate([[True], ~flag[:-1] | (stretch[1:] != stretch[:-1])])
    end = flag & np.concatenate([~flag[1:] | (stretch[1:] != stretch[:-1]), [True]])
    a, b = np.flatnonzero(begin), np.flatnonzero(end)
    docs += [rows["doc_id"][kept[k]] for k in stretch[a]]
    firsts += (first[stretch[a]] + window[a]).tolist()
    ns += (b - a + 1).tolist()
    return docs, firsts, ns


def repeated(docs: DataFrame, kind: Bytes, parts: int | None, hot: int = repeats.HOT, size: int | None = None) -> DataFrame:
    """(doc_id, first, n): runs of the windows that also start earlier."""
    found = repeats.candidates(docs, kind, parts or repeats.default_parts(docs, size))
    stretches = materialize(repeats.segments(docs, found, kind), "suffix-stretches", "zstd")
    length = kind.length

    def search(table: pa.Table) -> pa.Table:
        doc, first, n = repeated_windows({c: table.column(c).to_pylist() for c in ("doc_id", "first", "n", "data")}, length)
        return pa.table({"doc_id": pa.array(doc, pa.int64()), "first": pa.array(first, pa.int32()), "n": pa.array(n, pa.int32())})

    dealt, alone = repeats.shards(stretches, kind, parts, hot)
    within = dealt.groupBy("shard").applyInArrow(search, "doc_id BIGINT, first INT, n INT")
    if alone is not None:
        within = within.unionAll(repeats.repeated_alone(alone, later=True))
    copies = stretches.where("data IS NULL").select("doc_id", "first", "n")
    return within.unionAll(copies)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, parts: int | None = None,
                   hot: int = repeats.HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans ARRAY<STRUCT<start, end>>, kept BINARY) per row of ``docs``:
    the removed byte ranges and what is left."""
    kind = Bytes(length, gram)
    docs, names, size = repeats.told_apart(docs)
    windows = repeated(docs, kind, parts, hot, size)

    def finish(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in pieces(batch, max_bytes=repeats.BLOCK):
            ids, texts, spans = (c.to_pylist() for c in piece.columns)
            out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "spans", "kept")}
            for text, runs in zip(texts, spans):
                raw = repeats.unpacked(text)
                gone = repeats.coverage(runs, length, len(raw))
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(int(gone.sum()))
                out["spans"].append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                out["kept"].append(np.frombuffer(raw, np.uint8)[~gone].tobytes() if len(edge) else raw)
            yield {"doc_id": ids} | out

    return repeats.named(repeats.with_spans(docs, windows, finish, "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, "
                                                     "spans ARRAY<STRUCT<start: BIGINT, end: BIGINT>>, kept BINARY"), names)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
                                       F.sha2("kept", 256).alias("kept_sha256"))
