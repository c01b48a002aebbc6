"""Document fingerprints by context-triggered piecewise hashing (operator 4).

A hash of the last seven bytes rolls over the text; where it is one below a multiple of the
block size, a piece ends. Every piece gives one unit of the signature (12 bits of its hash, two
characters), so an edit changes the units of the pieces it touches and no others. The block size
is the smallest of 3, 6, 12, ... that gives ``UNITS`` pieces at most; the fingerprint
``size:signature:signature at twice the size`` can then be compared with one of half, the
same or twice the block size. The likeness of two signatures is one less their edit
distance (units inserted or removed) over their total length; of two fingerprints the
greatest over the compatible pairs, 0 if there is none, 1 for equal fingerprints.

``edited_likeness`` compares each document with an edited form, in which the last quarter is
replaced by the start of the next document in the order of doc_id. The rows are range
partitioned by doc_id once; only the last row of a partition has its next one elsewhere, and
these few are joined afterwards.

Defined cases: a null text is an empty text, whose fingerprint is ``3::``; rows that repeat a
doc_id follow each other, by text; null ids come first; the row after the last is the first, so a
single row follows itself; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cofi.llm.common import map_batches, pieces, text_rows
from cofi.session import materialize

UNITS = 64
LEAST = 3
CONTEXT = 7
CHUNK = 1 << 20    # bytes rolled over together
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_UNIT = [ALPHABET[i >> 6] + ALPHABET[i & 63] for i in range(4096)]
_WEIGHTS = [np.uint32(pow(0x01000193, k, 1 << 32)) for k in range(CONTEXT)]


def rolling(raw: bytes, at: int, end: int) -> np.ndarray:
    """The rolling hash after each byte from ``at`` to ``end``; bytes before the text count as zero."""
    before = raw[max(0, at - CONTEXT + 1):at]
    x = np.frombuffer(b"\0" * (CONTEXT - 1 - len(before)) + before + raw[at:end], np.uint8).astype(np.uint32)
    n = end - at
    h = np.zeros(n, np.uint32)
    for k in range(CONTEXT):
        h += x[CONTEXT - 1 - k:CONTEXT - 1 - k + n] * _WEIGHTS[k]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return h ^ (h >> np.uint32(13))


def triggers(raw: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(places behind the piece ends at block ``size``, the rolling hashes there)."""
    places, hashes = [], []
    for at in range(0, len(raw), CHUNK):
        h = rolling(raw, at, min(at + CHUNK, len(raw)))
        hit = np.flatnonzero(h % np.uint32(size) == size - 1)
        places.append(hit + at + 1)
        hashes.append(h[hit])
    return np.concatenate(places), np.concatenate(hashes)


def signature(raw: bytes, ends: np.ndarray) -> str:
    bounds = [0, *ends.tolist()]
    if bounds[-1] != len(raw):
        bounds.append(len(raw))
    digest = xxhash.xxh3_64_intdigest
    return "".join([_UNIT[digest(raw[a:b]) & 4095] for a, b in zip(bounds, bounds[1:])])


def fingerprint(raw: bytes) -> str:
    if not raw:
        return f"{LEAST}::"
    size = LEAST
    while size * UNITS * 4 < len(raw):  # a start well below the one sought, where most texts have too many pieces
        size *= 2
    places, hashes = triggers(raw, size)
    while size > LEAST and len(places) < UNITS:  # too few already: from the smallest
        size //= 2
        places, hashes = triggers(raw, size)
    while len(places) + 1 > UNITS:
        size *= 2
        keep = hashes % np.uint32(min(size, 2**32 - 1)) == min(size, 2**32 - 1) - 1
        places, hashes = places[keep], hashes[keep]
    coarse = places[hashes % np.uint32(min(2 * size, 2**32 - 1)) == min(2 * size, 2**32 - 1) - 1]
    return f"{size}:{signature(raw, places)}:{signature(raw, coarse)}"


def likeness_of(a: str, b: str) -> float:
    """Of two signatures: from their longest common subsequence, which gives the edit distance
    ``len(a) + len(b) - 2 * common``; 64 units of one are compared at a time, as bits of a number."""
    x, y = ([s[i:i + 2] for i in range(0, len(s), 2)] for s in (a, b))
    if not x or not y:
        return float(a == b)
    where: dict[str, int] = {}
    for i, unit in enumerate(x):
        where[unit] = where.get(unit, 0) | 1 << i
    full = (1 << len(x)) - 1
    rows = full
    for unit in y:
        hit = where.get(unit)
        if hit:
            both = rows & hit
            rows = (rows + both | rows - both) & full
    common = len(x) - rows.bit_count()
    return 1 - (len(x) + len(y) - 2 * common) / (len(x) + len(y))


def likeness(a: str, b: str) -> float:
    """Of two fingerprints, 0 to 1."""
    if a == b:
        return 1.0
    (m, a1, a2), (n, b1, b2) = a.split(":"), b.split(":")
    if m == n:
        return max(likeness_of(a1, b1), likeness_of(a2, b2) if a2 and b2 else 0.0)
    if int(m) == 2 * int(n):
        return likeness_of(a1, b2)
    if int(n) == 2 * int(m):
        return likeness_of(a2, b1)
    return 0.0


def edited(text: str, following: str) -> str:
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) per row of ``docs``."""
    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in pieces(batch):
            texts = [t or "" for t in piece.column(1).to_pylist()]
            yield {"doc_id": piece.column(0), "n_chars": [len(t) for t in texts],
                   "fingerprint": [fingerprint(t.encode("utf-8")) for t in texts]}

    return map_batches(text_rows(docs), run, "doc_id BIGINT, n_chars BIGINT, fingerprint STRING")


_OUT = ("doc_id BIGINT, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING, edited_fingerprint STRING, "
        "near_edited DOUBLE, near_next DOUBLE")


def _row(doc_id: int | None, text: str, own: str, following: str, its: str) -> tuple:
    new = edited(text, following).encode("utf-8")
    mark = fingerprint(new)
    return (doc_id, len(text), hashlib.sha256(new).hexdigest(), own, mark, likeness(own, mark), likeness(own, its))


def edited_likeness(docs: DataFrame) -> DataFrame:
    """_OUT per row of ``docs``: the edited text's digest, both fingerprints, and the likeness to the
    edited form and to the next document."""
    schema = pa.schema([(n, {"BIGINT": pa.int64(), "STRING": pa.string(), "DOUBLE": pa.float64()}[k]) for n, k in (
        c.split() for c in f"{_OUT}, kind STRING, text STRING".split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # (doc_id, text, fingerprint) still without its next one
        out: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = (doc_id, text or "", fingerprint((text or "").encode("utf-8")))
                out.append((*_row(*last, *own[1:]), "done", None) if last else
                           (doc_id, None, None, own[2], None, None, None, "first", own[1]))
                last = own
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
                    out = []
        if last:
            out.append((last[0], None, None, last[2], None, None, None, "last", last[1]))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)

    dealt = text_rows(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = materialize(dealt.mapInArrow(run, f"{_OUT}, kind STRING, text STRING"), "ctph-rows")
    # two rows per partition; their ids alone are put in order
    ends = rows.where("kind <> 'done'")
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("doc_id").asc_nulls_first(), "kind")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    followed = (ends.select("doc_id", "kind").withColumn("n", F.lead(F.struct("doc_id")).over(order))
                .withColumn("n", F.coalesce("n", F.first(F.struct("doc_id")).over(every))).where("kind = 'last'")
                .select(F.col("doc_id").alias("id"), F.col("n.doc_id").alias("next_id")))
    last = ends.where("kind = 'last'").select("doc_id", F.col("text"), F.col("fingerprint"))
    first = ends.where("kind = 'first'").select(F.col("doc_id").alias("first_id"), F.col("text").alias("following"),
                                                F.col("fingerprint").alias("its"))
    pairs = last.join(followed, F.col("doc_id").eqNullSafe(F.col("id"))).join(
        first, F.col("next_id").eqNullSafe(F.col("first_id"))).select("doc_id", "text", "fingerprint", "following", "its")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.names[:-2]
        for batch in batches:
            done = [dict(zip(names, _row(*r))) for r in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_pylist(done, pa.schema([schema.field(n) for n in names]))

    closed = pairs.mapInArrow(close, _OUT)
    return rows.where("kind = 'done'").select(*closed.columns).unionAll(closed)
