"""Where texts repeat: the shared first steps of the two substring operators.

Both ask which windows of ``length`` units (words or bytes) of a document occur elsewhere.
Every window has an anchor: of the hashes of its grams of ``gram`` units the smallest, the
first of several. Equal windows have equal anchors, so a window can only repeat if its
anchor's hash does. That gives

1. ``candidates``: all anchors of all documents, routed by hash in packed blocks. A block of
   documents sends each hash once; what repeats inside a block is known there, so a passage
   that a third of all documents holds is not sent to one task once per document. The
   answer is (doc_id, first window, number of windows) for every anchor whose hash repeats.
2. ``segments``: for each of these the stretch of text its windows cover, equal stretches of
   a block once (the others name the first).
3. A shard of stretches, which all windows of its anchors meet in, is then searched
   by the operator's own index. Of an anchor that is too frequent for one task (more than
   ``hot`` stretches) every window counts on its own: equal windows have that anchor too, so an
   aggregate by window finds all of them, merged before the shuffle, and
4. ``covered`` gathers the windows found per document.

Rows that repeat a doc_id and its text are the same document, rows with one doc_id and different
texts are documents of their own (the least text hash counts as the earlier); rows without one are left as they are, and
count as no other's source.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cofi.llm.common import map_batches, pieces, text_rows
from cofi.session import materialize

BLOCK = 2 << 20    # bytes of text of a block
CHUNK = 1 << 20    # windows looked at together; positions in a chunk need 24 bits
SHARD = 2 << 20    # bytes of stretches of a shard, on average
PART = 96 << 20    # bytes of text whose anchors one task counts, on average
HOT = 20_000       # stretches of one anchor beyond which its windows are routed alone
_LOW = np.uint64((1 << 24) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def grams(x: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of every ``gram`` consecutive units, a power of two."""
    size = 1
    while size < gram:
        x = mix(x[:-size] * np.uint64(0x9E3779B97F4A7C15) + x[size:])
        size *= 2
    return x


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def anchors(units: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document number, first window, number of windows, hash) of every anchor. ``units``: uint64 per
    unit of the concatenated documents, document i from bounds[i] to bounds[i + 1]."""
    out: list[tuple[np.ndarray, ...]] = []
    ends = np.repeat(bounds[1:], np.diff(bounds))
    for at in range(0, max(len(units) - length + 1, 0), CHUNK):
        x = units[at:at + CHUNK + length - 1]
        g = grams(x, gram)
        place = sliding_min((g & ~_LOW) | np.arange(len(g), dtype=np.uint64), length - gram + 1) & _LOW
        valid = np.arange(at, at + len(place)) + length <= ends[at:at + len(place)]
        change = valid.copy()
        change[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
        first = np.flatnonzero(change)
        stop = np.append(change[1:], True) | ~np.append(valid[1:], False)
        last = np.flatnonzero(valid & stop)
        out.append((first + at, last - first + 1, g[place[first].astype(np.int64)]))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    first, n, h = (np.concatenate(x) for x in zip(*out))
    doc = np.searchsorted(bounds, first, side="right") - 1
    return doc, first - bounds[doc], n, h


_ITEM = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("first", "<u4"), ("n", "<u2"), ("local", "u1")])


def _pack(items: np.ndarray) -> bytes:
    """Column by column, which compresses better."""
    return zstandard.compress(len(items).to_bytes(8, "little") + b"".join(items[c].tobytes() for c in _ITEM.names), 1)


def _unpack(data: bytes) -> np.ndarray:
    raw = zstandard.decompress(data)
    out, at = np.empty(int.from_bytes(raw[:8], "little"), _ITEM), 8
    for c in _ITEM.names:
        size = len(out) * _ITEM[c].itemsize
        out[c] = np.frombuffer(raw, _ITEM[c], len(out), at)
        at += size
    return out


class Kind:
    """What a unit is. ``units``: (uint64 per unit, bounds) of several texts; ``cut``: the bytes of a
    stretch of units of one text, given what ``opened`` made of it."""

    length: int
    gram: int

    def units(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def opened(self, text: bytes):
        raise NotImplementedError

    def cut(self, opened, first: int, n: int) -> bytes:
        """The ``n`` units from ``first``."""
        raise NotImplementedError

    def part(self, stretch: bytes, i: int) -> bytes:
        """Window i of a stretch."""
        raise NotImplementedError


def candidates(docs: DataFrame, kind: Kind, parts: int) -> DataFrame:
    """(doc_id, first, n, hash): the anchors whose hash occurs at two places or more."""

    def send(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in pieces(batch, max_bytes=BLOCK):
            keep = [(i, t.encode("utf-8")) for i, t in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist())
                    if i is not None and t]
            if not keep:
                continue
            units, bounds = kind.units([t for _, t in keep])
            doc, first, n, h = anchors(units, bounds, kind.length, kind.gram)
            if not len(h):
                continue
            items = np.zeros(len(h), _ITEM)
            items["hash"], items["first"], items["n"] = h, first, n
            items["doc"] = np.array([i for i, _ in keep], np.int64)[doc]
            _, back, count = np.unique(h, return_inverse=True, return_counts=True)
            items["local"] = count[back] > 1
            _, at = np.unique(h, return_index=True)
            asked = items[np.sort(at)]
            to = (asked["hash"] % np.uint64(parts)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            rows = [(p, _pack(x)) for p, x in zip(*_split(asked[order], to[order]))]
            known = items[items["local"] == 1]
            if len(known):  # no question, but the same way; any part will do
                known["local"] = 2
                rows.append((int(keep[0][0] % parts), _pack(known)))
            yield {"part": [p for p, _ in rows], "data": [d for _, d in rows]}

    def answer(table: pa.Table) -> pa.Table:
        items = np.concatenate([_unpack(x) for x in table.column("data").to_pylist()])
        asked = items[items["local"] < 2]
        _, back, count = np.unique(asked["hash"], return_inverse=True, return_counts=True)
        found = np.concatenate([asked[(count[back] > 1) & (asked["local"] == 0)], items[items["local"] == 2]])
        return pa.table({"doc_id": found["doc"], "first": found["first"].astype(np.int32), "n": found["n"].astype(np.int32),
                         "hash": np.ascontiguousarray(found["hash"]).view(np.int64)})

    sent = map_batches(text_rows(docs), send, "part INT, data BINARY")
    return sent.groupBy("part").applyInArrow(answer, "doc_id BIGINT, first INT, n INT, hash BIGINT")


def _split(items: np.ndarray, keys: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """The runs of equal sorted ``keys`` and their items."""
    at = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[at].tolist(), np.split(items, at[1:])


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text BINARY): compressed texts, which halves what a shuffle of them writes."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        press = zstandard.ZstdCompressor(level=3).compress
        for piece in pieces(batch):
            yield {"doc_id": piece.column(0), "text": [
                None if t is None else press(t.encode("utf-8")) for t in piece.column(1).to_pylist()]}

    return map_batches(text_rows(docs), run, "doc_id BIGINT, text BINARY")


def unpacked(text: bytes | None) -> bytes:
    return zstandard.decompress(text) if text else b""


def segments(docs: DataFrame, found: DataFrame, kind: Kind) -> DataFrame:
    """(hash, doc_id, first, n, copies, data, of_doc, of_first): stretches of n windows from window ``first``.
    Of equal stretches in a block the first place holds the ``data`` and how many ``copies``
    there are; the others have no data and name that place. Of rows that repeat a document one is
    cut: the join has brought them together, so dropping the others shuffles nothing more."""
    per_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("first", "n", "hash")).alias("spans"))
    own = packed(docs.where("doc_id IS NOT NULL AND text IS NOT NULL"))
    joined = own.join(per_doc, "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text", "spans")

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in pieces(batch, max_bytes=BLOCK):
            seen: dict[tuple[int, bytes], int] = {}
            rows: list[list] = []
            places = set()
            for doc, text, spans in sorted(zip(*(c.to_pylist() for c in piece.columns)), key=lambda r: r[0]):
                opened = kind.opened(unpacked(text))
                for s in sorted(spans, key=lambda s: s["first"]):
                    place = (doc, s["first"])
                    if place in places:  # found once per row that repeats the doc_id
                        continue
                    places.add(place)
                    data = kind.cut(opened, s["first"], s["n"] + kind.length - 1)
                    at = seen.setdefault((s["hash"], data), len(rows))
                    if at == len(rows):
                        rows.append([s["hash"], doc, s["first"], s["n"], 1, data, None, None])
                    else:
                        rows[at][4] += 1
                        rows.append([s["hash"], doc, s["first"], s["n"], 0, None, rows[at][1], rows[at][2]])
            names = ("hash", "doc_id", "first", "n", "copies", "data", "of_doc", "of_first")
            yield dict(zip(names, map(list, zip(*rows)))) if rows else {c: [] for c in names}

    return map_batches(joined, cut, "hash BIGINT, doc_id BIGINT, first INT, n INT, copies INT, data BINARY, "
                                    "of_doc BIGINT, of_first INT")


def shards(stretches: DataFrame, kind: Kind, parts: int | None = None, hot: int = HOT) -> tuple[DataFrame, DataFrame | None]:
    """(shard, doc_id, first, n, copies, data): stretches with data, by the shard that all windows with
    the same anchor meet in, and (window, doc_id, first, copies): the places of the windows of hot
    anchors, None if there are no such anchors. There are as many shards as the stretches fill,
    so that a task's memory does not follow the input."""
    own = stretches.where("data IS NOT NULL")
    if parts is None:
        parts = 1 + (own.agg(F.sum(F.octet_length("data"))).first()[0] or 0) // SHARD
    crowded = materialize(own.groupBy("hash").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot).select(
        F.col("hash").alias("hot")), "repeats-hot")
    shard = F.pmod(F.hash("hash"), F.lit(parts)).alias("shard")
    columns = (shard, "doc_id", "first", "n", "copies", "data")
    if crowded.isEmpty():
        return own.select(*columns), None
    marked = own.join(crowded, F.col("hash") == F.col("hot"), "left")
    many = marked.where("hot IS NOT NULL").select("doc_id", "data", "first", "n", "copies")

    def alone(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in pieces(batch, max_bytes=BLOCK >> 3):
            rows = [(hashlib.blake2b(kind.part(data, i), digest_size=16).digest(), doc, first + i, copies)
                    for doc, data, first, n, copies in zip(*(c.to_pylist() for c in piece.columns)) for i in range(n)]
            yield dict(zip(("window", "doc_id", "first", "copies"), map(list, zip(*rows))))

    return marked.where("hot IS NULL").select(*columns), materialize(
        map_batches(many, alone, "window BINARY, doc_id BIGINT, first INT, copies INT"), "repeats-windows", "zstd")


def equal_windows(places: DataFrame) -> DataFrame:
    """(window, least): a row for each window at two places or more, and the first of them; partial
    sums merge equal windows before the shuffle."""
    return places.groupBy("window").agg(F.sum("copies").alias("c"), F.min(F.struct("doc_id", "first")).alias("least")).where(
        "c > 1").select("window", "least")


def repeated_alone(places: DataFrame, later: bool) -> DataFrame:
    """(doc_id, first, n): the places of windows that are at two places or more; only ``later`` ones, or
    all. A sort-merge join holds one row of a window at a time, and adaptive execution splits a
    partition in which a window's many places meet."""
    joined = places.join(equal_windows(places).hint("merge"), "window")
    if later:
        joined = joined.where(F.struct("doc_id", "first") > F.col("least"))
    return joined.select("doc_id", "first", F.lit(1).alias("n"))


def default_parts(docs: DataFrame, size: int | None = None) -> int:
    """As many parts as the texts' anchors fill, and no fewer than the session's shuffles have."""
    if size is None:
        size = text_rows(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1 + size // PART, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def told_apart(docs: DataFrame) -> tuple[DataFrame, DataFrame | None, int]:
    """(docs, names, bytes of text). A document is a doc_id with a text: rows that repeat both are one, rows
    with one doc_id and different texts are documents of their own, the least text hash first. If there
    are such rows, every document gets a dense number in that order in place of its doc_id, and ``names``
    (number, named) leads back; else ``docs`` stays as it is and ``names`` is None."""
    rows = text_rows(docs).withColumn("digest", F.xxhash64("text"))
    per = materialize(rows.groupBy("doc_id").agg(
        F.sum(F.octet_length("text")).alias("size"), (F.min("digest") != F.max("digest")).alias("differ")), "repeats-documents")
    size, differ = per.agg(F.sum("size"), F.max(F.col("differ") & F.col("doc_id").isNotNull())).first()
    if not differ:
        return docs, None, size or 0
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(rows.where("doc_id IS NOT NULL").select("doc_id", "digest").distinct()
                         .repartitionByRange(n, "doc_id", "digest").withColumn("p", F.spark_partition_id()), "repeats-ranges")
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offset = ranged.groupBy("p").agg(F.count(F.lit(1)).alias("c")).select("p", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("off"))
    local = Window.partitionBy("p").orderBy("doc_id", "digest")
    names = materialize(ranged.join(offset, "p").select(
        (F.col("off") + F.row_number().over(local)).cast("bigint").alias("number"), F.col("doc_id").alias("named"),
        F.col("digest").alias("of_digest")), "repeats-numbers")
    on = (F.col("doc_id") == F.col("named")) & (F.col("digest") == F.col("of_digest"))
    return (rows.join(names, on, "left").select(F.col("number").alias("doc_id"), "text"),
            names.select("number", "named"), size or 0)


def named(rows: DataFrame, names: DataFrame | None) -> DataFrame:
    """``rows`` under their own doc_id again."""
    if names is None:
        return rows
    columns = [F.col("named").alias("doc_id") if c == "doc_id" else F.col(c) for c in rows.columns]
    return rows.join(names, rows["doc_id"] == names["number"], "left").select(*columns)


def covered(windows: DataFrame) -> DataFrame:
    """(doc_id, spans): per document the found windows as (first, n) runs; a list no longer than its
    document."""
    return windows.groupBy(F.col("doc_id").alias("of_id")).agg(F.collect_list(F.struct("first", "n")).alias("spans"))


def with_spans(docs: DataFrame, windows: DataFrame, finish: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """``finish`` over (doc_id, packed text, spans), a row for each of ``docs``."""
    joined = packed(docs).join(covered(windows), F.col("doc_id") == F.col("of_id"), "left")
    return map_batches(joined.select("doc_id", "text", "spans"), finish, schema)


def coverage(spans: list[dict] | None, length: int, units: int) -> np.ndarray:
    """Which units the windows cover."""
    edge = np.zeros(units + 1, np.int64)
    if spans and units:
        first = np.array([s["first"] for s in spans])
        end = np.array([s["n"] for s in spans]) + first + length - 1
        np.add.at(edge, first, 1)
        np.add.at(edge, np.minimum(end, units), -1)
    return np.cumsum(edge[:-1]) > 0
