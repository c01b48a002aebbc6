"""Hard-negative mining: exact integer inner products of anchors with all rows, by
Kronecker-packed products.

Components become integers. The components of several candidates, biased so that none is
negative, are laid into separated fields of one wide integer; an anchor's component is multiplied
with that integer once, the products are added, and the fields of the sum are the candidates'
exact scores (less the bias times the sum of the anchor's components). The wide integer is a
double as long as every sum stays below 2^53, where doubles are exact integers and the products
of a block are one matrix product; the field width follows from the largest component and the
length. Larger components take whole Python integers of any width, with the same fields.

Anchors are dealt into blocks, all rows into slices; one task multiplies one block with one slice
and sends only its best rows per anchor (or per anchor and positive): two passes, the first finds
the positives, the second the negatives between their bounds. A running least score per anchor
keeps all but a few products from being looked at twice. What a task holds is bounded by
``BLOCK_ROWS``; labels don't decide where rows go, so a label with a third of all rows is no
hot group. The anchors are a stated query set; no rows are dropped and nothing is approximate.

Rows: every row is one of its own, also if it repeats a vec_id (a copy of the anchor's row is another
row with the anchor's id). Rows with a null vec_id, label or vector, or with a null or non-finite
component, take no part. An empty vector's products are 0; of vectors of different lengths the
missing components count as 0. Scores are longs; the job stops with a message where one would not
fit, or where floor(scale * x) is 2^53 or more. Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cofi.llm.common import map_batches
from cofi.session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95        # a negative's score in hundredths of the positive's
BLOCK_ROWS = 65_536       # rows of a block or slice
LEAST_ROWS = 2_048        # slices are not made smaller than this to occupy more cores
TILE = 512                # anchors multiplied at a time
FIRST, STEP = 512, 4_096  # candidates multiplied at a time, the first ones to find the least scores
WIDE_FIELDS = 8           # fields of an integer wider than a double


def layout(peak: int, dim: int) -> tuple[int, int, bool]:
    """(fields, width in bits, whether doubles hold them) for components up to ``peak`` in size."""
    bound = max(1, 2 * dim * peak * peak)  # the size of sum(a * (c + peak))
    width = bound.bit_length() + 1
    fields = 0
    while bound * sum(1 << width * f for f in range(fields + 1)) < 1 << 53:
        fields += 1
    return (fields, width, True) if fields else (WIDE_FIELDS, width, False)


class Packed:
    """Candidates' components (rows x dim) laid into fields: field f of integer g is row f * groups + g."""

    def __init__(self, rows: np.ndarray, peak: int, fields: int, width: int, doubles: bool):
        self.n, self.peak, self.fields, self.width, self.doubles = len(rows), peak, fields, width, doubles
        groups = -(-len(rows) // fields)
        biased = np.zeros((fields * groups, rows.shape[1]), np.float64 if doubles else object)
        biased[:len(rows)] = rows.astype(biased.dtype) + peak
        one = 1.0 if doubles else 1
        self.words = sum(biased[f * groups:(f + 1) * groups] * (one * (1 << width * f)) for f in range(fields)).T

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """anchors x rows: exact inner products, as doubles if these hold them, else as longs."""
        a = anchors.astype(np.float64 if self.doubles else object)
        total, shift = a @ self.words, (a.sum(1) * self.peak)[:, None]
        size, half = 1 << self.width, 1 << self.width - 1
        out = []
        for f in range(self.fields):
            if self.doubles:
                above = np.rint(total * (1.0 / size)) if f + 1 < self.fields else 0.0
                out.append(total - above * size - shift)
            else:
                above = (total + half) // size
                out.append(total - above * size - shift)
            total = above
        out = np.concatenate(out, axis=1)[:, :self.n]
        if self.doubles:
            return out
        if out.size and (out.max() >= 1 << 63 or out.min() < -(1 << 63)):
            raise OverflowError("an inner product does not fit in 64 bits")
        return out.astype(np.int64)


class Best:
    """The ``keep`` best (score desc, id asc) rows per key, fed in parts."""

    def __init__(self, n_keys: int, keep: int):
        self.keep = keep
        self.floor = np.full(n_keys, -np.inf)  # the last kept score of a full key: lower ones can't enter
        self.held = [np.zeros(0, np.int64) for _ in range(4)]

    def add(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        key, score, vec, row = (np.concatenate([h, x.astype(np.int64)]) for h, x in zip(self.held, (keys, scores, ids, rows)))
        order = np.lexsort((row, vec, -score, key))
        key = key[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
        rank = np.arange(len(key)) - np.repeat(start, np.diff(np.concatenate([start, [len(key)]])))
        order, key = order[rank < self.keep], key[rank < self.keep]
        self.held = [key, score[order], vec[order], row[order]]
        last = rank[rank < self.keep] == self.keep - 1
        self.floor[key[last]] = self.held[1][last]


def components(values: list[bytes], dims: np.ndarray, dim: int) -> np.ndarray:
    """rows x dim: the written components, zeros where a vector is shorter."""
    out = np.zeros((len(values), dim), np.int64)
    sizes = np.array([len(v) for v in values])
    for n, size in set(zip(dims.tolist(), sizes.tolist())):
        if n:
            at = np.flatnonzero((dims == n) & (sizes == size))
            data = b"".join(values[i] for i in at)
            out[at, :n] = np.frombuffer(data, np.int32 if size == 4 * n else np.int64).reshape(len(at), n)
    return out


def prepared(table: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """(row_id, vec_id, label, dim, peak, parts) of the rows that take part, written once; ``parts`` holds
    floor(scale * x) of each component as 32-bit integers, or as 64-bit ones where a component needs it."""
    kind = table.schema["embedding"].dataType.simpleString()
    source = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
                          (F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")).alias("embedding"))
    source = source.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            values = part.column(3)
            sizes = np.asarray(pa.compute.list_value_length(values))
            flat = values.flatten()
            x = np.asarray(flat.fill_null(float("nan"))).astype(np.float64) if len(flat) else np.zeros(0)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            ends = np.cumsum(sizes)
            good = np.flatnonzero(bad[ends] == bad[ends - sizes])
            q = np.floor(np.where(np.isfinite(x), x, 0.0) * scale)
            parts, peaks = [], []
            for i in good:
                row = q[ends[i] - sizes[i]:ends[i]]
                peak = float(np.abs(row).max()) if len(row) else 0.0
                if peak >= 1 << 53:
                    raise OverflowError(f"floor({scale} * x) = {peak} is not exact in double precision")
                parts.append(row.astype(np.int32 if peak < 1 << 31 else np.int64).tobytes())
                peaks.append(int(peak))
            take = pa.array(good)
            yield {"row_id": part.column(0).take(take), "vec_id": part.column(1).take(take),
                   "label": part.column(2).take(take), "dim": sizes[good].astype(np.int32), "peak": pa.array(peaks, pa.int64()),
                   "parts": parts}

    numbered = source.select(F.monotonically_increasing_id().alias("row_id"), "vec_id", "label", "embedding")
    return materialize(map_batches(numbered, work, "row_id BIGINT, vec_id BIGINT, label BIGINT, dim INT, peak BIGINT, parts BINARY"),
                       "integer_vectors")


def _crossed(anchors: DataFrame, rows: DataFrame, n_blocks: int, n_slices: int, work, schema: str) -> DataFrame:
    """``work(anchors, rows)`` on every block of anchors with every slice of rows."""
    deal = lambda n: F.pmod(F.xxhash64("row_id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("block", deal(n_blocks)).withColumn("slice", each(n_slices))
    right = rows.withColumn("slice", deal(n_slices)).withColumn("block", each(n_blocks))
    return (left.toDF(*left.columns).groupBy("block", "slice")
            .cogroup(right.toDF(*right.columns).groupBy("block", "slice")).applyInArrow(work, schema))


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from ``prepared`` rows;
    ``is_anchor`` names the anchors among them."""
    spark = rows.sparkSession
    n, n_anchors, peak, dim = rows.agg(F.count(F.lit(1)), F.count(F.when(is_anchor, 1)), F.max("peak"), F.max("dim")).first()
    peak, dim = int(peak or 0), max(1, int(dim or 0))
    fields, width, doubles = layout(peak, dim)
    n_blocks = max(1, math.ceil(n_anchors / BLOCK_ROWS))
    n_slices = max(1, math.ceil(n / BLOCK_ROWS), min(spark.sparkContext.defaultParallelism, math.ceil(n / LEAST_ROWS)))
    anchors = rows.where(is_anchor).select("row_id", "vec_id", "label", "dim", "parts")
    columns = rows.select("row_id", "vec_id", "label", "dim", "parts")
    number = lambda t, c: np.asarray(t.column(c).combine_chunks()).astype(np.int64)
    parts = lambda t: components(t.column("parts").to_pylist(), number(t, "dim"), dim)

    def tiles(left: pa.Table, right: pa.Table):
        """(anchor numbers, candidate numbers, scores) of each tile."""
        a, c = parts(left), parts(right)
        at = 0
        while at < len(c):
            step = FIRST if at == 0 else STEP
            packed = Packed(c[at:at + step], peak, fields, width, doubles)
            for start in range(0, len(a), TILE):
                yield start, at, packed.scores(a[start:start + TILE])
            at += step

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        """The best other rows of the anchor's label in this slice."""
        best = Best(left.num_rows, positives)
        row, label = number(left, "row_id"), number(left, "label")
        c_row, c_id, c_label = (number(right, c) for c in ("row_id", "vec_id", "label"))
        for start, at, score in tiles(left, right):
            i, j = np.nonzero(score >= best.floor[start:start + len(score), None])
            value = score[i, j]
            i, j = i + start, j + at
            fit = (label[i] == c_label[j]) & (row[i] != c_row[j])
            best.add(i[fit], value[fit], c_id[j[fit]], c_row[j[fit]])
        key, value, vec, other = best.held
        return pa.table({"anchor": row[key], "positive_id": vec, "positive_row": other, "positive_score": value})

    def between(left: pa.Table, right: pa.Table) -> pa.Table:
        """The best rows of other labels between the bounds of each positive, in this slice."""
        m = positives
        row, label = number(left, "row_id"), number(left, "label")
        c_row, c_id, c_label = (number(right, c) for c in ("row_id", "vec_id", "label"))
        lists = left.column("scores").to_pylist()
        least = np.full((left.num_rows, m), np.inf)
        most = np.full((left.num_rows, m), -np.inf)
        for i, scores in enumerate(lists):
            for p, s in enumerate(scores):  # low * s <= 100 * negative <= high * s, in whole numbers
                least[i, p], most[i, p] = -(-low * s // 100), high * s // 100
        best = Best(left.num_rows * m, negatives)
        for start, at, score in tiles(left, right):
            end = start + len(score)
            floor = np.maximum(least[start:end], best.floor.reshape(-1, m)[start:end])
            i, j = np.nonzero((score >= floor.min(1)[:, None]) & (score <= most[start:end].max(1)[:, None]))
            value = score[i, j]
            fit = label[i + start] != c_label[j + at]
            i, j, value = i[fit], j[fit], value[fit]
            k, p = np.nonzero((value[:, None] >= floor[i]) & (value[:, None] <= most[start:end][i]))
            best.add((i[k] + start) * m + p, value[k], c_id[j[k] + at], c_row[j[k] + at])
        key, value, vec, other = best.held
        return pa.table({"anchor": row[key // m], "place": key % m, "negative_id": vec, "negative_row": other, "negative_score": value})

    found = _crossed(anchors, columns, n_blocks, n_slices, nearest,
                     "anchor BIGINT, positive_id BIGINT, positive_row BIGINT, positive_score BIGINT")
    order = Window.partitionBy("anchor").orderBy(F.col("positive_score").desc(), "positive_id", "positive_row")
    chosen = materialize(found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < positives), "positives")
    lists = chosen.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))),
                                                     lambda s: s["positive_score"]).alias("scores"))
    asked = anchors.join(lists.withColumnRenamed("anchor", "row_id"), "row_id")
    found = _crossed(asked, columns, n_blocks, n_slices, between,
                     "anchor BIGINT, place BIGINT, negative_id BIGINT, negative_row BIGINT, negative_score BIGINT")
    order = Window.partitionBy("anchor", "place").orderBy(F.col("negative_score").desc(), "negative_id", "negative_row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    names = anchors.select(F.col("row_id").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (ranked.join(chosen.select("anchor", F.col("place").cast("bigint").alias("place"), "positive_id", "positive_score"), ["anchor", "place"])
            .join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def shifted_label(every: int = 7, labels: int = 10) -> Column:
    """The label, moved on by one where vec_id is divisible by ``every``."""
    label = F.col("label").cast("bigint")
    return F.when(F.col("vec_id") % every == 0, (label + 1) % labels).otherwise(label)


def registered(table: DataFrame) -> DataFrame:
    """The registered query: anchors are the rows whose vec_id is divisible by 50."""
    return hard_negatives(prepared(table, shifted_label()), F.col("vec_id") % 50 == 0)


def oracle_sql() -> str:
    return f"""
WITH given AS (
  SELECT row_number() OVER () AS row_id, vec_id, embedding,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
clean AS (
  SELECT row_id, vec_id, label, list_transform(embedding, lambda x: floor({SCALE}::DOUBLE * x::DOUBLE)) AS q FROM given
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.row_id AS anchor, a.vec_id AS anchor_id, c.row_id AS other, c.vec_id, a.label = c.label AS same,
         list_inner_product(a.q, c.q)::BIGINT AS score
  FROM clean a JOIN clean c ON a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, other) AS place
                 FROM scored WHERE same AND anchor <> other) WHERE place <= {POSITIVES}),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id, n.other) AS rank
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
   AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= {NEGATIVES}"""
