"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, multiprobe
buckets, verified candidate pairs.

A table of the index has ``depth`` rotations (three rounds of random signs and a fast
Hadamard transform each); the nearest axis of each rotation, sign included, names the bucket.
A vector is entered in its ``PROBES`` best buckets of every table, so two vectors meet if any
of their best buckets agree. ``depth`` follows the number of rows (a bucket holds a few
unrelated vectors at any size) and the number of tables follows from both: seeded pairs at
exactly the least cosine are hashed, and tables are added until such a pair is missed with a
chance of at most ``MISS``. Pairs that meet are first compared by 128 sign bits (a linked pair
fails that with a chance under 1e-6) and then by their cosine in double precision.

Dense buckets are not compared pair by pair. In a bucket with over ``DENSE`` vectors those
within half the linking angle of the bucket's mean form a *ball*: any two of them are linked, so
the ball is one item with a centre, a radius and a size. Items are compared by their centres: if
centre distance plus radii stay within the linking angle, all members are linked, and if the
distance less the radii exceeds it, none is. Only what lies between is compared member by member,
in blocks of ``BLOCK`` x ``BLOCK``. So a group of copies costs its size, not its square, and no link
inside it is left out. There are no caps: a bucket that no ball thins is compared whole, by a
join that adaptive execution splits.

Rows: every row is a vector of its own, also if it repeats a vec_id or has none. Vectors that are
null, empty, zero or hold null or non-finite components link with nothing; so do vectors of
different lengths. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofi.llm.common import map_batches
from cofi.llm.components import components
from cofi.session import materialize

COSINE = 0.9
PROBES = 4        # buckets a vector is entered in, per table
MISS = 0.005      # chance that a pair at exactly the least cosine meets in no table
DENSE = 64        # vectors of a bucket from which balls are formed
ROUNDS = 3        # tables whose buckets are tried for balls, one after the other
BLOCK = 512       # members compared at a time
SEED = 20
TRIALS = 4000     # seeded pairs from which the number of tables follows
SLACK = 1e-7      # radians kept from every bound on angles, above rounding error
SIGN_BITS = 128


def padded(dim: int) -> int:
    """The power of two that vectors are padded to; 64 at least, so that short ones are mixed too."""
    return max(64, 1 << (dim - 1).bit_length())


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalized fast Walsh-Hadamard transform of each row."""
    rows, n = x.shape
    step = 1
    while step < n:
        y = x.reshape(rows, n // (2 * step), 2, step)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(rows, n)
        step *= 2
    return x / math.sqrt(n)


@lru_cache(maxsize=1024)
def signs(number: int, width: int) -> np.ndarray:
    """Three rows of random signs of rotation ``number``."""
    return np.random.default_rng([SEED, number, width]).choice(np.array([-1.0, 1.0]), size=(3, width))


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    for row in signs(number, x.shape[1]):
        x = hadamard(x * row)
    return x


def buckets(x: np.ndarray, table: int, depth: int) -> np.ndarray:
    """(rows, PROBES) bucket codes of one table, best first. A bucket's loss is the sum over its
    rotations of (largest coordinate - chosen coordinate)^2."""
    width = x.shape[1]
    codes = np.zeros((len(x), 1), np.int64)
    losses = np.zeros((len(x), 1))
    for j in range(depth):
        y = rotated(x, 1 + table * 64 + j)
        best = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :PROBES]
        value = np.take_along_axis(y, best, 1)
        axis = best.astype(np.int64) * 2 + (value < 0)
        loss = (np.abs(value[:, :1]) - np.abs(value)) ** 2
        codes = (codes[:, :, None] * (2 * width) + axis[:, None, :]).reshape(len(x), -1)
        losses = (losses[:, :, None] + loss[:, None, :]).reshape(len(x), -1)
        keep = np.argsort(losses, axis=1, kind="stable")[:, :PROBES]
        codes, losses = np.take_along_axis(codes, keep, 1), np.take_along_axis(losses, keep, 1)
    return codes


def sign_bits(x: np.ndarray) -> np.ndarray:
    """(rows, 2) int64: 128 signs of rotated coordinates."""
    width = x.shape[1]
    turns = -(-SIGN_BITS // width)
    bits = np.concatenate([rotated(x, -1 - t & 0xFFFFFFFF) for t in range(turns)], axis=1)[:, :SIGN_BITS] > 0
    return np.packbits(bits, axis=1).view("<i8")


def sign_bound(cosine: float) -> int:
    """The least number of differing sign bits that a pair at ``cosine`` exceeds with a chance
    under 1e-6, if bits differ independently with the chance angle / pi."""
    p = math.acos(cosine) / math.pi
    tail, n = 1.0, -1
    while tail > 1e-6:
        n += 1
        tail -= math.comb(SIGN_BITS, n) * p ** n * (1 - p) ** (SIGN_BITS - n)
    return n


def depth_for(rows: int, width: int) -> int:
    """Rotations per table: the least number for which a bucket holds four unrelated vectors at most."""
    depth = 1
    while rows > 4 * (2 * width) ** depth and (2 * width) ** (depth + 1) < 1 << 44:
        depth += 1
    return depth


@lru_cache(maxsize=64)
def tables_for(dim: int, depth: int, cosine: float) -> int:
    """Tables until ``TRIALS`` seeded pairs at ``cosine`` give a miss of at most ``MISS``: the share
    of pairs that meet is measured on four tables, the rest follows as tables are independent."""
    rng = np.random.default_rng([SEED, dim, depth])
    a = rng.normal(size=(TRIALS, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(TRIALS, dim))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
    b = cosine * a + math.sqrt(1 - cosine * cosine) * b
    fill = ((0, 0), (0, padded(dim) - dim))
    a, b = np.pad(a, fill), np.pad(b, fill)
    met = np.mean([(buckets(a, t, depth)[:, :, None] == buckets(b, t, depth)[:, None, :]).any((1, 2)).mean()
                   for t in range(4)])
    return max(2, math.ceil(math.log(MISS) / math.log(max(1e-9, 1 - min(met, 0.999)))))


def vectors_of(values: pa.Array, kind) -> list[tuple[np.ndarray, np.ndarray]]:
    """[(positions, matrix)] of the linkable vectors of a list column, one matrix per length: those that
    are not null, empty or zero and hold no null and no non-finite component."""
    flat = values.flatten()
    sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(values), 0))
    data = np.asarray(flat.fill_null(float("nan")) if flat.null_count else flat).astype(kind, copy=False)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    out = []
    for size in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == size)
        x = data[starts[at][:, None] + np.arange(size)]
        good = np.isfinite(x).all(1) & (x != 0).any(1)
        if good.any():
            out.append((at[good], x[good]))
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that no square over- or underflows."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def matrix(values: pa.Array, kind) -> np.ndarray:
    """Unit vectors from the bytes of vectors of one length, whose numbers are of ``kind``."""
    return unit(np.frombuffer(b"".join(values.to_pylist()), kind).reshape(len(values), -1))


def _packed(x: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in x]


def number_kind(table: DataFrame):
    """The NumPy type that holds the embedding's numbers as they are: float for floats, else double."""
    return np.float32 if "float" in table.schema["embedding"].dataType.simpleString() else np.float64


def signatures(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(row_id, vec_id, dim, vec, homes, codes, bits0, bits1) of every row, written once; only
    (row_id, vec_id) for vectors that link with nothing."""
    source = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding"))
    kind = number_kind(source)
    if kind is np.float64:
        source = source.withColumn("embedding", F.col("embedding").cast("array<double>"))
    row = source.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    rows, dim = row[0], max(1, row[1] or 1)
    depth = depth_for(rows, padded(dim))
    n_tables = tables_for(dim, depth, cosine)

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            n = part.num_rows
            done = np.zeros(n, bool)
            for at, x in vectors_of(part.column(2), kind):
                done[at] = True
                u = np.pad(unit(x), ((0, 0), (0, padded(x.shape[1]) - x.shape[1])))
                mix = np.int64(x.shape[1]) << np.int64(52)  # lengths never share a bucket
                per = [buckets(u, t, depth) for t in range(n_tables)]
                codes = np.concatenate([(c * n_tables + t) ^ mix for t, c in enumerate(per)], axis=1)
                bits = sign_bits(u)
                take = pa.array(at)
                yield {"row_id": part.column(0).take(take), "vec_id": part.column(1).take(take),
                       "dim": np.full(len(at), x.shape[1], np.int32), "vec": _packed(x),
                       "homes": list(codes[:, ::PROBES][:, :ROUNDS]),
                       "codes": list(codes), "bits0": bits[:, 0].copy(), "bits1": bits[:, 1].copy()}
            rest = pa.array(np.flatnonzero(~done))
            if len(rest):
                none = pa.nulls(len(rest))
                yield {"row_id": part.column(0).take(rest), "vec_id": part.column(1).take(rest)} | {
                    c: none.cast(t) for c, t in (("dim", pa.int32()), ("vec", pa.binary()), ("homes", pa.list_(pa.int64())),
                                                 ("codes", pa.list_(pa.int64())), ("bits0", pa.int64()), ("bits1", pa.int64()))}

    numbered = source.select(F.monotonically_increasing_id().alias("row_id"), "vec_id", "embedding")
    return materialize(map_batches(
        numbered, work, "row_id BIGINT, vec_id BIGINT, dim INT, vec BINARY, homes ARRAY<BIGINT>, codes ARRAY<BIGINT>, "
        "bits0 BIGINT, bits1 BIGINT"), "vectors")


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Angles between unit rows, exact to about 1e-15 near 0 too (an arc cosine is not)."""
    return 2 * np.arctan2(np.linalg.norm(a - b, axis=1), np.linalg.norm(a + b, axis=1))


def balls(vectors: DataFrame, cosine: float, kind) -> DataFrame:
    """(row_id, ball, dim, angle, centre): the members of the balls of dense buckets, written. A
    bucket's members are dealt into blocks of about ``BLOCK``; each block sends one sum to the mean."""
    limit = math.acos(cosine) / 2 - SLACK
    spark = vectors.sparkSession
    left = vectors.where("vec IS NOT NULL").select("row_id", "dim", "vec", "homes")
    number = "FLOAT" if kind is np.float32 else "DOUBLE"
    cell = ["cell", "dim"]
    found: list[DataFrame] = []

    def total(key: tuple, group: pa.Table) -> pa.Table:
        x = matrix(group.column("vec"), kind).sum(0)
        n = len(x)
        return pa.table({"cell": pa.array([key[0].as_py()] * n, pa.int64()), "dim": pa.array([n] * n, pa.int32()),
                         "at": pa.array(np.arange(n), pa.int32()), "total": pa.array(x)})

    def within(batch: pa.RecordBatch) -> Iterator[dict]:
        dims = np.asarray(batch.column(2))
        for dim in np.unique(dims):
            part = batch.take(pa.array(np.flatnonzero(dims == dim)))
            flat = part.column(4).flatten().to_numpy(zero_copy_only=False).astype(kind)
            angle = _angles(matrix(part.column(3), kind), unit(flat.reshape(part.num_rows, -1)))
            near = np.flatnonzero(angle <= limit)
            take = pa.array(near)
            yield {"row_id": part.column(0).take(take), "ball": part.column(1).take(take), "dim": part.column(2).take(take),
                   "angle": angle[near], "centre": part.column(4).take(take)}

    for r in range(ROUNDS):
        rest = left.select("row_id", "dim", "vec", F.try_element_at("homes", F.lit(r + 1)).alias("cell")).where("cell IS NOT NULL")
        for f in found:
            rest = rest.join(f.select("row_id"), "row_id", "left_anti")
        dense = materialize(rest.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > DENSE)
                            .withColumn("n_blocks", F.ceil(F.col("n") / BLOCK).cast("int")), "dense_cells")
        if dense.isEmpty():
            continue
        block = F.pmod(F.xxhash64("row_id"), F.col("n_blocks")).cast("int")
        members = materialize(rest.join(dense, cell).select(*cell, block.alias("block"), "row_id", "vec"), "dense")
        sums = members.groupBy(*cell, "block").applyInArrow(total, "cell BIGINT, dim INT, at INT, total DOUBLE")
        mean = F.transform(F.array_sort(F.collect_list(F.struct("at", "total"))), lambda s: s["total"].cast(number))
        # one row per coordinate: a list holds the coordinates of one centre
        centre = (sums.groupBy(*cell, "at").agg(F.sum("total").alias("total")).groupBy(*cell).agg(mean.alias("centre"))
                  .where(F.exists("centre", lambda c: F.abs(c) > 1e-6)))
        blocks = dense.join(centre, cell).select(*cell, "centre", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"))
        near = map_batches(members.join(blocks, [*cell, "block"]).select("row_id", "cell", "dim", "vec", "centre"), within,
                           f"row_id BIGINT, ball BIGINT, dim INT, angle DOUBLE, centre ARRAY<{number}>")
        found.append(materialize(near, "balls"))
    out = spark.createDataFrame([], f"row_id BIGINT, ball BIGINT, dim INT, angle DOUBLE, centre ARRAY<{number}>")
    for f in found:
        out = out.unionAll(f)
    return out


def _pairs(vectors: DataFrame, members: DataFrame, cosine: float) -> DataFrame:
    """(a, b): distinct pairs of items, a < b, that share a bucket, vectors of one item each
    pre-filtered by sign bits."""
    entry = vectors.where("vec IS NOT NULL")
    single = (entry.join(members.select("row_id"), "row_id", "left_anti")
              .select(F.explode("codes").alias("code"), F.col("row_id").alias("item"), "bits0", "bits1"))
    none = F.lit(None).cast("bigint")
    of_ball = (entry.select("row_id", "codes").join(members.select("row_id", "item"), "row_id")
               .select(F.explode("codes").alias("code"), "item").distinct().select("code", "item", none.alias("bits0"), none.alias("bits1")))
    entries = single.unionAll(of_ball)
    x, y = (entries.select("code", *[F.col(c).alias(f"{c}_{s}") for c in ("item", "bits0", "bits1")]) for s in "xy")
    differ = F.bit_count(F.col("bits0_x").bitwiseXOR(F.col("bits0_y"))) + F.bit_count(F.col("bits1_x").bitwiseXOR(F.col("bits1_y")))
    return (x.join(y, "code").where((F.col("item_x") < F.col("item_y")) & (F.coalesce(differ, F.lit(0)) <= sign_bound(cosine)))
            .select(F.col("item_x").alias("a"), F.col("item_y").alias("b")).distinct())


def _verdicts(pairs: DataFrame, items: DataFrame, cosine: float, kind) -> DataFrame:
    """(a, b, n_a, n_b, verdict): 1 all members of the two items are linked, 0 open; pairs of which
    none is linked are left out."""
    angle = math.acos(cosine)
    side = lambda s: items.select(F.col("item").alias(s), F.col("vec").alias(f"v_{s}"),
                                  F.col("radius").alias(f"r_{s}"), F.col("n").alias(f"n_{s}"))

    def judge(batch: pa.RecordBatch) -> Iterator[dict]:
        r = np.asarray(batch.column(4)) + np.asarray(batch.column(5))
        sizes, others = (np.asarray(pa.compute.binary_length(batch.column(c))) for c in (2, 3))
        verdict = np.full(batch.num_rows, -1)
        for size in np.unique(sizes[sizes == others]):
            at = np.flatnonzero((sizes == size) & (others == size))
            take = pa.array(at)
            x, y = matrix(batch.column(2).take(take), kind), matrix(batch.column(3).take(take), kind)
            apart = _angles(x, y)
            verdict[at] = np.where(r[at] == 0, np.where((x * y).sum(1) >= cosine, 1, -1),
                                   np.where(apart + r[at] <= angle - SLACK, 1, np.where(apart - r[at] > angle + SLACK, -1, 0)))
        take = pa.array(np.flatnonzero(verdict >= 0))
        yield {"a": batch.column(0).take(take), "b": batch.column(1).take(take), "n_a": batch.column(6).take(take),
               "n_b": batch.column(7).take(take), "verdict": verdict[verdict >= 0].astype(np.int32)}

    both = (pairs.join(side("a"), "a").join(side("b"), "b")
            .select("a", "b", "v_a", "v_b", "r_a", "r_b", "n_a", "n_b"))
    return materialize(map_batches(both, judge, "a BIGINT, b BIGINT, n_a BIGINT, n_b BIGINT, verdict INT"), "verdicts")


def _open_links(verdicts: DataFrame, rows: DataFrame, cosine: float, kind) -> DataFrame:
    """(row_id, n, a, b): the links of single vectors in pairs of items that the centres leave open.
    The larger item is cut into blocks of members, the members of all its open partners into blocks of
    queries; one task compares one block with one."""
    flip = F.col("n_a") > F.col("n_b")
    asked = (verdicts.where("verdict = 0")
             .select(F.when(flip, F.col("b")).otherwise(F.col("a")).alias("ask"),
                     F.when(flip, F.col("a")).otherwise(F.col("b")).alias("whole"),
                     F.least("n_a", "n_b").alias("n_ask"), F.greatest("n_a", "n_b").alias("n_whole")))
    # Partners are numbered by the place of their first member, so that blocks of queries are full.
    load = asked.groupBy("whole").agg(F.sum("n_ask").alias("load"), F.max("n_whole").alias("n_whole"))
    plan = materialize(load.select("whole", F.ceil(F.col("load") / BLOCK).cast("int").alias("q_blocks"),
                                   F.ceil(F.col("n_whole") / BLOCK).cast("int").alias("m_blocks")), "open_plan")
    deal = lambda n: F.pmod(F.xxhash64("row_id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    queries = (asked.select("ask", "whole").join(rows.withColumnRenamed("item", "ask"), "ask").join(plan, "whole")
               .select("whole", "ask", "row_id", "vec", deal("q_blocks").alias("q"), each("m_blocks").alias("m"))
               .toDF("whole", "ask", "row_id", "vec", "q", "m"))
    held = (rows.withColumnRenamed("item", "whole").join(plan, "whole")
            .select("whole", "row_id", "vec", deal("m_blocks").alias("m"), each("q_blocks").alias("q"))
            .toDF("whole", "row_id", "vec", "m", "q"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("row_id", "n", "a", "b")
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        linked = matrix(left.column("vec"), kind) @ matrix(right.column("vec"), kind).T >= cosine
        n_left, n_right = linked.sum(1), linked.sum(0)
        ask, whole = np.asarray(left.column("ask")), left.column("whole")[0].as_py()
        at, to = np.flatnonzero(n_left), np.flatnonzero(n_right)
        return pa.table({"row_id": np.concatenate([np.asarray(left.column("row_id"))[at], np.asarray(right.column("row_id"))[to]]),
                         "n": np.concatenate([n_left[at], n_right[to]]).astype(np.int64),
                         "a": np.concatenate([ask[at], np.full(len(to), whole)]).astype(np.int64),
                         "b": np.full(len(at) + len(to), whole, np.int64)})

    return materialize(queries.groupBy("whole", "m", "q").cogroup(held.groupBy("whole", "m", "q"))
                       .applyInArrow(compare, "row_id BIGINT, n BIGINT, a BIGINT, b BIGINT"), "open_links")


def near_duplicates(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``table`` (vec_id, embedding)."""
    kind = number_kind(table)
    vectors = signatures(table, cosine)
    found = balls(vectors, cosine, kind)
    meta = materialize(found.groupBy("ball", "dim").agg(
        F.min("row_id").alias("item"), F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"),
        F.first("centre").alias("centre")), "ball_items")
    members = materialize(found.select("row_id", "ball", "dim").join(meta.select("ball", "dim", "item", "n"), ["ball", "dim"])
                          .select("row_id", "item", "n"), "members")

    def packed(batch: pa.RecordBatch) -> Iterator[dict]:
        yield {"item": batch.column(0), "n": batch.column(1), "radius": batch.column(2),
               "vec": [np.array(c, kind).tobytes() for c in batch.column(3).to_pylist()]}

    one = vectors.where("vec IS NOT NULL").join(members.select("row_id"), "row_id", "left_anti")
    centres = map_batches(meta.select("item", "n", (F.col("radius") + SLACK).alias("radius"), "centre"), packed,
                          "item BIGINT, n BIGINT, radius DOUBLE, vec BINARY")
    items = one.select(F.col("row_id").alias("item"), F.lit(1).cast("bigint").alias("n"), F.lit(0.0).alias("radius"), "vec").unionAll(centres)
    verdicts = _verdicts(_pairs(vectors, members, cosine), items, cosine, kind)
    rows = vectors.where("vec IS NOT NULL").select("row_id", "vec").join(members.select("row_id", "item"), "row_id", "left").select(
        "row_id", "vec", F.coalesce("item", "row_id").alias("item"))
    open_links = _open_links(verdicts, rows, cosine, kind)

    sure = verdicts.where("verdict = 1")
    whole = (sure.select(F.col("a").alias("item"), F.col("n_b").alias("n")).unionAll(sure.select("b", "n_a"))
             .groupBy("item").agg(F.sum("n").alias("n_item")))
    single = open_links.groupBy("row_id").agg(F.sum("n").alias("n_row"))
    roots = components(sure.select("a", "b").unionAll(open_links.where("a <> b").select("a", "b").distinct()))
    state = (vectors.select("row_id", "vec_id").join(members, "row_id", "left")
             .select("row_id", "vec_id", F.coalesce("item", "row_id").alias("item"), (F.coalesce("n", F.lit(1)) - 1).alias("n_ball"))
             .join(whole, "item", "left").join(single, "row_id", "left").join(roots.withColumnRenamed("node", "item"), "item", "left")
             .select("vec_id", F.coalesce("root", "item").alias("root"),
                     (F.col("n_ball") + F.coalesce("n_item", F.lit(0)) + F.coalesce("n_row", F.lit(0))).alias("n_links")))
    state = materialize(state, "vector_links")
    least = state.where("n_links > 0").groupBy("root").agg(F.min("vec_id").alias("least"))
    return state.join(least, "root", "left").select(
        "vec_id", "n_links", F.coalesce("least", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("least", "vec_id"), F.lit(False)).alias("kept"))


def oracle_sql() -> str:
    """Every pair compared, and components by the smallest vec_id reached."""
    return f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS row_id, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (
  SELECT *, sqrt(list_inner_product(v, v)) AS norm FROM rows
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.row_id AS a, b.row_id AS b FROM usable a JOIN usable b ON a.row_id <> b.row_id AND len(a.v) = len(b.v)
  WHERE a.norm > 0 AND b.norm > 0 AND list_inner_product(a.v, b.v) / (a.norm * b.norm) >= {COSINE}),
reach AS (SELECT row_id AS a, row_id AS b FROM rows UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
component AS (SELECT r.a, min(x.vec_id) AS component_id FROM reach r JOIN rows x ON x.row_id = r.b GROUP BY r.a),
degree AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM rows JOIN component c ON c.a = rows.row_id LEFT JOIN degree d ON d.a = rows.row_id"""
