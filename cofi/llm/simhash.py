"""SimHash near-duplicates by the generalised pigeonhole principle (operator 3).

1. Every whole text becomes a 64-bit fingerprint; equal fingerprints collapse to one.
2. Bits that vary together are put into the same of ``m`` partitions (a 64 x 64 table of
   counts over all fingerprints), so that the partitions are nearly independent.
3. Two fingerprints within ``distance`` bits have, for thresholds t_1..t_m (each -1 or
   more) with sum(t_i + 1) = distance + 1, a partition i that differs in at most t_i bits.
   Each fingerprint gets its own thresholds: dynamic programming over the partitions on
   the estimated number of candidates, from the exact count of its value in each
   partition. A value that very many fingerprints share is thus passed over (t_i = -1).
4. Each fingerprint probes the values within t_i of its own; candidates are verified by
   their bit distance.
5. Where even the best thresholds promise over ``dense`` candidates (thousands of nearly
   equal fingerprints), those fingerprints are linked through centres instead of in pairs:
   two fingerprints are within 2r bits exactly if some 64-bit value is within r bits of
   both, so each one names the values within r and takes the smallest fingerprint that
   names the same. Every link inside such a group keeps its effect, no pair is formed.
   For an odd distance the pairs with one more bit than 2r are found by centres of which
   one side takes r + 1 bits.
6. Components of the links.

Defined cases: null texts, and texts without words, have fingerprint zero and are linked like
any other; repeated rows get a row each; ties need no rule (the smallest doc_id names a
component); rows without a doc_id take part and never name a component that has a doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofi.llm.common import map_batches, pieces, text_rows
from cofi.llm.components import components
from cofi.session import materialize

BITS = 64
WORDS = 3         # words of a shingle
SEED = 42
DISTANCE = 2      # bits two linked fingerprints may differ in
DENSE = 64        # estimated candidates of one fingerprint beyond which centres link it
PROBE_COST = 0.5  # of looking up one value, in candidates verified

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text, as a signed 64-bit number."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()  # both ASCII only, as the rule says
    if not words:
        return 0
    if len(words) < WORDS:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        n = len(words) - WORDS + 1
        shingles = map(b" ".join, zip(*[words[i:] for i in range(WORDS)]))
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    at = h.view(np.uint8).reshape(n, 8).astype(np.int64) + np.arange(0, 2048, 256)
    counts = np.einsum("bv,vk->bk", np.bincount(at.ravel(), minlength=2048).reshape(8, 256), _BYTE_BITS)
    return int(np.packbits(2 * counts.ravel() > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp BIGINT) per row of ``docs``."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in pieces(batch):
            yield {"doc_id": part.column(0), "fp": [fingerprint(t) for t in part.column(1).to_pylist()]}

    return map_batches(text_rows(docs), run, "doc_id BIGINT, fp BIGINT")


def bit_counts(fps: DataFrame) -> np.ndarray:
    """[i][j]: fingerprints with bits i and j set, over all of ``fps``: 4096 numbers."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        x = np.unpackbits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8),
                          axis=1, bitorder="little").astype(np.float64)
        yield {"i": np.arange(BITS * BITS), "n": (x.T @ x).astype(np.int64).ravel()}

    rows = map_batches(fps.select("fp"), run, "i INT, n BIGINT").groupBy("i").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BITS * BITS)
    for r in rows:
        out[r.i] = r.n
    return out.reshape(BITS, BITS)


def bit_partitions(counts: np.ndarray, total: int, m: int) -> list[list[int]]:
    """``m`` lists of bits of nearly equal length; each list is grown from its first bit by
    the free bit with the highest mean correlation to it."""
    p = counts / max(total, 1)
    var = np.diag(p) * (1 - np.diag(p))
    corr = np.abs(p - np.outer(np.diag(p), np.diag(p))) / np.sqrt(np.maximum(np.outer(var, var), 1e-12))
    free, out = list(range(BITS)), []
    for size in (len(x) for x in np.array_split(np.arange(BITS), m)):
        group = [free.pop(0)]
        while len(group) < size:
            best = max(free, key=lambda b: (corr[b, group].mean(), -b))
            free.remove(best)
            group.append(best)
        out.append(sorted(group))
    return out


def choose_parts(total: int, distance: int) -> int:
    """How many partitions promise the least work per fingerprint, if values were uniform."""
    def work(m: int) -> float:
        width, base, more = BITS // m, *divmod(distance + 1, m)
        ball = lambda t: sum(comb(width, k) for k in range(t + 1))
        probes = sum(ball(base - 1 + (i < more)) for i in range(m))
        return probes * (PROBE_COST + total / 2 ** width)
    return min(range(2, distance + 3), key=work)


def thresholds(counts: np.ndarray, widths: list[int], total: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Dynamic programming, for every row of ``counts`` (its value's count per partition):
    thresholds with sum(t_i + 1) = distance + 1 of least cost, and the candidates that are
    expected. best[s] is the least cost of the partitions so far with s spent."""
    n, m = counts.shape
    spend = distance + 1
    cost = np.zeros((m, spend + 1, n))  # of t = s - 1 in partition i
    seen = np.zeros((m, spend + 1, n))
    for i, width in enumerate(widths):
        other = total / 2.0 ** width    # expected count of any other value
        for s in range(1, spend + 1):
            ball = sum(comb(width, k) for k in range(s))
            seen[i, s] = counts[:, i] + (ball - 1) * other
            cost[i, s] = seen[i, s] + PROBE_COST * ball
    best = np.full((spend + 1, n), np.inf)
    best[0] = 0
    choice = np.zeros((m, spend + 1, n), np.int8)
    for i in range(m):
        options = np.stack([np.stack([best[s - x] + cost[i, x] if x <= s else np.full(n, np.inf)
                                      for x in range(spend + 1)]) for s in range(spend + 1)])
        choice[i] = options.argmin(axis=1)
        best = options.min(axis=1)
    out, left, expected = np.zeros((n, m), np.int64), np.full(n, spend), np.zeros(n)
    for i in reversed(range(m)):
        s = choice[i][left, np.arange(n)]
        out[:, i] = s - 1
        expected += seen[i][s, np.arange(n)]
        left -= s
    return out, expected


def _masks(parts: list[list[int]]) -> list[int]:
    return [int(np.array([sum(1 << b for b in p)], np.uint64).view(np.int64)[0]) for p in parts]


def _flips(bits: list[int], radius: int) -> list[int]:
    """XOR masks of all ways to change at most ``radius`` of ``bits``."""
    out = [0]
    for k in range(1, radius + 1):
        out += [int(np.array([sum(1 << b for b in c)], np.uint64).view(np.int64)[0]) for c in combinations(bits, k)]
    return out


def _value_counts(values: DataFrame) -> DataFrame:
    return values.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))


def links(distinct: DataFrame, distance: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """(a, b): links between the distinct fingerprints of ``distinct`` (fp) that give its
    components: every pair within ``distance`` bits, or a chain of such pairs."""
    total = distinct.count()
    m = choose_parts(total, distance)
    parts = bit_partitions(bit_counts(distinct), total, m)
    masks, widths = _masks(parts), [len(p) for p in parts]
    values = distinct.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(x)) for x in masks])).alias("part", "value"))
    counted = values.join(_value_counts(values), ["part", "value"])
    per_fp = counted.groupBy("fp").agg(*[F.max(F.when(F.col("part") == i, F.col("n"))).alias(f"n{i}")
                                        for i in range(m)])

    def allocate(batch: pa.RecordBatch) -> Iterator[dict]:
        counts = np.stack([batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(m)], 1).astype(float)
        t, expected = thresholds(counts, widths, total, distance)
        yield {"fp": batch.column(0), "expected": expected, "t": t.tolist()}

    plan = materialize(map_batches(per_fp, allocate, "fp BIGINT, expected DOUBLE, t ARRAY<INT>"), "simhash-plan")
    probes = None
    for i, bits in enumerate(parts):
        for s in range(distance + 1):  # values at exactly s changed bits, for those with t_i >= s
            ring = [f for f in _flips(bits, s) if f not in set(_flips(bits, s - 1))] if s else [0]
            x = plan.where((F.col("expected") <= dense) & (F.col("t")[i] >= s)).select(
                F.col("fp").alias("q"), F.lit(i).alias("part"),
                F.explode(F.array(*[F.lit(f) for f in ring])).alias("flip")).select(
                "q", "part", F.col("q").bitwiseAND(F.lit(masks[i])).bitwiseXOR(F.col("flip")).alias("value"))
            probes = x if probes is None else probes.unionAll(x)
    found = probes.join(values, ["part", "value"]).where(
        (F.col("q") != F.col("fp")) & (F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= distance)).select(
        F.col("q").alias("a"), F.col("fp").alias("b"))
    crowd = plan.where(F.col("expected") > dense).select("fp")
    return found.unionAll(centre_links(crowd, distance)).distinct()


def centre_links(crowd: DataFrame, distance: int) -> DataFrame:
    """(a, b): links that give the components of ``crowd`` without forming its pairs."""
    near = distance // 2
    name = lambda radius: crowd.select("fp", F.explode(F.array(
        *[F.lit(f) for f in _flips(list(range(BITS)), radius)])).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    close = name(near)
    least = close.groupBy("centre").agg(F.min("fp").alias("least"))
    other = close if distance % 2 == 0 else name(near + 1)
    return other.join(least, "centre").where("fp <> least").select(
        F.col("fp").alias("a"), F.col("least").alias("b")).distinct()


def _rooted(docs: DataFrame, distance: int, dense: int) -> DataFrame:
    """(doc_id, fp, root, component_id) per row of ``docs``; ``root`` is a fingerprint of the component."""
    fps = materialize(fingerprints(docs), "simhash-fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), distance, dense))
    of = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    named = of.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of = of.join(named, "root").select(F.col("fp").alias("of_fp"), "root", "component_id")
    return fps.join(of, F.col("fp") == F.col("of_fp")).select("doc_id", "fp", "root", "component_id")


def groups(docs: DataFrame, distance: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``."""
    return _rooted(docs, distance, dense).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, distance: int = DISTANCE, dense: int = DENSE) -> DataFrame:
    """The rows of ``docs`` that stay: of each component one row, of the least (doc_id, fingerprint).
    A row without a doc_id stays: no copy can name it. Rows that share a doc_id but not a fingerprint
    are documents of their own: each is judged by its own component."""
    of = materialize(_rooted(docs, distance, dense).withColumnRenamed("doc_id", "of_id").where("of_id IS NOT NULL"),
                     "simhash-groups")
    # these lists grow with the documents, so they are joined in the same way at every size
    gone = of.where("of_id <> component_id").select("of_id").distinct().hint("merge")
    own = docs["doc_id"].cast("bigint")
    many = of.groupBy("of_id").agg(F.count(F.lit(1)).alias("n"), (F.min("fp") != F.max("fp")).alias("mixed")).where("n > 1")
    many = materialize(many.select("of_id", "mixed"), "simhash-repeated")  # ids that rows repeat
    if many.isEmpty():
        return docs.join(gone, own == gone["of_id"], "left_anti")
    single = docs.join(many, own == many["of_id"], "left_anti")
    kept = single.join(gone, single["doc_id"].cast("bigint") == gone["of_id"], "left_anti")
    same = many.where("NOT mixed").join(gone, "of_id", "left_anti")
    kept = kept.unionAll(docs.join(same, own == same["of_id"], "left_semi").dropDuplicates(["doc_id"]))
    # rows whose doc_id has several fingerprints: one row of each component's least pair
    pairs = of.groupBy("root").agg(F.min(F.struct("of_id", "fp")).alias("least")).select(
        F.col("least.of_id").alias("_least_id"), F.col("least.fp").alias("_least_fp"))
    mixed = many.where("mixed")
    rows = docs.join(mixed, own == mixed["of_id"], "left_semi")
    key = F.xxhash64(rows["doc_id"].cast("bigint"), rows["text"])
    marked = fingerprints(rows.select(key.alias("doc_id"), "text")).select(
        F.col("doc_id").alias("_row_key"), F.col("fp").alias("_row_fp")).distinct()
    stay = (rows.join(marked, key == marked["_row_key"])
            .join(pairs, (rows["doc_id"].cast("bigint") == pairs["_least_id"]) & (F.col("_row_fp") == pairs["_least_fp"])))
    return kept.unionAll(stay.dropDuplicates(["doc_id", "_row_fp"]).drop("_row_key", "_row_fp", "_least_id", "_least_fp"))
