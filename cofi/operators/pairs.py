"""User pairs that share a key (an item, or a (bin, item) block): the self-join behind every
similarity.

Each unordered pair appears once per shared key (smaller side first). A key with many
raters would make one task produce n^2 pairs, so keys are cut into blocks: a key with n
raters gets b = ceil(n / block_rows) blocks, each rater falls in block hash(user) mod b, and
block pair (i, j), i <= j, is one join key. Work per join key is then about block_rows^2
whatever n is, while the left side is copied (b - i) times; keys under ``block_rows`` raters
keep b = 1 and are joined as they are.

The join is a sort-merge join that Spark distributes itself (no partition count is named
here), so adaptive execution splits a partition that many block pairs meet in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BLOCK_ROWS = 2048
NOISE = 1e-12  # a sum this small against the sum of its terms' sizes is rounding error


def co_rated_pairs(df: DataFrame, keys: list[str], value: str | None = None,
                   block_rows: int = DEFAULT_BLOCK_ROWS, apart: list[str] | None = None) -> DataFrame:
    """Rows (u, v, *keys, a, b) for every pair u < v sharing ``keys``.

    ``df`` has ``user_id``, the key columns and optionally ``value``; ``a`` and ``b`` are the
    two users' values (1.0 when ``value`` is None). Callers aggregate by (u, v); Spark
    pipelines that partial aggregate into the join stage. ``apart`` names bit masks of a row:
    two rows that have a bit in common form no pair (part of the join's condition).
    """
    val = F.col(value) if value else F.lit(1.0)
    masks = range(len(apart or []))
    base = df.select("user_id", *keys, val.alias("_val"), *[F.col(c).alias(f"_m{i}") for i, c in enumerate(apart or [])])
    sizes = base.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_nb"))
    base = base.join(sizes, keys).withColumn("_blk", F.pmod(F.xxhash64("user_id"), F.col("_nb")).cast("int"))
    left = base.select(*keys, F.col("user_id").alias("_u"), F.col("_val").alias("a"),
                       F.col("_blk").alias("_ub"), *[F.col(f"_m{i}").alias(f"_mu{i}") for i in masks],
                       F.explode(F.sequence(F.col("_blk"), F.col("_nb") - 1)).alias("_vb"))
    right = base.select(*keys, F.col("user_id").alias("_v"), F.col("_val").alias("b"),
                        F.col("_blk").alias("_vb"), *[F.col(f"_m{i}").alias(f"_mv{i}") for i in masks])
    # merge: the output is far larger than either side, so neither is worth broadcasting
    joined = left.hint("merge").join(right, keys + ["_vb"]).where(
        (F.col("_ub") < F.col("_vb")) | (F.col("_u") < F.col("_v")))
    for i in masks:
        joined = joined.where(F.col(f"_mu{i}").bitwiseAND(F.col(f"_mv{i}")) == 0)
    # Across blocks the pair can come out as (larger, smaller): order it.
    swap = F.col("_u") > F.col("_v")
    return joined.select(F.least("_u", "_v").alias("u"), F.greatest("_u", "_v").alias("v"), *keys,
                         F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"),
                         F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"))


def summed(pairs: DataFrame, *keys: str) -> DataFrame:
    """(*keys, sim): the sum of a * b per key, without those that are zero."""
    return (pairs.groupBy(*keys).agg(F.sum(F.col("a") * F.col("b")).alias("sim"),
                                     F.sum(F.abs(F.col("a") * F.col("b"))).alias("_size"))
            .where(nonzero("sim", "_size")).select(*keys, "sim"))


def symmetrize(pairs: DataFrame, u: str = "u", v: str = "v", cols: list[str] | None = None) -> DataFrame:
    """Pairs stored once (u < v) to both directions, in one pass (a generator, no union)."""
    cols = cols or ["sim"]
    both = F.explode(F.array(F.struct(F.col(u).alias("u"), F.col(v).alias("v")),
                             F.struct(F.col(v).alias("u"), F.col(u).alias("v"))))
    return pairs.select(both.alias("_e"), *cols).select("_e.u", "_e.v", *cols)


def nonzero(total, size) -> Column:
    """Whether a sum of products is more than the rounding error of its terms; ``size`` is
    the sum of their absolute values."""
    return F.abs(total) > F.lit(NOISE) * F.col(size)
