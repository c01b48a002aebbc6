"""Connected components of a link table, by alternating large and small stars.

Each round is two grouped minima with a join back, so a node with any number of links is
never held by one task as a list; each round's links are written to the shared folder,
which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofi.session import materialize


def _stars(links: DataFrame, small: bool) -> DataFrame:
    """One star step over distinct links (a > b)."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if not small:  # a large star looks at all neighbours, a small star at the smaller ones
        both = both.unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    x = both.join(least, "u")
    out = x.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    if small:
        out = x.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of ``links`` (a BIGINT, b BIGINT) and the smallest node it
    reaches. Rounds end when the stars no longer change, after about log2 of the longest
    path; the driver reads two numbers per round."""
    now = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "links")
    sign = None
    while True:
        now = materialize(_stars(_stars(now, False), True), "stars")
        row = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if (row[0], row[1]) == sign:
            break
        sign = (row[0], row[1])
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
