"""User-user similarities: adjusted cosine (on preprocessed ratings), Jaccard, uniform.

Pairs with nothing in common have similarity 0 and are never stored: a lookup of an absent
pair returns 0.0, and zero weights never change a prediction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cofi.operators.blocks import Rule, attrs, edge_rows, pair_rows, sum_rows
from cofi.operators.pairs import co_rated_pairs, summed, symmetrize
from cofi.session import materialize
from cofi.sources.ratings import only

RARITY_STEPS = 4     # classes of item frequency per power of two
RARITY_PARTS = 32    # parts of a class, by the item's hash
SLACK = 1e-9         # the filters of ``jaccard_at_least`` stay this far on the safe side


def cosine_pairs(rhat: DataFrame, **block) -> DataFrame:
    """(u, v, sim), u < v, for every co-rated pair whose sum over common items of
    rhat_u * rhat_v is not zero. ``rhat`` is read three times (so by the others below)."""
    return pair_rows(rated(rhat), Rule(), **block).select("u", "v", "sim")


def rated(rhat: DataFrame) -> DataFrame:
    """What ``blocks`` reads of preprocessed ratings: zeros add nothing to a sum nor to the size of its terms."""
    return rhat.select("user_id", "item_id", F.col("rhat").alias("val")).where("val <> 0")


def cosine_edges(rhat: DataFrame, **block) -> DataFrame:
    """(u, v, sim) in both directions, non-zero similarities only."""
    return symmetrize(cosine_pairs(rhat, **block))


def jaccard_pairs(train: DataFrame, **block) -> DataFrame:
    """(u, v, sim), u < v: |items_u & items_v| / |items_u | items_v| for co-rated pairs.

    The union size is n_u + n_v - common, with the per-user counts from one grouped
    aggregate joined to the ratings.
    """
    return pair_rows(_sets(train), Rule(sets=True), **block).select("u", "v", "sim")


def _sets(train: DataFrame) -> DataFrame:
    """(user_id, item_id, val, attrs): every rating as a 1, with the number of its user's ratings."""
    n = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return train.select("user_id", "item_id", F.lit(1.0).alias("val")).join(n, "user_id").select(
        "user_id", "item_id", "val", attrs("n"))


def _jaccard(common: DataFrame, train: DataFrame) -> DataFrame:
    cnt = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    cu = cnt.select(F.col("user_id").alias("u"), F.col("n").alias("nu"))
    cv = cnt.select(F.col("user_id").alias("v"), F.col("n").alias("nv"))
    return (common.join(cu, "u").join(cv, "v")
            .select("u", "v", (F.col("c") / (F.col("nu") + F.col("nv") - F.col("c"))).alias("sim")))


def jaccard_edges(train: DataFrame, **block) -> DataFrame:
    """(u, v, sim) in both directions, a user's edges together: few values repeat, so the written result is half the size."""
    return edge_rows(_sets(train), Rule(sets=True), **block).select("u", "v", "sim")


def rarity(train: DataFrame) -> DataFrame:
    """(user_id, item_id, ord): where each item falls in an order of all items by rarity, the same for every
    user. Items of a class (frequencies within a quarter of a power of two) are told apart by a hash in
    RARITY_PARTS parts, so there are some thousand values whatever the number of items."""
    freq = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("_f"))
    place = (F.floor(F.log2(F.col("_f").cast("double")) * RARITY_STEPS) * RARITY_PARTS
             + F.pmod(F.xxhash64("item_id"), F.lit(RARITY_PARTS)))
    return train.select("user_id", "item_id").join(
        freq.select("item_id", place.cast("int").alias("ord")), "item_id").select("user_id", "item_id", "ord")


def _with_ends(train: DataFrame, threshold: float) -> DataFrame:
    """(user_id, item_id, ord, own STRUCT<n, rest, end>): every rating, and where its user's prefix ends.

    The place at which a prefix ends is read off a per-user histogram of ``ord``, not off sorted items, and all
    items at that place are taken: a longer prefix than needed loses no pair, and a user with very many items
    is counted in pieces.
    """
    placed = materialize(rarity(train), "rarity")
    hist = placed.groupBy("user_id", "ord").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("user_id")
    run = hist.withColumn("_upto", F.sum("_c").over(w.orderBy("ord"))).withColumn("n", F.sum("_c").over(w))
    need = F.col("n") - F.ceil(F.col("n") * threshold - SLACK) + 1
    ends = run.where(F.col("_upto") >= need).groupBy("user_id").agg(F.struct(
        F.max("n").alias("n"), (F.max("n") - F.min("_upto")).alias("rest"), F.min("ord").alias("end")).alias("own"))
    return placed.join(ends, "user_id")


def rare_prefixes(train: DataFrame, threshold: float) -> DataFrame:
    """(user_id, item_id, own STRUCT<n, rest, end>): each user's rarest items, at least
    n - ceil(threshold * n) + 1 of n; the last place taken is ``end``, and ``rest`` items lie beyond it."""
    return _with_ends(train, threshold).where("ord <= own.end").select("user_id", "item_id", "own")


def jaccard_candidates(train: DataFrame, threshold: float, **block) -> DataFrame:
    """(u, v, nu, nv), u < v: the pairs that share an item of both prefixes and whose sizes, and the items that
    can still be shared beyond the shorter prefix, allow the similarity. Sets with a Jaccard similarity of t
    share at least ceil(t * n) items of each, so under one order of all items their prefixes meet."""
    prefixes = materialize(rare_prefixes(train, threshold), "rare_prefixes")
    met = (co_rated_pairs(prefixes, ["item_id"], "own", **block)
           .where(F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * threshold - SLACK)
           .groupBy("u", "v").agg(F.max("a").alias("a"), F.max("b").alias("b"), F.count(F.lit(1)).alias("_c")))
    # common items up to the smaller end are counted; the others lie in what that user has beyond it
    most = F.col("_c") + F.when(F.col("a.end") <= F.col("b.end"), F.col("a.rest")).otherwise(F.col("b.rest"))
    least = (F.col("a.n") + F.col("b.n")) * (threshold / (1 + threshold))
    return met.where(most >= least - SLACK).select("u", "v", F.col("a.n").alias("nu"), F.col("b.n").alias("nv"))


def jaccard_at_least(train: DataFrame, threshold: float, **block) -> DataFrame:
    """(u, v, sim), u < v, for every pair of users with a Jaccard similarity of ``threshold`` or more (over 0, at
    most 1): an exact set-similarity join by prefix and size, verified on all items in the block pair where two
    users meet. Pairs that share frequent items only are never formed, but in dense block pairs, where a product of
    matrices costs less than the prefixes' terms."""
    if not 0 < threshold <= 1:
        raise ValueError(f"a threshold over 0 and up to 1, not {threshold!r}")
    rows = _with_ends(train, threshold).select(
        "user_id", "item_id", F.lit(1.0).alias("val"), F.expr("CAST(ord <= own.end AS DOUBLE)").alias("dev"), attrs("own.n"))
    return pair_rows(materialize(rows, "prefix_marks"), Rule(sets=True, least=threshold, prefix=True), **block).select("u", "v", "sim")


def cosine_sums(rhat: DataFrame, test: DataFrame, **block) -> DataFrame:
    """(user_id, item_id, num, den) of the test pairs: sum(sim * dev_v,i) and sum(|sim|) over all v who rated i.
    ``rhat`` holds ``dev`` too. No pair leaves its block pair."""
    rows = rhat.select("user_id", "item_id", F.col("rhat").alias("val"), "dev").where("val IS NOT NULL")
    return _summed_requests(rows, test, Rule(), **block)


def jaccard_sums(train: DataFrame, dev: DataFrame, test: DataFrame, **block) -> DataFrame:
    """As ``cosine_sums``, weighted by Jaccard similarity."""
    n = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return _summed_requests(dev.select("user_id", "item_id", F.lit(1.0).alias("val"), "dev"), test, Rule(sets=True), n, **block)


def _summed_requests(rows: DataFrame, test: DataFrame, rule: Rule, n: DataFrame | None = None, **block) -> DataFrame:
    asked = test.select("user_id", "item_id", F.lit(None).cast("double").alias("val"), F.lit(None).cast("double").alias("dev"))
    rows = rows.unionByName(asked)
    if n is not None:
        rows = rows.join(n, "user_id", "left").select(
            "user_id", "item_id", "val", "dev", attrs(F.coalesce("n", F.lit(0))))
    return sum_rows(materialize(rows, "rows_and_requests"), rule, **block).groupBy("user_id", "item_id").agg(
        F.sum("num").alias("num"), F.sum("den").alias("den"))


# Requests first: similarities of given users (an id, a list, a DataFrame) against the others.
# Only the users who share an item with them are read, and only rows of requested users are formed.

def co_raters(train: DataFrame, users) -> DataFrame:
    """(user_id): the requested users and everyone who rated an item of theirs."""
    items = only(train, users).select("item_id").distinct()
    return train.join(items, "item_id", "left_semi").select("user_id").distinct()


def _rows_of(table: DataFrame, users, value: str | None) -> DataFrame:
    """(u, v, a, b) per item that a requested user u shares with another user v."""
    return _shared(table, only(table, users), value)


def _shared(table: DataFrame, own: DataFrame, value: str | None) -> DataFrame:
    val = F.col(value) if value else F.lit(1.0)
    mine = own.select(F.col("user_id").alias("u"), "item_id", val.alias("a"))
    others = table.select(F.col("user_id").alias("v"), "item_id", val.alias("b"))
    return others.join(mine, "item_id").where("u <> v")


def cosine_of(rhat: DataFrame, users) -> DataFrame:
    """(u, v, sim), non-zero, for each requested user u."""
    return summed(_rows_of(rhat, users, "rhat"), "u", "v")


def cosine_between(rhat: DataFrame, own: DataFrame) -> DataFrame:
    """(u, v, sim), non-zero, for each user u of ``own`` against the other users of ``rhat``."""
    return summed(_shared(rhat, own, "rhat"), "u", "v")


def jaccard_of(train: DataFrame, users) -> DataFrame:
    """(u, v, sim) for each requested user u."""
    return _jaccard(_rows_of(train, users, None).groupBy("u", "v").agg(F.count(F.lit(1)).alias("c")), train)


def sim_one_user(rhat: DataFrame, user: int) -> DataFrame:
    """(u, v, sim) of one user against every co-rated user, zeros too: one row of R * R^T."""
    return _rows_of(rhat, user, "rhat").groupBy("u", "v").agg(F.sum(F.col("a") * F.col("b")).alias("sim"))


def sim_cosine_pair(rhat: DataFrame, u, v) -> DataFrame:
    """One row (u, v, sim), 0.0 when the two users share no item."""
    a = rhat.where(F.col("user_id") == F.lit(u)).select("item_id", F.col("rhat").alias("a"))
    b = rhat.where(F.col("user_id") == F.lit(v)).select("item_id", F.col("rhat").alias("b"))
    return (a.join(b, "item_id")
            .agg(F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0.0)).alias("sim"))
            .select(F.lit(u).cast("bigint").alias("u"), F.lit(v).cast("bigint").alias("v"), "sim"))


def sim_jaccard_pair(train: DataFrame, u, v) -> DataFrame:
    """One row (u, v, sim) for a Jaccard pair, 0.0 when the item sets are disjoint or empty."""
    two = (train.where(F.col("user_id").isin(u, v))
           .select("item_id", (F.col("user_id") == F.lit(u)).alias("is_u")))
    per_item = two.groupBy("item_id").agg(
        F.max(F.col("is_u").cast("int")).alias("in_u"),
        F.max((~F.col("is_u")).cast("int")).alias("in_v"))
    return (per_item.agg(F.sum(F.col("in_u") * F.col("in_v")).alias("c"),
                         F.count(F.lit(1)).alias("n"))
            .select(F.lit(u).cast("bigint").alias("u"), F.lit(v).cast("bigint").alias("v"),
                    F.coalesce(F.try_divide(F.col("c").cast("double"), F.col("n")),
                               F.lit(0.0)).alias("sim")))


def lookup_pairs(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """(u, v, sim) for requested pairs; 0.0 when the pair is not stored."""
    e = edges.select("u", "v", "sim")
    return (pairs.select("u", "v").join(e, ["u", "v"], "left")
            .select("u", "v", F.coalesce("sim", F.lit(0.0)).alias("sim")))
