"""k-nearest-neighbour graphs with the reference's ranking of zero similarities.

Every other user is a candidate neighbour. Users sharing no item (or with similarity 0)
take rank slots ahead of negatively similar users but are never stored. In other words
the ranking is by similarity descending over all candidates, where the n_zero =
n_candidates - stored candidates sit at 0: a stored neighbour's rank is its position among
the stored edges (similarity desc, neighbour id asc), plus n_zero when it is negative.

The graph of all users is cut while its pairs are summed: ``blocks.best_rows`` keeps the k best edges
per user (and part, e.g. bin), ``partial_lists`` cuts a given edge table so; both count what they saw as far as
the ranks of negative edges need it; ``merged`` unites the lists and cuts them again. No pair table is
written: at most k edges per user and part, and one count.

``top_k`` ranks a written edge table and does not sort every edge. A per-user histogram of similarity buckets (a grouped
count, combined map-side) gives the bucket that holds the k-th candidate; only edges at or
above it are sorted. Every edge ranked above a kept edge is kept too, so the ranks are
exact, and a user with a huge neighbourhood sorts about k rows plus one bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cofi.functions import round_key
from cofi.operators import stats
from cofi.operators.blocks import Rule, best_rows
from cofi.operators.similarity import co_raters, cosine_between, cosine_of, lookup_pairs, rated
from cofi.operators.stats import n_users
from cofi.session import materialize
from cofi.sources.ratings import only

RANK_DIGITS = 10
BUCKETS_PER_UNIT = 64  # histogram resolution: similarity buckets of width 1/64


def top_k(edges: DataFrame, k: int, n_candidates, user: str = "u", nbr: str = "v",
          sim: str = "sim", keys: list[str] | None = None) -> DataFrame:
    """(user_id, neighbor_id, sim, rank[, keys]) for the k best neighbours of each user.

    ``edges`` holds non-zero similarities in both directions (read three times: pass a
    scan of a written table, not a long lineage). ``n_candidates`` is a Column (same count
    for every user, e.g. a scalar subquery) or a DataFrame (user_id[, keys], n_cand).
    ``keys`` ranks separately per extra key (e.g. per replication level).
    """
    keys = keys or []
    grp = ["user_id", *keys]
    width = 10.0 ** RANK_DIGITS / BUCKETS_PER_UNIT
    e = edges.select(F.col(user).alias("user_id"), F.col(nbr).alias("neighbor_id"),
                     F.col(sim).alias("sim"), *keys).withColumn("_key", round_key("sim", RANK_DIGITS))
    e = e.withColumn("_b", F.floor(F.col("_key") / F.lit(width)))

    # Per user: histogram of buckets, stored total, cumulative count from the top bucket
    # down; the unstored zero candidates count from bucket 0 down. The threshold is the
    # highest bucket whose cumulative count reaches k (none: every edge is kept).
    hist = e.groupBy(*grp, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w_all = Window.partitionBy(*grp)
    w_cum = (Window.partitionBy(*grp).orderBy(F.col("_b").desc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    h = (hist.withColumn("_stored", F.sum("_c").over(w_all))
         .withColumn("_cum", F.sum("_c").over(w_cum)))
    if isinstance(n_candidates, DataFrame):
        h = h.join(n_candidates.select(*grp, F.col("n_cand").alias("_cand")), grp)
        zero = F.col("_cand") - F.col("_stored")
    else:
        zero = n_candidates - F.col("_stored")
    h = h.withColumn("_zero", zero)
    reach = F.col("_cum") + F.when(F.col("_b") <= 0, F.col("_zero")).otherwise(F.lit(0))
    # One row per user, written first so the planner sees its real size: broadcast when
    # small (edges are filtered before any shuffle), shuffle join otherwise.
    per_user = materialize(
        h.groupBy(*grp).agg(F.max(F.when(reach >= k, F.col("_b"))).alias("_t"),
                            F.max("_zero").alias("_zero")),
        "topk_threshold")

    kept = (e.join(per_user, grp)
            .where(F.col("_t").isNull() | (F.col("_b") >= F.col("_t"))))
    w = Window.partitionBy(*grp).orderBy(F.col("_key").desc(), F.col("neighbor_id"))
    ranked = kept.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    rank = F.col("_rn") + F.when(F.col("_key") < 0, F.col("_zero")).otherwise(F.lit(0))
    return (ranked.select("user_id", "neighbor_id", "sim", *keys, rank.cast("bigint").alias("rank"))
            .where(F.col("rank") <= k))


def partial_lists(edges: DataFrame, k: int, part: list[str] | None = None, name: str = "partial_lists") -> DataFrame:
    """(user_id, neighbor_id, sim, *part, _stored), written: per user and ``part`` at most the k best edges,
    and one row without a neighbour that holds their number before the cut.

    ``edges`` (u, v, sim, *part) holds non-zero similarities in both directions. It is read twice in one
    job, so a shuffle it ends in is computed once and reused. The limit on the window is applied
    before the shuffle by user too (for k up to spark.sql.optimizer.windowGroupLimitThreshold).
    """
    part = part or []
    e = edges.select(F.col("u").alias("user_id"), F.col("v").alias("neighbor_id"), "sim", *part)
    w = Window.partitionBy("user_id", *part).orderBy(round_key("sim", RANK_DIGITS).desc(), "neighbor_id")
    lists = e.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    counts = e.groupBy("user_id", *part).agg(F.count(F.lit(1)).alias("_stored"))
    none = lambda t: F.lit(None).cast(t)
    return materialize(
        lists.select("user_id", "neighbor_id", "sim", *part, none("bigint").alias("_stored")).unionAll(
            counts.select("user_id", none("bigint"), none("double"), *part, "_stored")), name)


def merged(lists: DataFrame, k: int, n_candidates) -> DataFrame:
    """(user_id, neighbor_id, sim, rank): the k best of each user's ``partial_lists``. The parts of a user hold
    different neighbours. ``n_candidates`` as in ``top_k``."""
    stored = lists.where("neighbor_id IS NULL").groupBy("user_id").agg(F.sum("_stored").alias("_stored"))
    if isinstance(n_candidates, DataFrame):
        stored = stored.join(n_candidates.select("user_id", F.col("n_cand").alias("_cand")), "user_id")
    else:
        stored = stored.withColumn("_cand", n_candidates)
    key = round_key("sim", RANK_DIGITS)
    w = Window.partitionBy("user_id").orderBy(key.desc(), "neighbor_id")
    best = (lists.where("neighbor_id IS NOT NULL").select("user_id", "neighbor_id", "sim")
            .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k))
    zero = F.when(key < 0, F.col("_cand") - F.col("_stored")).otherwise(F.lit(0))
    return (best.join(stored, "user_id")
            .select("user_id", "neighbor_id", "sim", (F.col("_rn") + zero).cast("bigint").alias("rank"))
            .where(F.col("rank") <= k))


def _placed(best: DataFrame, k: int, part: list[str]) -> DataFrame:
    """(user_id, *part, neighbor_id, sim, _rn, _seen): the k best edges of what ``blocks.best_rows`` kept, their place, and how many
    there were before the cut."""
    key = Window.partitionBy("user_id", *part)
    # the lists travel as they are and are opened where they are ranked
    one = F.posexplode(F.arrays_zip("near", "sims")).alias("_at", "_e")
    found = best.repartition("user_id", *part).select("user_id", *part, "seen", one).select(
        "user_id", *part, F.col("_e.near").alias("neighbor_id"), F.col("_e.sims").alias("sim"),
        F.when(F.col("_at") == 0, F.col("seen")).otherwise(F.lit(0)).alias("seen"))
    return (found.withColumn("_rn", F.row_number().over(key.orderBy(round_key("sim", RANK_DIGITS).desc(), "neighbor_id")))
            .withColumn("_seen", F.sum("seen").over(key)).where(F.col("_rn") <= k))


def listed(best: DataFrame, k: int, part: list[str] | None = None, name: str = "partial_lists") -> DataFrame:
    """``partial_lists`` of what ``blocks.best_rows`` kept, in one pass over one shuffle."""
    part = part or []
    none = lambda t: F.lit(None).cast(t)
    edge = F.struct("neighbor_id", "sim", none("bigint").alias("_stored"))
    count = F.struct(none("bigint").alias("neighbor_id"), none("double").alias("sim"), F.col("_seen").alias("_stored"))
    rows = F.explode(F.when(F.col("_rn") == 1, F.array(edge, count)).otherwise(F.array(edge)))
    return materialize(_placed(best, k, part).select("user_id", *part, rows.alias("_e")).select(
        "user_id", "_e.neighbor_id", "_e.sim", *part, "_e._stored"), name)


def knn_lists(rhat: DataFrame, k: int, **block) -> DataFrame:
    """The ``partial_lists`` of the exact graph: what ``merged`` ranks and ``with_new_users`` extends."""
    return listed(best_rows(rated(rhat), Rule(), k, **block), k)


def knn_graph(rhat: DataFrame, k: int, n_candidates: Column, **block) -> DataFrame:
    """Exact kNN graph on adjusted cosine from preprocessed ratings. As ``merged`` of ``knn_lists``, but the lists are whole and keep
    their places, so no edge is shuffled again to be ranked."""
    lists = materialize(_placed(best_rows(rated(rhat), Rule(), k, **block), k, []).select(
        "user_id", "neighbor_id", "sim", "_rn", "_seen"), "partial_lists", compression="zstd")
    zero = F.when(round_key("sim", RANK_DIGITS) < 0, n_candidates - F.col("_seen")).otherwise(F.lit(0))
    return (lists.select("user_id", "neighbor_id", "sim", (F.col("_rn") + zero).cast("bigint").alias("rank"))
            .where(F.col("rank") <= k))


def with_new_users(lists: DataFrame, ratings: DataFrame, new_users: DataFrame, k: int, rhat: DataFrame | None = None) -> DataFrame:
    """``lists`` (``knn_lists`` with this k or a larger one) after users were appended: one more part, their
    edges in both directions. ``merged`` of it, with the new number of candidates, is the graph a full rebuild
    gives.

    An appended user changes no other user's average or norm, so no similarity of two earlier users changes and
    none is formed: only the rows of those who share an item with a new user are read. ``ratings`` holds the
    appended ratings, ``new_users`` (user_id) who is new; one who has a list already stops the job (new
    ratings of a known user change all of that user's similarities: rebuild). ``rhat``: the preprocessed ratings of
    the earlier users (user_id, item_id, rhat), if they are written already; only the new users' are formed then.
    """
    new = new_users.select(F.col("user_id").cast("bigint").alias("user_id")).distinct()
    known = new.select(F.col("user_id").alias("v"), F.lit(True).alias("_new"))
    # two new users meet in both directions already
    if rhat is None:
        sims = cosine_of(materialize(stats.enrich(only(ratings, co_raters(ratings, new))), "near_new"), new)
    else:
        # written, so that the planner knows that few rows are sent to the earlier users' ratings
        own = materialize(stats.enrich(only(ratings, new)).select("user_id", "item_id", "rhat"), "rhat_new")
        sims = cosine_between(rhat.select("user_id", "item_id", "rhat").unionByName(own), own)
    sims = sims.join(known, "v", "left")
    there, back = F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    edges = sims.select(F.explode(F.when(F.col("_new"), F.array(there)).otherwise(F.array(there, back))).alias("_e"),
                        "sim").select("_e.u", "_e.v", "sim")
    old = lists.join(known.withColumnRenamed("v", "user_id"), "user_id", "left").where(F.assert_true(
        F.col("_new").isNull(), F.concat(F.lit("not a new user: "), F.col("user_id").cast("string"))).isNull())
    return old.select(*lists.columns).unionByName(partial_lists(edges, k, name="lists_new"))


def knn_from_ratings(train: DataFrame, k: int, n_candidates: Column | None = None,
                     **block) -> DataFrame:
    """Exact kNN graph: ratings -> deviations -> rhat -> pairs -> top-k."""
    rhat = materialize(stats.enrich(train).select("user_id", "item_id", "rhat"), "enriched")
    if n_candidates is None:
        n_candidates = n_users(train) - 1
    return knn_graph(rhat, k, n_candidates, **block)


def knn_lookup(knn: DataFrame, pairs: DataFrame) -> DataFrame:
    """(u, v, sim): similarity of a pair if v is among u's k neighbours, else 0.0."""
    return lookup_pairs(knn.select(F.col("user_id").alias("u"), F.col("neighbor_id").alias("v"), "sim"), pairs)


def knn_of(train: DataFrame, users, k: int) -> tuple[DataFrame, DataFrame]:
    """The k neighbours of the requested users (an id, a list, a DataFrame) among all users of
    ``train``, and the per-rating table (``stats.enrich``) of everyone who shares an item
    with them, which their predictions need. No pair of two other users is formed."""
    enriched = materialize(stats.enrich(only(train, co_raters(train, users))), "enriched_of")
    sims = materialize(cosine_of(enriched, users), "sims_of")
    return top_k(sims, k, n_users(train) - 1), enriched


def nested(knn: DataFrame) -> DataFrame:
    """(user_id, neighbors ARRAY<STRUCT<rank, neighbor_id, sim>>): one list per user, in
    rank order. A list holds at most k entries, so the grouping is bounded."""
    return knn.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "neighbor_id", "sim"))).alias("neighbors"))


def as_edges(knn: DataFrame) -> DataFrame:
    """Graph rows as prediction weights (user_id, neighbor_id, sim)."""
    return knn.select("user_id", "neighbor_id", "sim")
