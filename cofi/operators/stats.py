"""Averages, normalized deviations and user norms (all grouped aggregates + key joins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofi.functions import mean_or_zero, normalized_deviation
from cofi.sources.ratings import only


def global_avg(train: DataFrame) -> Column:
    """Scalar-subquery column: the mean rating. Spark evaluates it once and inlines it."""
    return train.select(F.avg("rating")).scalar()


def n_users(train: DataFrame) -> Column:
    """Scalar-subquery column: the number of distinct users in ``train``."""
    return train.select(F.countDistinct("user_id")).scalar()


def global_stats(train: DataFrame) -> DataFrame:
    """One row: global_avg, n_ratings, n_users, n_items."""
    return train.agg(F.avg("rating").alias("global_avg"),
                     F.count(F.lit(1)).alias("n_ratings"),
                     F.countDistinct("user_id").alias("n_users"),
                     F.countDistinct("item_id").alias("n_items"))


def user_avg(train: DataFrame) -> DataFrame:
    """(user_id, user_avg, n)."""
    return train.groupBy("user_id").agg(F.avg("rating").alias("user_avg"),
                                        F.count(F.lit(1)).alias("n"))


def item_avg(train: DataFrame) -> DataFrame:
    """(item_id, item_avg, n)."""
    return train.groupBy("item_id").agg(F.avg("rating").alias("item_avg"),
                                        F.count(F.lit(1)).alias("n"))


def user_avg_point(train: DataFrame, user) -> DataFrame:
    """One row (user_id, user_avg); 0.0 for a user without ratings (mean of nothing)."""
    return (train.where(F.col("user_id") == F.lit(user))
            .agg(mean_or_zero("rating").alias("user_avg"))
            .select(F.lit(user).cast("bigint").alias("user_id"), "user_avg"))


def item_avg_point(train: DataFrame, item) -> DataFrame:
    """One row (item_id, item_avg); 0.0 for an item without ratings."""
    return (train.where(F.col("item_id") == F.lit(item))
            .agg(mean_or_zero("rating").alias("item_avg"))
            .select(F.lit(item).cast("bigint").alias("item_id"), "item_avg"))


def norm_dev(train: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """(user_id, item_id, rating, user_avg, dev) with dev = (r - avg_u) / scale(r, avg_u).

    The per-user average is a grouped aggregate joined back on user_id: Spark combines
    map-side, so a hot user is summed in pieces; the join becomes a broadcast when the
    measured user table is small, a shuffle join (skew-split by AQE) otherwise.
    """
    ua = user_avg(train).select("user_id", "user_avg")
    return (train.join(ua, "user_id")
            .select("user_id", "item_id", "rating", "user_avg",
                    normalized_deviation("rating", "user_avg", lo, hi).alias("dev")))


def item_dev(dev: DataFrame) -> DataFrame:
    """(item_id, dev, n): average normalized deviation per item."""
    return dev.groupBy("item_id").agg(F.avg("dev").alias("dev"), F.count(F.lit(1)).alias("n"))


def item_dev_point(dev: DataFrame, item) -> DataFrame:
    """One row (item_id, dev); 0.0 when nobody rated the item."""
    return (dev.where(F.col("item_id") == F.lit(item))
            .agg(mean_or_zero("dev").alias("dev"))
            .select(F.lit(item).cast("bigint").alias("item_id"), "dev"))


def dev_of_item(train: DataFrame, item: int) -> DataFrame:
    """``norm_dev`` of one item's ratings: only its raters' rows are averaged."""
    raters = train.where(F.col("item_id") == F.lit(item)).select("user_id")
    return norm_dev(only(train, raters)).where(F.col("item_id") == F.lit(item))


def user_norm(dev: DataFrame) -> DataFrame:
    """(user_id, norm) = sqrt(sum(dev^2)) per user."""
    return dev.groupBy("user_id").agg(F.sqrt(F.sum(F.col("dev") * F.col("dev"))).alias("norm"))


def preprocessed(dev: DataFrame) -> DataFrame:
    """(user_id, item_id, dev, rhat): deviation over the user's norm, 0 when the norm is 0."""
    nrm = user_norm(dev)
    return (dev.join(nrm, "user_id")
            .select("user_id", "item_id", "dev",
                    F.when(F.col("norm") == 0, F.lit(0.0))
                     .otherwise(F.col("dev") / F.col("norm")).alias("rhat")))


def enrich(train: DataFrame, lo: float = 1.0, hi: float = 5.0) -> DataFrame:
    """(user_id, item_id, rating, user_avg, dev, rhat): every per-rating quantity the
    predictors and similarities need, in one table (materialize it when several branches
    read it)."""
    dev = norm_dev(train, lo, hi)
    nrm = user_norm(dev)
    return (dev.join(nrm, "user_id")
            .select("user_id", "item_id", "rating", "user_avg", "dev",
                    F.when(F.col("norm") == 0, F.lit(0.0))
                     .otherwise(F.col("dev") / F.col("norm")).alias("rhat")))


def rating_or_user_avg(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """(user_id, item_id, value): the stored rating, else the user's average, else NULL."""
    ua = user_avg(train).select("user_id", "user_avg")
    r = train.select("user_id", "item_id", "rating")
    return (pairs.select("user_id", "item_id")
            .join(r, ["user_id", "item_id"], "left")
            .join(ua, "user_id", "left")
            .select("user_id", "item_id", F.coalesce("rating", "user_avg").alias("value")))


def adjacency(train: DataFrame, key: str, member: str, chunk: int = 1024) -> DataFrame:
    """(key, chunk, n, ids): members of each key as sorted comma-joined id lists.

    A key's members are cut into chunks by ``member div chunk``, so one list never holds
    more than ``chunk`` ids however popular the key is; the list is built by a grouped
    aggregate that combines map-side.
    """
    blk = F.floor(F.col(member) / chunk).cast("bigint")
    return (train.select(key, member).withColumn("chunk", blk)
            .groupBy(key, "chunk")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.concat_ws(",", F.sort_array(F.collect_list(member)).cast("array<string>"))
                  .alias("ids")))
