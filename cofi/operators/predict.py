"""Rating predictors. Each returns the test rows with a ``prediction`` column:
``user_id, item_id, rating, prediction`` (never zipped by position).

Fallbacks: an unseen user takes the global average, an unseen item the user's average,
and a zero weight sum (no neighbour rated the item) leaves the user's average.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cofi.functions import denormalize, weighted_deviation
from cofi.operators.stats import global_avg, item_avg, item_dev, user_avg

LIST_ITEMS = 256  # test items that an edge takes along at once


def _out(df: DataFrame, pred: Column) -> DataFrame:
    return df.select("user_id", "item_id", "rating", pred.alias("prediction"))


def _test_cols(test: DataFrame) -> DataFrame:
    if "rating" in test.columns:
        return test.select("user_id", "item_id", "rating")
    return test.select("user_id", "item_id", F.lit(None).cast("double").alias("rating"))


def pred_global(train: DataFrame, test: DataFrame) -> DataFrame:
    return _out(_test_cols(test), global_avg(train))


def pred_user(train: DataFrame, test: DataFrame) -> DataFrame:
    ua = user_avg(train).select("user_id", "user_avg")
    t = _test_cols(test).join(ua, "user_id", "left")
    return _out(t, F.coalesce("user_avg", global_avg(train)))


def pred_item(train: DataFrame, test: DataFrame) -> DataFrame:
    ia = item_avg(train).select("item_id", "item_avg")
    t = _test_cols(test).join(ia, "item_id", "left")
    return _out(t, F.coalesce("item_avg", global_avg(train)))


def pred_baseline(train: DataFrame, test: DataFrame, dev: DataFrame,
                  averages: DataFrame | None = None) -> DataFrame:
    """User average moved by the item's average normalized deviation."""
    ua = (user_avg(train) if averages is None else averages).select("user_id", "user_avg")
    idv = item_dev(dev).select("item_id", F.col("dev").alias("idev"))
    t = _test_cols(test).join(ua, "user_id", "left").join(idv, "item_id", "left")
    avg = F.coalesce("user_avg", global_avg(train))
    return _out(t, F.when(F.col("idev").isNull(), avg).otherwise(denormalize(avg, "idev")))


def pred_uniform(train: DataFrame, test: DataFrame, dev: DataFrame,
                 averages: DataFrame | None = None) -> DataFrame:
    """Every other rater of the item weighs 1: the mean deviation of the other raters.

    Computed from per-item sums minus the user's own rating of the item (if any), so no
    pair is ever formed. A user absent from train has no neighbours.
    """
    ua = (user_avg(train) if averages is None else averages).select("user_id", "user_avg")
    sums = dev.groupBy("item_id").agg(F.sum("dev").alias("_s"), F.count(F.lit(1)).alias("_n"))
    own = dev.select("user_id", "item_id", F.col("dev").alias("_own"))
    t = (_test_cols(test).join(ua, "user_id", "left").join(sums, "item_id", "left")
         .join(own, ["user_id", "item_id"], "left"))
    num = F.col("_s") - F.coalesce("_own", F.lit(0.0))
    den = F.col("_n") - F.when(F.col("_own").isNull(), 0).otherwise(1)
    d = F.when(F.col("user_avg").isNull(), F.lit(0.0)).otherwise(weighted_deviation(num, den))
    return _out(t, denormalize(F.coalesce("user_avg", global_avg(train)), d))


def rater_sums(test: DataFrame, edges: DataFrame, dev: DataFrame) -> DataFrame:
    """As ``neighbour_sums``, for users with very many neighbours: the test pairs meet the raters
    of their item first, then the edge of each (user, rater). A user has far more neighbours
    in such a graph than an item has raters; a popular item's rows are split by adaptive
    execution."""
    d = dev.select(F.col("user_id").alias("neighbor_id"), "item_id", "dev")
    return (test.select("user_id", "item_id").join(d, "item_id")
            .join(edges.select("user_id", "neighbor_id", "sim"), ["user_id", "neighbor_id"])
            .groupBy("user_id", "item_id")
            .agg(F.sum(F.col("sim") * F.col("dev")).alias("num"), F.sum(F.abs("sim")).alias("den")))


def neighbour_sums(test: DataFrame, edges: DataFrame, dev: DataFrame) -> DataFrame:
    """(user_id, item_id, num, den): sum(s * dev_v,i) and sum(|s|) over the user's
    neighbours v who rated the item.

    An edge takes its user's test items along as lists (``_lists``) to its neighbour's deviations, so what is shuffled
    is a row per edge and list, not one per edge and test item, most of which no neighbour rated. No step
    fans out on a popular item.
    """
    e = edges.select("user_id", "neighbor_id", "sim")
    d = dev.select(F.col("user_id").alias("neighbor_id"), "item_id", "dev")
    return (e.join(_lists(test), "user_id").join(d, "neighbor_id")
            .where(F.array_contains("_asked", F.col("item_id")))
            .groupBy("user_id", "item_id")
            .agg(F.sum(F.col("sim") * F.col("dev")).alias("num"),
                 F.sum(F.abs("sim")).alias("den")))


def _lists(test: DataFrame) -> DataFrame:
    """(user_id, _asked): each user's different test items, dealt into lists of about ``LIST_ITEMS``."""
    asked = test.select("user_id", "item_id").where("item_id IS NOT NULL")
    n = F.count(F.lit(1)).over(Window.partitionBy("user_id"))
    part = F.pmod(F.xxhash64("item_id"), F.ceil(F.col("_n") / LIST_ITEMS))
    return (asked.withColumn("_n", n).withColumn("_part", part)
            .groupBy("user_id", "_part").agg(F.collect_set("item_id").alias("_asked")).select("user_id", "_asked"))


def pred_weighted(train: DataFrame, test: DataFrame, dev: DataFrame, edges: DataFrame,
                  all_neighbours: bool = False, averages: DataFrame | None = None) -> DataFrame:
    """Similarity-weighted prediction over ``edges`` (user_id, neighbor_id, sim); with
    ``all_neighbours`` through ``rater_sums``. ``averages`` (user_id, user_avg) of the test's
    users, if they are known already."""
    t = _test_cols(test)
    return pred_sums(train, t, (rater_sums if all_neighbours else neighbour_sums)(t, edges, dev), averages)


def pred_sums(train: DataFrame, test: DataFrame, sums: DataFrame, averages: DataFrame | None = None) -> DataFrame:
    """Prediction from the weighted ``sums`` (user_id, item_id, num, den) of the test pairs that have any."""
    ua = (user_avg(train) if averages is None else averages).select("user_id", "user_avg")
    j = _test_cols(test).join(sums, ["user_id", "item_id"], "left").join(ua, "user_id", "left")
    avg = F.coalesce("user_avg", global_avg(train))
    return _out(j, denormalize(avg, weighted_deviation("num", "den")))


def point(spark: SparkSession, user, item) -> DataFrame:
    """A one-row request table (user_id, item_id, rating NULL)."""
    return spark.range(1).select(F.lit(user).cast("bigint").alias("user_id"),
                                 F.lit(item).cast("bigint").alias("item_id"),
                                 F.lit(None).cast("double").alias("rating"))


def pred_weighted_per(train: DataFrame, test: DataFrame, dev: DataFrame, edges: DataFrame,
                      key: str, values: list[int]) -> DataFrame:
    """Weighted predictions for several graphs at once: ``edges`` (user_id, neighbor_id,
    sim, ``key``) holds one graph per value of ``key`` (e.g. k, replication level); every
    test row is scored once per value. Output: key, user_id, item_id, rating, prediction.
    """
    values = sorted(set(values))
    e = (edges.groupBy("user_id", "neighbor_id")
         .agg(F.max("sim").alias("sim"), F.bit_or(graph_bits([F.col(key) == v for v in values])).alias("_bits")))
    return pred_weighted_bits(train, test, dev, e, key, values)


def graph_bits(members: list[Column]) -> Column:
    """The graphs an edge belongs to as bits of one number (62 graphs at most)."""
    if len(members) > 62:
        raise ValueError(f"62 graphs at most, not {len(members)}")
    return reduce(lambda x, y: x.bitwiseOR(y), [F.when(m, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
                                                for i, m in enumerate(members)])


def pred_weighted_bits(train: DataFrame, test: DataFrame, dev: DataFrame, edges: DataFrame,
                       key: str, values: list[int]) -> DataFrame:
    """As ``pred_weighted_per`` for ``edges`` (user_id, neighbor_id, sim, _bits), one row per edge: bit i of ``_bits``
    says whether it belongs to the graph of the i-th of ``values``.

    An edge takes its user's test items along as one list to its neighbour's deviations; what is found there goes
    back to the user once, whatever the number of graphs, and is summed for each of them.
    """
    t = _test_cols(test)
    asked = t.groupBy("user_id").agg(F.collect_set("item_id").alias("_asked"))
    d = dev.select(F.col("user_id").alias("neighbor_id"), "item_id", "dev")
    hits = (edges.select("user_id", "neighbor_id", "sim", "_bits").join(asked, "user_id").join(d, "neighbor_id")
            .where(F.array_contains("_asked", F.col("item_id")))
            .select("user_id", "item_id", "sim", "dev", "_bits").repartition("user_id"))
    at = [F.col("_bits").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0 for i in range(len(values))]
    sums = hits.groupBy("user_id", "item_id").agg(
        *[F.sum(F.when(m, F.col("sim") * F.col("dev"))).alias(f"_n{i}") for i, m in enumerate(at)],
        *[F.sum(F.when(m, F.abs("sim"))).alias(f"_d{i}") for i, m in enumerate(at)])
    ua = user_avg(train).select("user_id", "user_avg")
    avg = F.coalesce("user_avg", global_avg(train))
    per = F.explode(F.array(*[F.struct(F.lit(v).cast("bigint").alias("key"), F.col(f"_n{i}").alias("num"), F.col(f"_d{i}").alias("den"))
                              for i, v in enumerate(values)])).alias("_x")
    j = t.join(sums, ["user_id", "item_id"], "left").join(ua, "user_id", "left").select(
        "user_id", "item_id", "rating", "user_avg", per)
    return j.select(F.col("_x.key").alias(key), "user_id", "item_id", "rating",
                    denormalize(avg, weighted_deviation("_x.num", "_x.den")).alias("prediction"))
