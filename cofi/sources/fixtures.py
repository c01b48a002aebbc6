"""Ratings derived from the business tables under an ``sf`` directory.

* orders: a customer rates a part by the quantity bought, max over repeated purchases
  (sparse: many users and items, few ratings each).
* events: a user rates the item in ``props.k`` by the event value, the latest event wins
  (dense: 100 items).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cofi.sources.ratings import dedupe


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_custkey, l_partkey) -> max(1 + floor((l_quantity - 1) / 10)).

    lineitem joins orders on the order key (a shuffle join at scale, both sides pruned to
    the needed columns); the max is a grouped aggregate with map-side combine.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rated = (li.join(od, li.l_orderkey == od.o_orderkey)
             .select(F.col("o_custkey").alias("user_id"),
                     F.col("l_partkey").alias("item_id"),
                     (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double").alias("rating")))
    return dedupe(rated, "max")


def rated_pairs(spark: SparkSession, sf_dir: str) -> Column:
    """Scalar: how many (customer, part) pairs the sources hold, without the ratings."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey).select("o_custkey", "l_partkey").distinct()
            .select(F.count(F.lit(1))).scalar())


def events_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, props.k) -> min(5, 1 + floor(value / 20)) of the latest event (ts, event_id)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    rated = ev.select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.least(F.lit(5.0), (F.floor(F.col("value") / 20) + 1).cast("double")).alias("rating"),
        "ts", "event_id")
    return dedupe(rated, "last", ["ts", "event_id"])


def rating_lines_from(ratings: DataFrame, sep: str = "\t") -> DataFrame:
    """Ratings rendered back as delimited text lines (``user sep item sep rating sep 0``)."""
    return ratings.select(F.concat_ws(sep, "user_id", "item_id", "rating", F.lit("0")).alias("value"))


def damaged_lines_from(ratings: DataFrame, sep: str = "\t") -> DataFrame:
    """One unusable line per rating: by (user + item) mod 7 its user, item or rating is not a number, the rating
    is missing, zero or outside the scale, or the line is blank."""
    line = lambda *parts: F.concat_ws(sep, *[F.lit(p) if p not in ratings.columns else p for p in parts])
    kinds = F.array(line("user", "item_id", "rating", "0"), line("user_id", "x1", "rating", "0"),
                    line("user_id", "item_id", "three", "0"), line("user_id", "item_id"),
                    line("user_id", "item_id", "0", "0"), line("user_id", "item_id", "9", "0"), F.lit(""))
    return ratings.select(F.get(kinds, F.pmod(F.col("user_id") + F.col("item_id"), F.lit(7)).cast("int")).alias("value"))


def personal_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A personal ratings table built from ``part``: every part is listed with its name,
    and parts whose key is a multiple of 10 carry the rating 1 + key % 5."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return part.select(
        F.col("p_partkey").cast("bigint").alias("id"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_partkey") % 10 == 0, (F.col("p_partkey") % 5 + 1).cast("double"))
         .alias("rating"))
