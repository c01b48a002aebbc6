"""Ratings tables: ``user_id BIGINT, item_id BIGINT, rating DOUBLE``, one row per (user, item)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cofi.functions import RATING_HI, RATING_LO, checked_rating, in_range, safe_int
from cofi.session import table_path

RATINGS_SCHEMA = "user_id BIGINT, item_id BIGINT, rating DOUBLE"
RATING_COLS = ["user_id", "item_id", "rating"]


def parse_rating_lines(lines: DataFrame, sep: str = "\t", col: str = "value") -> DataFrame:
    """Delimited lines to ratings.

    Fields are split on the ``sep`` regular expression and trimmed; a line whose first field
    is not an integer (header, blank line) is dropped; ids are 64-bit; further columns
    (timestamp) are ignored. Item and rating are cast strictly, so a malformed data line fails the job instead of
    vanishing.
    """
    parts = F.split(F.col(col), sep)
    first = F.trim(parts.getItem(0))
    return (lines
            .where(safe_int(first).isNotNull())
            .select(safe_int(first).alias("user_id"),
                    F.trim(parts.getItem(1)).cast("bigint").alias("item_id"),
                    F.trim(parts.getItem(2)).cast("double").alias("rating")))


def judge_rating_lines(lines: DataFrame, sep: str = "\t", col: str = "value",
                       lo: float = RATING_LO, hi: float = RATING_HI) -> DataFrame:
    """(user_id, item_id, rating, line, reason): every line once. ``reason`` is NULL for a rating, otherwise
    the first of: ``user`` (the first field is not an integer: header, blank or null line), ``fields`` (fewer
    than three), ``item`` (not an integer), ``rating`` (not a number), ``unrated`` (zero), ``scale`` (outside
    [lo, hi], NaN too). Nothing is dropped and no line stops the job."""
    parts = F.split(F.col(col), sep)
    field = lambda i: F.trim(F.get(parts, F.lit(i)))
    user, item, rating = safe_int(field(0)), safe_int(field(1)), field(2).try_cast("double")
    x = lines.select(user.alias("user_id"), item.alias("item_id"), rating.alias("rating"), F.col(col).alias("line"),
                     F.size(parts).alias("_n"))
    reason = (F.when(F.col("user_id").isNull(), "user").when(F.col("_n") < 3, "fields")
              .when(F.col("item_id").isNull(), "item").when(F.col("rating").isNull(), "rating")
              .when(F.col("rating") == 0, "unrated").when(~in_range("rating", lo, hi), "scale"))
    return x.withColumn("reason", reason).drop("_n")


def load_with_rejects(spark: SparkSession, path: str, sep: str = "\t", lo: float = RATING_LO,
                      hi: float = RATING_HI) -> tuple[DataFrame, DataFrame]:
    """(ratings, rejects) of text files in one pass: the judged lines are written once to the shared folder,
    split by whether they were rejected, and each table reads its half only. ``rejects``: (line, reason)."""
    judged = judge_rating_lines(spark.read.text(path), sep, lo=lo, hi=hi).withColumn(
        "rejected", F.col("reason").isNotNull())
    out = table_path(spark, "judged_lines")
    judged.write.partitionBy("rejected").parquet(out)
    both = spark.read.schema(judged.schema).parquet(out)
    return both.where("NOT rejected").select(*RATING_COLS), both.where("rejected").select("line", "reason")


def clean_ratings(df: DataFrame, drop_zero: bool = True, null_ratings: str = "fail",
                  lo: float = RATING_LO, hi: float = RATING_HI) -> DataFrame:
    """What every loader does with the values: a zero means "not rated" and is dropped unless
    ``drop_zero`` is False; a missing rating stops the job, or is dropped with
    ``null_ratings="drop"``; any other rating outside [lo, hi] stops the job."""
    if null_ratings not in ("fail", "drop"):
        raise ValueError(f"null_ratings is 'fail' or 'drop', not {null_ratings!r}")
    if null_ratings == "drop":
        df = df.where(F.col("rating").isNotNull())
    rating = checked_rating("rating", lo, hi)
    if drop_zero:
        df = df.where(F.col("rating").isNull() | (F.col("rating") != 0))
    else:
        rating = F.when(F.col("rating") == 0, F.col("rating")).otherwise(rating)
    return df.select("user_id", "item_id", rating.alias("rating"))


def load_ratings_text(spark: SparkSession, path: str, sep: str = "\t",
                      n_users: int | None = None, n_items: int | None = None, **clean) -> DataFrame:
    """Tab- or ``::``-separated text files (any Hadoop path, directory or glob).

    ``n_users`` / ``n_items`` optionally keep only ids in 1..n (the declared matrix
    dimensions of a dataset); ids are never renumbered. ``clean``: see ``clean_ratings``.
    """
    df = parse_rating_lines(spark.read.text(path), sep)
    if n_users is not None:
        df = df.where(F.col("user_id").between(1, n_users))
    if n_items is not None:
        df = df.where(F.col("item_id").between(1, n_items))
    return clean_ratings(df, **clean)


def load_ratings(spark: SparkSession, path: str, fmt: str = "parquet", sep: str = ",",
                 user_col: str = "user_id", item_col: str = "item_id",
                 rating_col: str = "rating", **clean) -> DataFrame:
    """Ratings from parquet, CSV or delimited text, projected to the ratings schema.

    Only the three needed columns are read (the scan's ReadSchema shows it). ``clean``: see
    ``clean_ratings``.
    """
    if fmt == "text":
        return load_ratings_text(spark, path, sep, **clean)
    if fmt == "csv":
        raw = spark.read.option("header", "true").option("sep", sep).csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    return clean_ratings(raw.select(F.col(user_col).cast("bigint").alias("user_id"),
                                    F.col(item_col).cast("bigint").alias("item_id"),
                                    F.col(rating_col).cast("double").alias("rating")), **clean)


def only(df: DataFrame, users) -> DataFrame:
    """The rows of the requested users: one id, a list of ids (a filter that reaches the scan),
    or a DataFrame (user_id)."""
    if isinstance(users, DataFrame):
        return df.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return df.where(F.col("user_id").isin([users] if isinstance(users, int) else list(users)))


def dedupe(df: DataFrame, policy: str = "last", order_cols: list[str] | None = None) -> DataFrame:
    """One row per (user, item).

    ``last`` keeps the rating with the greatest ``order_cols`` (e.g. timestamp, event id),
    ``max`` / ``avg`` / ``sum`` combine the duplicates. Written as a grouped aggregate, so
    Spark combines map-side before the shuffle and a hot user or item never collects its
    rows in one place.
    """
    keys = ["user_id", "item_id"]
    if policy == "last":
        if not order_cols:
            raise ValueError("policy 'last' needs order_cols")
        agg = F.max_by("rating", F.struct(*order_cols))
    elif policy == "max":
        agg = F.max("rating")
    elif policy == "avg":
        agg = F.avg("rating")
    elif policy == "sum":
        agg = F.sum("rating")
    else:
        raise ValueError(f"unknown dedupe policy {policy!r}")
    return df.groupBy(*keys).agg(agg.cast("double").alias("rating"))


# The deterministic train / test split used by every query
# (test when (user_id * 31 + item_id * 17) % 5 == 0).
SPLIT_USER_MUL = 31
SPLIT_ITEM_MUL = 17
SPLIT_MOD = 5


def split_test_predicate(user="user_id", item="item_id"):
    return ((F.col(user) * SPLIT_USER_MUL + F.col(item) * SPLIT_ITEM_MUL) % SPLIT_MOD) == 0


def split_train_test(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hash split: a row-local predicate, so both halves are plain filters of one scan."""
    is_test = split_test_predicate()
    return ratings.where(~is_test), ratings.where(is_test)


def append_user(ratings: DataFrame, extra: DataFrame) -> DataFrame:
    """Union of a ratings table and another user's ratings (by column name)."""
    return ratings.select(*RATING_COLS).unionByName(extra.select(*RATING_COLS))


def expect_rows(df: DataFrame, expected: int | Column) -> DataFrame:
    """``df`` with a lazy row-count assertion: the job fails if the count differs from a number
    or a scalar subquery."""
    n = df.select(F.count(F.lit(1))).scalar()
    want = expected if isinstance(expected, Column) else F.lit(expected)
    return df.where(F.assert_true(n == want, F.concat(F.lit("rows expected: "), want.cast("string"))).isNull())
