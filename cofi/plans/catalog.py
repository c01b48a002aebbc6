"""Named queries over the sf tables: ``queries()`` (Spark) and ``oracle_sql()`` (DuckDB).

Fixtures: ``o`` = orders ratings (sparse, customers x parts), ``e`` = events ratings
(dense, 100 items); both split into train / test by the hash of (user, item). Every
computed column is rounded to 6 decimals so both engines agree on the digits.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cofi.functions import round_out
from cofi.operators import approx, knn as knn_ops, metrics, predict, recommend, similarity, stats
from cofi.plans import oracle as O
from cofi.session import materialize, table_path
from cofi.sources import (
    append_user,
    damaged_lines_from,
    events_ratings,
    expect_rows,
    load_personal_csv,
    load_ratings,
    load_ratings_text,
    load_with_rejects,
    only,
    orders_ratings,
    parse_rating_lines,
    personal_from_parts,
    personal_ratings,
    rated_pairs,
    rating_lines_from,
    split_train_test,
)
from cofi.sources.ratings import split_test_predicate
from cofi.sources.sinks import answers_table, nested_answers, run_metadata, run_parameters

D = 6  # output decimals

# Query parameters (the reference's defaults where it has them).
K = 10
K_LARGE = 400
K_SWEEP = 300
K_LIST = [10, 30, 50, 100, 200, 300, 400, 800, 943]
PARTITIONS = 10
REPLICATION = 2
REPLICATIONS = [1, 2, 3, 4, 6, 8]
TOP_N = 3
JACCARD_LEAST = 0.4
USER, USER2, ITEM = 1, 2, 1
N_USERS, N_ITEMS, NEW_USER = 100, 150, 944


def R(c) -> F.Column:
    return round_out(c, D)


class Fixture:
    """Train / test and the derived tables of one fixture.

    Nothing runs when it is built. With ``shared`` (several branches of the query read the
    ratings) the derived ratings are written once to the checkpoint folder at first use; without,
    a query's filters reach the source scan. Deviations and preprocessed ratings are tables
    of their own, each written at first use.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, fix: str, shared: bool = False):
        self.spark, self.sf_dir, self.fix, self.shared = spark, sf_dir, fix, shared

    @cached_property
    def ratings(self) -> DataFrame:
        raw = orders_ratings(self.spark, self.sf_dir) if self.fix == "o" else events_ratings(self.spark, self.sf_dir)
        return materialize(raw, f"ratings_{self.fix}") if self.shared else raw

    @property
    def train(self) -> DataFrame:
        return split_train_test(self.ratings)[0]

    @property
    def test(self) -> DataFrame:
        return split_train_test(self.ratings)[1]

    @cached_property
    def dev(self) -> DataFrame:
        dev = stats.norm_dev(self.train)
        return materialize(dev, f"dev_{self.fix}") if self.shared else dev

    @cached_property
    def rhat(self) -> DataFrame:
        rhat = stats.preprocessed(self.dev)
        return materialize(rhat, f"rhat_{self.fix}") if self.shared else rhat

    @property
    def users(self) -> DataFrame:
        return self.train.select("user_id").distinct()

    @property
    def averages(self) -> DataFrame:
        """(user_id, user_avg), which the deviations carry."""
        return self.dev.groupBy("user_id").agg(F.max("user_avg").alias("user_avg"))

    def cosine_edges(self) -> DataFrame:
        return similarity.cosine_edges(self.rhat)

    def knn(self, k: int) -> DataFrame:
        return knn_ops.knn_graph(self.rhat, k, stats.n_users(self.train) - 1)

    def weights(self, edges: DataFrame) -> DataFrame:
        return edges.select(F.col("u").alias("user_id"), F.col("v").alias("neighbor_id"), "sim")

    def predict(self, edges: DataFrame) -> DataFrame:
        return predict.pred_weighted(self.train, self.test, self.dev, edges, averages=self.averages)

    def predict_cosine(self) -> DataFrame:
        """With all neighbours as weights: the similarities are used where they are formed."""
        return predict.pred_sums(self.train, self.test, similarity.cosine_sums(self.rhat, self.test), self.averages)

    def predict_jaccard(self) -> DataFrame:
        return predict.pred_sums(self.train, self.test, similarity.jaccard_sums(self.train, self.dev, self.test), self.averages)


def _preds_out(p: DataFrame) -> DataFrame:
    return p.select("user_id", "item_id", "rating", R("prediction").alias("prediction"))


def _edges_out(e: DataFrame) -> DataFrame:
    return e.select("u", "v", R("sim").alias("sim"))


def _graph_out(g: DataFrame) -> DataFrame:
    return g.select("user_id", "neighbor_id", R("sim").alias("sim"), "rank")


# ----------------------------------------------------------------------------- sources

def q_ratings_orders(spark, sf):
    return orders_ratings(spark, sf)


def q_ratings_events(spark, sf):
    return events_ratings(spark, sf)


def q_load_delimited_lines(spark, sf):
    lines = rating_lines_from(orders_ratings(spark, sf))
    junk = spark.createDataFrame([("user\titem\trating",), ("",)], "value STRING")
    return parse_rating_lines(lines.unionByName(junk), "\t")


def q_personal_ratings(spark, sf):
    r = orders_ratings(spark, sf)
    uid = r.select(F.max("user_id") + 1).scalar()
    return personal_ratings(personal_from_parts(spark, sf), uid)


# ----------------------------------------------------------------------------- averages

def q_global_avg(spark, sf):
    g = stats.global_stats(Fixture(spark, sf, "o").train)
    return g.select(R("global_avg").alias("global_avg"), "n_ratings", "n_users", "n_items")


def q_user_avg(spark, sf):
    return stats.user_avg(Fixture(spark, sf, "o").train).select(
        "user_id", R("user_avg").alias("user_avg"), "n")


def q_item_avg(spark, sf):
    return stats.item_avg(Fixture(spark, sf, "o").train).select(
        "item_id", R("item_avg").alias("item_avg"), "n")


def q_user_avg_point(spark, sf):
    return stats.user_avg_point(Fixture(spark, sf, "o").train, USER).select(
        "user_id", R("user_avg").alias("user_avg"))


def q_item_avg_point(spark, sf):
    return stats.item_avg_point(Fixture(spark, sf, "o").train, ITEM).select(
        "item_id", R("item_avg").alias("item_avg"))


def q_rating_or_user_avg(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    return stats.rating_or_user_avg(fx.train, fx.ratings).select(
        "user_id", "item_id", R("value").alias("value"))


def q_norm_dev(spark, sf):
    return Fixture(spark, sf, "o").dev.select("user_id", "item_id", R("dev").alias("dev"))


def q_item_dev(spark, sf):
    return stats.item_dev(Fixture(spark, sf, "o").dev).select("item_id", R("dev").alias("dev"), "n")


def q_item_dev_point(spark, sf):
    return stats.item_dev_point(stats.dev_of_item(Fixture(spark, sf, "o").train, ITEM), ITEM).select(
        "item_id", R("dev").alias("dev"))


def q_user_norm(spark, sf):
    return stats.user_norm(Fixture(spark, sf, "o").dev).select("user_id", R("norm").alias("norm"))


def q_preprocessed_ratings(spark, sf):
    return Fixture(spark, sf, "o").rhat.select("user_id", "item_id", R("rhat").alias("rhat"))


def q_item_raters(spark, sf):
    return stats.adjacency(Fixture(spark, sf, "e").train, "item_id", "user_id")


def q_user_items(spark, sf):
    return stats.adjacency(Fixture(spark, sf, "e").train, "user_id", "item_id")


def q_metric_mean_std(spark, sf):
    tr = Fixture(spark, sf, "o", shared=True).train
    return metrics.mean_std({
        "rating": tr.select(F.col("rating").alias("x")),
        "user_avg": stats.user_avg(tr).select(F.col("user_avg").alias("x")),
        "item_avg": stats.item_avg(tr).select(F.col("item_avg").alias("x")),
    }).select("metric", R("mean").alias("mean"), R("std").alias("std"))


# ----------------------------------------------------------------------------- baseline predictors

def _baseline_preds(fx: Fixture) -> dict[str, DataFrame]:
    return {
        "global": predict.pred_global(fx.train, fx.test),
        "user": predict.pred_user(fx.train, fx.test),
        "item": predict.pred_item(fx.train, fx.test),
        "baseline": predict.pred_baseline(fx.train, fx.test, fx.dev, fx.averages),
    }


def q_pred_global(spark, sf):
    fx = Fixture(spark, sf, "o", shared=True)
    return _preds_out(predict.pred_global(fx.train, fx.test))


def q_pred_user(spark, sf):
    fx = Fixture(spark, sf, "o", shared=True)
    return _preds_out(predict.pred_user(fx.train, fx.test))


def q_pred_item(spark, sf):
    fx = Fixture(spark, sf, "o", shared=True)
    return _preds_out(predict.pred_item(fx.train, fx.test))


def q_pred_baseline(spark, sf):
    fx = Fixture(spark, sf, "o", shared=True)
    return _preds_out(predict.pred_baseline(fx.train, fx.test, fx.dev, fx.averages))


def q_pred_baseline_point(spark, sf):
    fx = Fixture(spark, sf, "o")
    p = predict.pred_baseline(fx.train, predict.point(spark, USER, ITEM), stats.dev_of_item(fx.train, ITEM),
                              stats.user_avg(only(fx.train, USER)))
    return p.select("user_id", "item_id", R("prediction").alias("prediction"))


def q_mae_nonpersonalized(spark, sf):
    return metrics.mae_by_method(_baseline_preds(Fixture(spark, sf, "o", shared=True))).select(
        "method", R("mae").alias("mae"))


def q_out_of_range_predictions(spark, sf):
    return metrics.out_of_range(_baseline_preds(Fixture(spark, sf, "o", shared=True)))


# ----------------------------------------------------------------------------- similarities

def q_sim_cosine(spark, sf):
    return _edges_out(Fixture(spark, sf, "o", shared=True).cosine_edges())


def q_sim_cosine_pair(spark, sf):
    return _edges_out(similarity.sim_cosine_pair(
        stats.enrich(only(Fixture(spark, sf, "e").train, [USER, USER2])), USER, USER2))


def q_sim_one_user(spark, sf):
    train = Fixture(spark, sf, "e").train
    near = materialize(stats.enrich(only(train, similarity.co_raters(train, USER))), "near")
    return _edges_out(similarity.sim_one_user(near, USER))


def q_sim_jaccard(spark, sf):
    return _edges_out(similarity.jaccard_edges(Fixture(spark, sf, "e", shared=True).train))


def q_sim_jaccard_pair(spark, sf):
    return _edges_out(similarity.sim_jaccard_pair(Fixture(spark, sf, "e").train, USER, USER2))


def q_sim_jaccard_above(spark, sf):
    return _edges_out(similarity.jaccard_at_least(Fixture(spark, sf, "e", shared=True).train, JACCARD_LEAST))


def _personal_preds(fx: Fixture) -> dict[str, DataFrame]:
    return {
        "uniform": predict.pred_uniform(fx.train, fx.test, fx.dev, fx.averages),
        "cosine": fx.predict_cosine(),
        "jaccard": fx.predict_jaccard(),
    }


def q_pred_uniform(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    return _preds_out(predict.pred_uniform(fx.train, fx.test, fx.dev, fx.averages))


def q_pred_cosine(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    return _preds_out(fx.predict_cosine())


def q_pred_jaccard(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    return _preds_out(fx.predict_jaccard())


def q_pred_points(spark, sf):
    """Every predictor for one request: only the rows of users who share an item with the user."""
    fx = Fixture(spark, sf, "e", shared=True)
    pt = predict.point(spark, USER, ITEM)
    graph, near = knn_ops.knn_of(fx.train, USER, K)
    own = stats.user_avg(only(fx.train, USER))
    of_item = materialize(stats.dev_of_item(fx.train, ITEM), "dev_of_item")
    one = lambda edges: predict.pred_weighted(fx.train, pt, near, edges, averages=own)
    preds = {
        "uniform": predict.pred_uniform(fx.train, pt, of_item, own),
        "cosine": one(fx.weights(similarity.cosine_of(near, USER))),
        "jaccard": one(fx.weights(similarity.jaccard_of(near, USER))),
        "baseline": predict.pred_baseline(fx.train, pt, of_item, own),
        "knn": one(knn_ops.as_edges(graph)),
    }
    out = None
    for name, p in preds.items():
        part = p.select(F.lit(name).alias("method"), "user_id", "item_id",
                        R("prediction").alias("prediction"))
        out = part if out is None else out.unionByName(part)
    return out


def q_mae_personalized(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    return metrics.mae_by_method(_personal_preds(fx)).select("method", R("mae").alias("mae"))


# ----------------------------------------------------------------------------- kNN

def q_knn_graph(spark, sf):
    return _graph_out(Fixture(spark, sf, "o", shared=True).knn(K))


def q_knn_graph_k400(spark, sf):
    return _graph_out(Fixture(spark, sf, "o", shared=True).knn(K_LARGE))


def q_knn_with_new_user(spark, sf):
    """The graph of all ratings after a user was appended: the others' lists are kept and extended."""
    r = materialize(orders_ratings(spark, sf), "ratings_o")
    rhat = materialize(stats.enrich(r).select("user_id", "item_id", "rhat"), "enriched")
    lists = knn_ops.knn_lists(rhat, K)
    uid = r.agg(F.max("user_id")).first()[0] + 1
    data = append_user(r, personal_ratings(personal_from_parts(spark, sf), uid))
    lists = knn_ops.with_new_users(lists, data, spark.range(uid, uid + 1).toDF("user_id"), K, rhat)
    return _graph_out(knn_ops.merged(lists, K, stats.n_users(data) - 1))


def q_knn_pair_lookup(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    pairs = fx.users.select(F.lit(USER).cast("bigint").alias("u"), F.col("user_id").alias("v"))
    return _edges_out(knn_ops.knn_lookup(knn_ops.knn_of(fx.train, USER, K)[0], pairs))


def q_pred_knn(spark, sf):
    fx = Fixture(spark, sf, "o", shared=True)
    return _preds_out(fx.predict(knn_ops.as_edges(fx.knn(K))))


def q_pred_knn_point(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    graph, near = knn_ops.knn_of(fx.train, USER, K)
    p = predict.pred_weighted(fx.train, predict.point(spark, USER, ITEM), near, knn_ops.as_edges(graph),
                              averages=stats.user_avg(only(fx.train, USER)))
    return p.select("user_id", "item_id", R("prediction").alias("prediction"))


def q_mae_knn_by_k(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    return metrics_by_k(fx, K_LIST)


def metrics_by_k(fx: Fixture, ks: list[int]) -> DataFrame:
    """(k, mae) for several k at once: rank once with max(k); a neighbour of rank r counts
    for every k >= r."""
    ks = sorted(set(ks))
    graph = fx.knn(max(ks)).select("user_id", "neighbor_id", "sim",
                                   predict.graph_bits([F.col("rank") <= k for k in ks]).alias("_bits"))
    p = predict.pred_weighted_bits(fx.train, fx.test, fx.dev, graph, "k", ks)
    return p.groupBy("k").agg(R(F.avg(F.abs(F.col("rating") - F.col("prediction")))).alias("mae"))


# ----------------------------------------------------------------------------- recommendation

def q_unseen_items(spark, sf):
    return recommend.unseen_items(Fixture(spark, sf, "e").train, USER)


def q_recommend_user(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    return recommend.recommend_user(fx.train, USER, K, TOP_N)


def q_recommend_all(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    return recommend.recommend_all(fx.train, fx.dev, knn_ops.as_edges(fx.knn(K)), TOP_N)


def q_recommend_new_user(spark, sf):
    r = materialize(orders_ratings(spark, sf), "ratings_o")
    uid = r.agg(F.max("user_id")).first()[0] + 1
    personal = personal_from_parts(spark, sf)
    # the other users' rows do not change: those who share an item with the new user are read
    data = append_user(r, personal_ratings(personal, uid))
    rec = recommend.recommend_user(data, uid, K_SWEEP, TOP_N)
    titles = personal.select(F.col("id").alias("item_id"), "title")
    return rec.join(titles, "item_id", "left").select("rank", "item_id", "title", "prediction")


# ----------------------------------------------------------------------------- approximate kNN

def q_user_bins(spark, sf):
    return approx.user_bins(Fixture(spark, sf, "o").users, PARTITIONS, REPLICATION)


def q_knn_approx(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    return _graph_out(approx.knn_approx(fx.rhat, fx.users, K, PARTITIONS, REPLICATION))


def q_pred_knn_approx(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    g = approx.knn_approx(fx.rhat, fx.users, K, PARTITIONS, REPLICATION)
    return _preds_out(fx.predict(knn_ops.as_edges(g)))


def q_mae_knn_approx(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    g = approx.knn_approx(fx.rhat, fx.users, K, PARTITIONS, REPLICATION)
    return metrics.mae(fx.predict(knn_ops.as_edges(g))).select(R("mae").alias("mae"))


def q_mae_by_replication(spark, sf):
    fx = Fixture(spark, sf, "e", shared=True)
    g = approx.replication_sweep_graph(fx.rhat, fx.users, K_SWEEP, PARTITIONS, REPLICATIONS)
    p = predict.pred_weighted_per(fx.train, fx.test, fx.dev, g, "replication", REPLICATIONS)
    return p.groupBy("replication").agg(
        R(F.avg(F.abs(F.col("rating") - F.col("prediction")))).alias("mae"))


# ----------------------------------------------------------------------------- report

def q_answers_json(spark, sf):
    """One JSON object per section; numbers as text with six decimals, the same in any engine.
    The report refuses to run on a ratings table that lost rows: their number must be that of
    the (customer, part) pairs of the sources."""
    fx = Fixture(spark, sf, "o", shared=True)
    train, _ = split_train_test(expect_rows(fx.ratings, rated_pairs(spark, sf)))
    part = lambda section, df, metric, value: df.select(
        F.lit(section).alias("section"), metric.alias("metric"), R(value).alias("value"))
    base = part("B.2", metrics.mae_by_method(_baseline_preds(fx)), F.col("method"), "mae")
    g = part("B.1", stats.global_stats(train), F.lit("global_avg"), "global_avg")
    kn = part("N.1", metrics.mae(fx.predict(knn_ops.as_edges(fx.knn(K)))), F.lit(f"mae_k{K}"), "mae")
    return nested_answers(answers_table(g, base, kn), decimals=D).unionByName(
        nested_answers(run_parameters(spark, k=K, partitions=PARTITIONS, replication=REPLICATION)))


def q_report_run(spark, sf):
    """The report's "Meta" block in full: parameters, size of the input, and the machine (no SQL: it names this
    session's master and executors)."""
    fx = Fixture(spark, sf, "o", shared=True)
    sizes = fx.ratings.select(F.lit("Meta").alias("section"), F.when(
        split_test_predicate(), "n_test").otherwise("n_train").alias("metric")).groupBy("section", "metric").agg(
        F.count(F.lit(1)).cast("string").alias("value"))
    params = run_parameters(spark, k=K, partitions=PARTITIONS, replication=REPLICATION)
    return nested_answers(params.unionByName(sizes).unionByName(run_metadata(spark)))


# ----------------------------------------------------------------------------- loaders

def _written(df: DataFrame, name: str, fmt: str) -> str:
    """``df`` as files of a fixture in the shared folder: what a loader then reads."""
    path = table_path(df.sparkSession, name)
    if fmt == "csv":
        df.write.option("header", "true").csv(path)
    else:
        df.write.text(path)
    return path


def _rating_file(spark, sf, sep: str) -> str:
    lines = rating_lines_from(orders_ratings(spark, sf), sep)
    header = spark.range(1).select(F.lit(f"user{sep}item{sep}rating").alias("value"))
    return _written(lines.unionByName(header), "rating_lines", "text")


def q_load_text_tab(spark, sf):
    return load_ratings_text(spark, _rating_file(spark, sf, "\t"))


def q_load_text_colons(spark, sf):
    return load_ratings(spark, _rating_file(spark, sf, "::"), "text", "::")


def q_load_text_dimensions(spark, sf):
    return load_ratings_text(spark, _rating_file(spark, sf, "\t"), n_users=N_USERS, n_items=N_ITEMS)


def q_load_personal_csv(spark, sf):
    path = _written(personal_from_parts(spark, sf), "personal", "csv")
    return personal_ratings(load_personal_csv(spark, path), NEW_USER)


def _mixed_file(spark, sf) -> str:
    """Every rating as a line, and one unusable line per rating."""
    r = materialize(orders_ratings(spark, sf), "ratings_o")
    return _written(rating_lines_from(r).unionByName(damaged_lines_from(r)), "mixed_lines", "text")


def q_load_kept(spark, sf):
    return load_with_rejects(spark, _mixed_file(spark, sf))[0]


def q_load_rejects(spark, sf):
    return load_with_rejects(spark, _mixed_file(spark, sf))[1]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}


# ============================================================================= oracle SQL

def _q(fix: str, extra: list[str], select: str) -> str:
    return O.with_(O.base(fix) + extra, select)


def _expand_rd(sql: str) -> str:
    """RD(x) -> x rounded half up to D decimals in double arithmetic, as the Spark side does."""
    while (i := sql.find("RD(")) >= 0:
        depth, j = 0, i + 2
        while True:
            depth += {"(": 1, ")": -1}.get(sql[j], 0)
            if depth == 0:
                break
            j += 1
        inner = sql[i + 3:j]
        sql = sql[:i] + f"(FLOOR(({inner}) * {10.0 ** D!r} + 0.5) / {10.0 ** D!r})" + sql[j + 1:]
    return sql


def _r(c: str, alias: str | None = None) -> str:
    return f"RD({c}) AS {alias or c.split('.')[-1]}"


_PRED_SEL = f"SELECT user_id, item_id, rating, RD(prediction) AS prediction FROM "
_GRAPH_SEL = f"SELECT user_id, neighbor_id, RD(sim) AS sim, rank FROM "
_EDGE_SEL = f"SELECT u, v, RD(sim) AS sim FROM "
_POINT = f"(SELECT CAST({USER} AS BIGINT) AS user_id, CAST({ITEM} AS BIGINT) AS item_id, CAST(NULL AS DOUBLE) AS rating)"


def _mae_union(names: list[str]) -> str:
    parts = [f"SELECT '{n}' AS method, ABS(rating - prediction) AS err FROM p_{n}" for n in names]
    return (f"SELECT method, RD(AVG(err)) AS mae FROM ({' UNION ALL '.join(parts)}) "
            "GROUP BY method")


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ratings_orders"] = O.ORDERS
    q["ratings_events"] = O.EVENTS
    q["load_delimited_lines"] = O.ORDERS
    q["personal_ratings"] = f"""SELECT (SELECT MAX(user_id) + 1 FROM ({O.ORDERS})) AS user_id,
        p_partkey AS item_id, p_name AS title, CAST(1 + p_partkey % 5 AS DOUBLE) AS rating
        FROM part WHERE p_partkey % 10 = 0"""
    q["global_avg"] = _q("o", [], f"""SELECT RD(AVG(rating)) AS global_avg, COUNT(*) AS n_ratings,
        COUNT(DISTINCT user_id) AS n_users, COUNT(DISTINCT item_id) AS n_items FROM train""")
    q["user_avg"] = _q("o", [], f"SELECT user_id, {_r('user_avg')}, n FROM ua")
    q["item_avg"] = _q("o", [], f"SELECT item_id, {_r('item_avg')}, n FROM ia")
    q["user_avg_point"] = _q("o", [], f"""SELECT CAST({USER} AS BIGINT) AS user_id,
        RD(COALESCE(AVG(rating), 0.0)) AS user_avg FROM train WHERE user_id = {USER}""")
    q["item_avg_point"] = _q("o", [], f"""SELECT CAST({ITEM} AS BIGINT) AS item_id,
        RD(COALESCE(AVG(rating), 0.0)) AS item_avg FROM train WHERE item_id = {ITEM}""")
    q["rating_or_user_avg"] = _q("e", [], f"""SELECT r.user_id, r.item_id,
        RD(COALESCE(t.rating, ua.user_avg)) AS value FROM r
        LEFT JOIN train t ON t.user_id = r.user_id AND t.item_id = r.item_id
        LEFT JOIN ua ON ua.user_id = r.user_id""")
    q["norm_dev"] = _q("o", [], f"SELECT user_id, item_id, {_r('dev')} FROM dev")
    q["item_dev"] = _q("o", [], f"SELECT item_id, {_r('dev')}, n FROM idev")
    q["item_dev_point"] = _q("o", [], f"""SELECT CAST({ITEM} AS BIGINT) AS item_id,
        RD(COALESCE(AVG(dev), 0.0)) AS dev FROM dev WHERE item_id = {ITEM}""")
    q["user_norm"] = _q("o", [], f"SELECT user_id, {_r('norm')} FROM nrm")
    q["preprocessed_ratings"] = _q("o", [], f"SELECT user_id, item_id, {_r('rhat')} FROM rhat")
    for name, key, member in (("item_raters", "item_id", "user_id"), ("user_items", "user_id", "item_id")):
        q[name] = _q("e", [], f"""SELECT {key}, CAST(FLOOR({member} / 1024) AS BIGINT) AS chunk,
            COUNT(*) AS n, string_agg(CAST({member} AS VARCHAR), ',' ORDER BY {member}) AS ids
            FROM train GROUP BY 1, 2""")
    q["metric_mean_std"] = _q("o", [], f"""SELECT metric, RD(COALESCE(AVG(x), 0.0)) AS mean,
        RD(COALESCE(STDDEV_POP(x), 0.0)) AS std FROM (
          SELECT 'rating' AS metric, rating AS x FROM train
          UNION ALL SELECT 'user_avg', user_avg FROM ua
          UNION ALL SELECT 'item_avg', item_avg FROM ia) GROUP BY metric""")

    for m in ("global", "user", "item", "baseline"):
        q[f"pred_{m}"] = _q("o", O.simple_preds(), _PRED_SEL + f"p_{m}")
    q["pred_baseline_point"] = _q("o", [f"pt AS {_POINT}"] + O.simple_preds("pt", "x_"),
                                  f"SELECT user_id, item_id, RD(prediction) AS prediction FROM x_baseline")
    q["mae_nonpersonalized"] = _q("o", O.simple_preds(), _mae_union(["global", "user", "item", "baseline"]))
    q["out_of_range_predictions"] = _q("o", O.simple_preds(), " UNION ALL ".join(
        f"SELECT '{m}' AS method, CAST(SUM(CASE WHEN prediction BETWEEN 1.0 AND 5.0 THEN 0 ELSE 1 END) AS BIGINT) AS n_out FROM p_{m}"
        for m in ("global", "user", "item", "baseline")))

    q["sim_cosine"] = _q("o", [], _EDGE_SEL + "cedges")
    q["sim_cosine_pair"] = _q("e", [], f"""SELECT CAST({USER} AS BIGINT) AS u, CAST({USER2} AS BIGINT) AS v,
        RD(COALESCE(SUM(a.rhat * b.rhat), 0.0)) AS sim
        FROM rhat a JOIN rhat b ON a.item_id = b.item_id WHERE a.user_id = {USER} AND b.user_id = {USER2}""")
    q["sim_one_user"] = _q("e", [], f"""SELECT CAST({USER} AS BIGINT) AS u, b.user_id AS v,
        RD(SUM(a.rhat * b.rhat)) AS sim
        FROM rhat a JOIN rhat b ON a.item_id = b.item_id WHERE a.user_id = {USER} AND b.user_id <> {USER}
        GROUP BY b.user_id""")
    q["sim_jaccard"] = _q("e", [], _EDGE_SEL + "jedges")
    q["sim_jaccard_above"] = _q("e", [], _EDGE_SEL + f"jpairs WHERE sim >= {JACCARD_LEAST}")
    q["sim_jaccard_pair"] = _q("e", [], f"""SELECT CAST({USER} AS BIGINT) AS u, CAST({USER2} AS BIGINT) AS v,
        RD(COALESCE((SELECT CAST(COUNT(*) AS DOUBLE) FROM train a JOIN train b ON a.item_id = b.item_id
                          WHERE a.user_id = {USER} AND b.user_id = {USER2})
          / NULLIF((SELECT COUNT(DISTINCT item_id) FROM train WHERE user_id IN ({USER}, {USER2})), 0), 0.0)) AS sim""")

    personal = (O.uniform() + O.weighted("p_cosine", O.as_weights("cedges"))
                + O.weighted("p_jaccard", O.as_weights("jedges")))
    for m in ("uniform", "cosine", "jaccard"):
        q[f"pred_{m}"] = _q("e", personal, _PRED_SEL + f"p_{m}")
    q["mae_personalized"] = _q("e", personal, _mae_union(["uniform", "cosine", "jaccard"]))
    pts = ([f"pt AS {_POINT}"] + O.uniform("x_uniform", "pt")
           + O.weighted("x_cosine", O.as_weights("cedges"), "pt")
           + O.weighted("x_jaccard", O.as_weights("jedges"), "pt")
           + O.simple_preds("pt", "x_")
           + O.knn("g10", "cedges", K) + O.weighted("x_knn", O.edges_of("g10"), "pt"))
    q["pred_points"] = _q("e", pts, " UNION ALL ".join(
        f"SELECT '{m}' AS method, user_id, item_id, RD(prediction) AS prediction FROM x_{m}"
        for m in ("uniform", "cosine", "jaccard", "baseline", "knn")))

    q["knn_graph"] = _q("o", O.knn("kg", "cedges", K), _GRAPH_SEL + "kg")
    q["knn_graph_k400"] = _q("o", O.knn("kg", "cedges", K_LARGE), _GRAPH_SEL + "kg")
    q["knn_pair_lookup"] = _q("e", O.knn("kg", "cedges", K), f"""SELECT CAST({USER} AS BIGINT) AS u,
        x.user_id AS v, RD(COALESCE(kg.sim, 0.0)) AS sim
        FROM (SELECT DISTINCT user_id FROM train) x
        LEFT JOIN kg ON kg.user_id = {USER} AND kg.neighbor_id = x.user_id""")
    q["pred_knn"] = _q("o", O.knn("kg", "cedges", K) + O.weighted("p_knn", O.edges_of("kg")),
                       _PRED_SEL + "p_knn")
    q["pred_knn_point"] = _q("e", [f"pt AS {_POINT}"] + O.knn("kg", "cedges", K)
                             + O.weighted("p_knn", O.edges_of("kg"), "pt"),
                             f"SELECT user_id, item_id, RD(prediction) AS prediction FROM p_knn")
    meta = {"k": K, "partitions": PARTITIONS, "replication": REPLICATION}
    text6 = lambda x: f"CAST(CAST({x} AS DECIMAL(18,6)) AS VARCHAR)"
    q["answers_json"] = _q("o", O.simple_preds() + O.knn("kg", "cedges", K) + O.weighted("p_knn", O.edges_of("kg")) + [
        f"mm AS ({_mae_union(['global', 'user', 'item', 'baseline'])})",
        f"""ans AS (SELECT 'B.1' AS section, 'global_avg' AS metric, {text6("RD((SELECT g FROM g))")} AS value
            UNION ALL SELECT 'B.2', method, {text6("mae")} FROM mm
            UNION ALL SELECT 'N.1', 'mae_k{K}', {text6("(SELECT RD(AVG(ABS(rating - prediction))) FROM p_knn)")}
            {" ".join(f"UNION ALL SELECT 'Meta', '{k}', '{v}'" for k, v in meta.items())})"""],
        """SELECT section, '{' || string_agg('"' || metric || '":"' || value || '"', ',' ORDER BY metric) || '}' AS json
           FROM ans GROUP BY section""")
    q["load_text_tab"] = q["load_text_colons"] = O.ORDERS
    q["load_kept"] = O.ORDERS
    q["load_rejects"] = f"""WITH r AS ({O.ORDERS}), d AS (SELECT CAST(user_id AS VARCHAR) AS u, CAST(item_id AS VARCHAR) AS i,
          CAST(rating AS VARCHAR) AS x, (user_id + item_id) % 7 AS kind FROM r)
        SELECT CASE kind WHEN 0 THEN concat_ws(chr(9), 'user', i, x, '0') WHEN 1 THEN concat_ws(chr(9), u, 'x1', x, '0')
            WHEN 2 THEN concat_ws(chr(9), u, i, 'three', '0') WHEN 3 THEN concat_ws(chr(9), u, i)
            WHEN 4 THEN concat_ws(chr(9), u, i, '0', '0') WHEN 5 THEN concat_ws(chr(9), u, i, '9', '0') ELSE '' END AS line,
          CASE kind WHEN 0 THEN 'user' WHEN 1 THEN 'item' WHEN 2 THEN 'rating' WHEN 3 THEN 'fields'
            WHEN 4 THEN 'unrated' WHEN 5 THEN 'scale' ELSE 'user' END AS reason FROM d"""
    q["load_text_dimensions"] = f"""SELECT * FROM ({O.ORDERS}) WHERE user_id BETWEEN 1 AND {N_USERS}
        AND item_id BETWEEN 1 AND {N_ITEMS}"""
    q["load_personal_csv"] = f"""SELECT CAST({NEW_USER} AS BIGINT) AS user_id, p_partkey AS item_id, p_name AS title,
        CAST(1 + p_partkey % 5 AS DOUBLE) AS rating FROM part WHERE p_partkey % 10 = 0"""
    ks = " UNION ALL ".join(f"SELECT CAST({k} AS BIGINT) AS k" for k in K_LIST)
    avg = "COALESCE(ua.user_avg, (SELECT g FROM g))"
    dd = "COALESCE(s.num / NULLIF(s.den, 0), 0.0)"
    q["mae_knn_by_k"] = _q("e", [f"ks AS ({ks})"] + O.knn("gk", "cedges", max(K_LIST)) + [
        """sk AS (SELECT ks.k, t.user_id, t.item_id, SUM(e.sim * d.dev) AS num, SUM(ABS(e.sim)) AS den
             FROM test t JOIN gk e ON e.user_id = t.user_id
             JOIN dev d ON d.user_id = e.neighbor_id AND d.item_id = t.item_id
             JOIN ks ON e.rank <= ks.k GROUP BY 1, 2, 3)""",
        f"""pk AS (SELECT ks.k, t.rating, {O.denorm(avg, dd)} AS prediction FROM test t CROSS JOIN ks
             LEFT JOIN sk s ON s.k = ks.k AND s.user_id = t.user_id AND s.item_id = t.item_id
             LEFT JOIN ua ON ua.user_id = t.user_id)"""],
        f"SELECT k, RD(AVG(ABS(rating - prediction))) AS mae FROM pk GROUP BY k")

    q["unseen_items"] = _q("e", [], f"""SELECT CAST({USER} AS BIGINT) AS user_id, item_id
        FROM (SELECT DISTINCT item_id FROM train)
        WHERE item_id NOT IN (SELECT item_id FROM train WHERE user_id = {USER})""")
    rec = lambda uid, k, edges_src: (
        [f"""cand AS (SELECT CAST({uid} AS BIGINT) AS user_id, item_id, CAST(NULL AS DOUBLE) AS rating
               FROM (SELECT DISTINCT item_id FROM train)
               WHERE item_id NOT IN (SELECT item_id FROM train WHERE user_id = {uid}))""",
         f"e1 AS (SELECT u, v, sim FROM {edges_src} WHERE u = {uid})",
         f"c1 AS (SELECT {uid} AS u, user_id AS v FROM (SELECT DISTINCT user_id FROM train) WHERE user_id <> {uid})"]
        + O.knn("g1", "e1", k, "c1") + O.weighted("pc", O.edges_of("g1"), "cand")
        + [f"""top AS (SELECT user_id, item_id, RD(prediction) AS prediction,
               ROW_NUMBER() OVER (ORDER BY RD(prediction) DESC, item_id) AS rank FROM pc)"""])
    q["recommend_all"] = _q("e", O.knn("kg", "cedges", K) + [
        """allc AS (SELECT u.user_id, i.item_id, CAST(NULL AS DOUBLE) AS rating
             FROM (SELECT DISTINCT user_id FROM train) u CROSS JOIN (SELECT DISTINCT item_id FROM train) i
             WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = i.item_id))"""]
        + O.weighted("pa", O.edges_of("kg"), "allc") + [
        """ra AS (SELECT user_id, item_id, RD(prediction) AS prediction,
             ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY RD(prediction) DESC, item_id) AS rank FROM pa)"""],
        f"SELECT user_id, rank, item_id, prediction FROM ra WHERE rank <= {TOP_N}")
    q["recommend_user"] = _q("e", rec(USER, K, "cedges"),
                             f"SELECT user_id, rank, item_id, prediction FROM top WHERE rank <= {TOP_N}")
    appended = ([f"r0 AS ({O.ORDERS})",
                 f"""mine AS (SELECT (SELECT MAX(user_id) + 1 FROM r0) AS user_id, p_partkey AS item_id,
                       CAST(1 + p_partkey % 5 AS DOUBLE) AS rating FROM part WHERE p_partkey % 10 = 0)"""]
                + O.base("o", train="SELECT * FROM r0 UNION ALL SELECT * FROM mine"))
    q["knn_with_new_user"] = O.with_(appended + O.knn("kg", "cedges", K), _GRAPH_SEL + "kg")
    q["recommend_new_user"] = O.with_(
        appended
        + rec("(SELECT MAX(user_id) FROM mine)", K_SWEEP, "cedges"),
        f"""SELECT t.rank, t.item_id, p.p_name AS title, t.prediction FROM top t
            LEFT JOIN part p ON p.p_partkey = t.item_id WHERE t.rank <= {TOP_N}""")

    users = "(SELECT DISTINCT user_id FROM train)"
    q["user_bins"] = _q("o", O.bins("b", users, PARTITIONS, REPLICATION),
                        "SELECT user_id, bin FROM b")
    ab = O.bins("b", users, PARTITIONS, REPLICATION) + O.knn("ga", "b_edges", K, cand="b_cand")
    q["knn_approx"] = _q("e", ab, _GRAPH_SEL + "ga")
    q["pred_knn_approx"] = _q("e", ab + O.weighted("p_ak", O.edges_of("ga")), _PRED_SEL + "p_ak")
    q["mae_knn_approx"] = _q("e", ab + O.weighted("p_ak", O.edges_of("ga")),
                             "SELECT RD(AVG(ABS(rating - prediction))) AS mae FROM p_ak")
    reps = "(" + " UNION ALL ".join(f"SELECT CAST({r} AS BIGINT) AS replication" for r in REPLICATIONS) + ")"
    q["mae_by_replication"] = _q("e", O.bins("b", users, PARTITIONS, reps)
                                 + O.knn("gr", "b_edges", K_SWEEP, cand="b_cand", keys=("replication",)) + [
        """sr AS (SELECT e.replication, t.user_id, t.item_id, SUM(e.sim * d.dev) AS num, SUM(ABS(e.sim)) AS den
             FROM test t JOIN gr e ON e.user_id = t.user_id
             JOIN dev d ON d.user_id = e.neighbor_id AND d.item_id = t.item_id GROUP BY 1, 2, 3)""",
        f"""pr AS (SELECT x.replication, t.rating, {O.denorm(avg, dd)} AS prediction
             FROM test t CROSS JOIN {reps} x
             LEFT JOIN sr s ON s.replication = x.replication AND s.user_id = t.user_id AND s.item_id = t.item_id
             LEFT JOIN ua ON ua.user_id = t.user_id)"""],
        f"SELECT replication, RD(AVG(ABS(rating - prediction))) AS mae FROM pr GROUP BY replication")
    return q


ORACLE_SQL: dict[str, str] = {k: _expand_rd(v) for k, v in _sql().items()}
