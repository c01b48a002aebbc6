"""Hand-computed expectations on the micro fixture (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from cofi.operators import approx, knn, metrics, predict, recommend, similarity, stats
from cofi.operators.pairs import nonzero
from conftest import MICRO_TEST

A = dict(abs=1e-6)


def by_key(rows, *keys, val):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r[val] for r in rows}


def in_test_order(pred_df):
    got = {(r.user_id, r.item_id): r.prediction for r in pred_df.collect()}
    return [got[(u, i)] for u, i, _ in MICRO_TEST]


def test_averages(micro):
    train, _ = micro
    g = stats.global_stats(train).first()
    assert g.global_avg == pytest.approx(3.066667, **A)
    assert (g.n_ratings, g.n_users, g.n_items) == (15, 5, 6)
    ua = by_key(stats.user_avg(train).collect(), "user_id", val="user_avg")
    assert ua == pytest.approx({1: 3.25, 2: 3.0, 3: 3.0, 4: 3.0, 5: 3.0}, **A)
    ia = by_key(stats.item_avg(train).collect(), "item_id", val="item_avg")
    assert ia == pytest.approx({10: 3.333333, 11: 3.333333, 12: 2.666667, 13: 3.5,
                                14: 3.333333, 15: 1.0}, **A)
    assert stats.user_avg_point(train, 1).first().user_avg == pytest.approx(3.25, **A)
    assert stats.user_avg_point(train, 99).first().user_avg == 0.0
    assert stats.item_avg_point(train, 15).first().item_avg == pytest.approx(1.0, **A)


def test_deviations_and_norms(micro):
    train, _ = micro
    dev = stats.norm_dev(train)
    d = by_key(dev.collect(), "user_id", "item_id", val="dev")
    assert d[(1, 10)] == pytest.approx(1.0, **A)
    assert d[(1, 11)] == pytest.approx(-0.111111, **A)
    assert d[(1, 12)] == pytest.approx(-1.0, **A)
    assert d[(1, 13)] == pytest.approx(0.428571, **A)
    assert d[(2, 11)] == 0.0 and d[(4, 13)] == 0.0 and d[(4, 14)] == 0.0
    assert d[(3, 14)] == pytest.approx(-0.5, **A)
    idv = by_key(stats.item_dev(dev).collect(), "item_id", val="dev")
    assert idv == pytest.approx({10: 0.166667, 11: 0.12963, 12: -0.166667, 13: 0.214286,
                                 14: 0.166667, 15: -1.0}, **A)
    assert stats.item_dev_point(dev, 16).first().dev == 0.0
    nrm = by_key(stats.user_norm(dev).collect(), "user_id", val="norm")
    assert nrm == pytest.approx({1: 1.481897, 2: 0.707107, 3: 1.581139, 4: 0.0, 5: 1.414214}, **A)
    rh = by_key(stats.preprocessed(dev).where("user_id = 1").collect(), "item_id", val="rhat")
    assert rh == pytest.approx({10: 0.674811, 11: -0.074979, 12: -0.674811, 13: 0.289205}, **A)
    rh4 = stats.preprocessed(dev).where("user_id = 4").collect()
    assert all(r.rhat == 0.0 for r in rh4)


def test_similarities(micro):
    train, _ = micro
    rhat = stats.preprocessed(stats.norm_dev(train))
    cos = by_key(similarity.cosine_edges(rhat).collect(), "u", "v", val="sim")
    expect = {(1, 2): 0.954326, (1, 3): -0.877286, (2, 3): -0.894427, (3, 5): -0.223607}
    assert set(cos) == set(expect) | {(v, u) for u, v in expect}
    for (u, v), s in expect.items():
        assert cos[(u, v)] == pytest.approx(s, **A) and cos[(v, u)] == pytest.approx(s, **A)
    jac = by_key(similarity.jaccard_edges(train).collect(), "u", "v", val="sim")
    jexp = {(1, 2): 0.75, (1, 3): 0.6, (1, 4): 0.2, (2, 3): 0.75, (3, 4): 0.2, (3, 5): 0.2,
            (4, 5): 0.333333}
    assert {k: jac[k] for k in jexp} == pytest.approx(jexp, **A)
    assert len(jac) == 2 * len(jexp)
    assert similarity.sim_cosine_pair(rhat, 1, 4).first().sim == 0.0
    assert similarity.sim_jaccard_pair(train, 4, 5).first().sim == pytest.approx(1 / 3, **A)
    one = by_key(similarity.sim_one_user(rhat, 3).collect(), "v", val="sim")
    assert one[1] == pytest.approx(-0.877286, **A) and one[5] == pytest.approx(-0.223607, **A)


def test_knn_zero_slots(micro):
    """Zero-similarity users take rank slots ahead of negative ones."""
    train, _ = micro
    g2 = {(r.user_id, r.neighbor_id): (r.sim, r.rank) for r in knn.knn_from_ratings(train, 2).collect()}
    assert set(g2) == {(1, 2), (2, 1), (3, 5)}
    assert g2[(3, 5)][1] == 2  # user 4 (zero) holds slot 1
    g3 = {(r.user_id, r.neighbor_id) for r in knn.knn_from_ratings(train, 3).collect()}
    assert g3 == {(1, 2), (2, 1), (3, 5), (3, 1)}


def test_predictions_and_mae(micro, spark):
    train, test = micro
    dev = stats.norm_dev(train)
    rhat = stats.preprocessed(dev)
    w = lambda e: e.select(F.col("u").alias("user_id"), F.col("v").alias("neighbor_id"), "sim")
    cases = {
        "global": (predict.pred_global(train, test), [3.066667] * 8, 0.766667),
        "user": (predict.pred_user(train, test),
                 [3.25, 3.0, 3.0, 3.0, 3.0, 3.066667, 3.25, 3.066667], 0.8125),
        "item": (predict.pred_item(train, test),
                 [3.333333, 3.5, 3.5, 3.333333, 3.333333, 3.333333, 3.066667, 3.066667], 0.766667),
        "baseline": (predict.pred_baseline(train, test, dev),
                     [3.541667, 3.428571, 3.428571, 3.333333, 3.333333, 3.388889, 3.25, 3.066667],
                     0.808681),
        "uniform": (predict.pred_uniform(train, test, dev),
                    [3.541667, 3.428571, 3.428571, 3.333333, 3.333333, 3.066667, 3.25, 3.066667],
                    0.848958),
        "cosine": (predict.pred_weighted(train, test, dev, w(similarity.cosine_edges(rhat))),
                   [4.125, 3.857143, 2.142857, 3.0, 5.0, 3.066667, 3.25, 3.066667], 0.957589),
        "jaccard": (predict.pred_weighted(train, test, dev, w(similarity.jaccard_edges(train))),
                    [2.40625, 3.857143, 3.642857, 3.0, 1.0, 3.066667, 3.25, 3.066667], 0.828683),
        "knn2": (predict.pred_weighted(train, test, dev, knn.as_edges(knn.knn_from_ratings(train, 2))),
                 [3.25, 3.857143, 3.0, 3.0, 3.0, 3.066667, 3.25, 3.066667], 0.705357),
    }
    for name, (p, expect, mae) in cases.items():
        assert in_test_order(p) == pytest.approx(expect, **A), name
        assert metrics.mae(p).first().mae == pytest.approx(mae, **A), name
    table = {r.method: r.mae for r in metrics.mae_by_method({k: v[0] for k, v in cases.items()}).collect()}
    assert table == pytest.approx({k: v[2] for k, v in cases.items()}, **A)
    oor = metrics.out_of_range({k: v[0] for k, v in cases.items()}).collect()
    assert all(r.n_out == 0 for r in oor)
    pt = predict.pred_baseline(train, predict.point(spark, 6, 10), dev).first()
    assert pt.prediction == pytest.approx(3.388889, **A)


def test_recommend(micro):
    train, _ = micro
    dev = stats.norm_dev(train)
    r2 = [(r.item_id, r.prediction) for r in recommend.recommend_user(train, 2, 2, 3).orderBy("rank").collect()]
    assert r2 == [(13, pytest.approx(3.857143, **A)), (14, 3.0), (15, 3.0)]
    r4 = [(r.item_id, r.prediction) for r in recommend.recommend_user(train, 4, 2, 3).orderBy("rank").collect()]
    assert r4 == [(10, 3.0), (11, 3.0), (12, 3.0)]
    unseen = {r.item_id for r in recommend.unseen_items(train, 5).collect()}
    assert unseen == {10, 11, 12, 13}


def test_approx_single_bin_is_exact(micro):
    train, _ = micro
    rhat = stats.preprocessed(stats.norm_dev(train))
    users = train.select("user_id").distinct()
    exact = {tuple(r) for r in knn.knn_from_ratings(train, 2).select("user_id", "neighbor_id", "rank").collect()}
    one_bin = {tuple(r) for r in approx.knn_approx(rhat, users, 2, 1, 1)
               .select("user_id", "neighbor_id", "rank").collect()}
    all_bins = {tuple(r) for r in approx.knn_approx(rhat, users, 2, 4, 4)
                .select("user_id", "neighbor_id", "rank").collect()}
    assert one_bin == exact == all_bins


def test_nonzero_filter(spark):
    """Rounding error against the size of the terms is zero; a small sum of small terms is not."""
    df = spark.createDataFrame([(1e-16, 1.0), (-1e-14, 2.0), (1e-11, 1.0), (-1e-20, 1e-20), (0.0, 0.0), (0.0, 3.0)], "s DOUBLE, size DOUBLE")
    got = [r.s for r in df.where(nonzero(F.col("s"), "size")).collect()]
    assert sorted(got) == [-1e-20, 1e-11]


def test_recommend_all_micro(micro):
    train, _ = micro
    dev = stats.norm_dev(train)
    rec = recommend.recommend_all(train, dev, knn.as_edges(knn.knn_from_ratings(train, 2)), 3)
    got = {}
    for r in rec.orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append((r.item_id, round(r.prediction, 6)))
    assert got[2] == [(13, 3.857143), (14, 3.0), (15, 3.0)]
    assert got[4] == [(10, 3.0), (11, 3.0), (12, 3.0)]
    for u in (1, 3, 5):
        single = [(r.item_id, r.prediction) for r in
                  recommend.recommend_user(train, u, 2, 3).orderBy("rank").collect()]
        assert got[u] == single


def test_recommend_all_many(micro):
    """More places than a user has unseen items, with a long tie block."""
    train, _ = micro
    dev = stats.norm_dev(train)
    rec = recommend.recommend_all(train, dev, knn.as_edges(knn.knn_from_ratings(train, 2)), 100)
    got = {}
    for r in rec.orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append((r.item_id, r.prediction))
    for u in range(1, 6):
        single = recommend.recommend_user(train, u, 2, 100).orderBy("rank").collect()
        assert got.get(u, []) == [(r.item_id, r.prediction) for r in single]


def test_all_neighbours_through_the_item(micro):
    train, test = micro
    dev = stats.norm_dev(train)
    e = similarity.cosine_edges(stats.preprocessed(dev)).select(F.col("u").alias("user_id"), F.col("v").alias("neighbor_id"), "sim")
    a, b = (in_test_order(predict.pred_weighted(train, test, dev, e, all_neighbours=x)) for x in (False, True))
    assert a == pytest.approx(b, abs=1e-12)


def test_knn_nested(micro):
    train, _ = micro
    rows = {r.user_id: [(x.rank, x.neighbor_id) for x in r.neighbors]
            for r in knn.nested(knn.knn_from_ratings(train, 3)).collect()}
    assert rows[3] == [(2, 5), (3, 1)]
    assert rows[1] == [(1, 2)]
