"""All pairs in blocks: the same as brute force whatever the blocks, dense or sparse, and no pair is shuffled."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cofi.operators import approx, blocks, knn, predict, similarity
from cofi.operators.blocks import Rule


def _ratings(n_users=60, n_items=25, each=9, seed=5):
    r = random.Random(seed)
    return {(u, i): r.choice([-0.6, -0.2, 0.0, 0.1, 0.5]) for u in range(0, 7 * n_users, 7) for i in r.sample(range(n_items), each)}


def _frame(spark, rows, name="rhat"):
    return spark.createDataFrame([(u, i, x) for (u, i), x in rows.items()], f"user_id BIGINT, item_id BIGINT, {name} DOUBLE")


def _sims(rows):
    users = {}
    for (u, i), x in rows.items():
        users.setdefault(u, {})[i] = x
    out = {}
    for u, a in users.items():
        for v, b in users.items():
            t = [a[i] * b[i] for i in a.keys() & b.keys()]
            if u != v and abs(sum(t)) > 1e-12 * sum(map(abs, t)):
                out[u, v] = sum(t)
    return users, out


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_not_shuffled(spark):
    """What leaves the block pairs is the result: no exchange, join or aggregate of pairs above it."""
    rhat = _frame(spark, _ratings())
    for df in (similarity.cosine_edges(rhat), similarity.jaccard_edges(rhat), similarity.jaccard_at_least(rhat, 0.4)):
        above = _plan(df).split("MapInArrow")[0]
        assert "Exchange" not in above and "Join" not in above and "Aggregate" not in above


@pytest.mark.parametrize("block_rows", [None, 100])
def test_pairs_and_graph_equal_brute_force(spark, block_rows):
    rows = _ratings()
    users, sims = _sims(rows)
    rhat = _frame(spark, rows)
    how = {"block_rows": block_rows}
    got = {(r.u, r.v): r.sim for r in similarity.cosine_edges(rhat, **how).collect()}
    assert got.keys() == sims.keys() and all(got[p] == pytest.approx(sims[p], abs=1e-12) for p in sims)
    key = lambda x: (-math.floor(x[1] * 1e10 + 0.5), x[0])
    for k in (3, 50):
        want = {(u, v, n) for u in users for n, (v, _) in enumerate(
            sorted(((v, sims.get((u, v), 0.0)) for v in users if v != u), key=lambda x: (*key(x), )), 1) if n <= k and (u, v) in sims}
        graph = knn.knn_graph(rhat, k, F.lit(len(users) - 1), **how).collect()
        assert {(r.user_id, r.neighbor_id, r.rank) for r in graph} == want
    pairs = {(r.u, r.v): r.sim for r in similarity.jaccard_pairs(rhat, **how).collect()}
    want = {(u, v): len(a.keys() & b.keys()) / len(a.keys() | b.keys()) for u, a in users.items() for v, b in users.items()
            if u < v and a.keys() & b.keys()}
    assert pairs == want


@pytest.mark.parametrize("block_rows", [None, 100])
def test_sums_over_all_neighbours_equal_the_join(spark, block_rows):
    rows = _ratings()
    r = random.Random(1)
    test = spark.createDataFrame([(u, i, 1.0) for u in [*range(0, 420, 7), 5] for i in r.sample(range(27), 4)],
                                 "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    table = _frame(spark, rows).withColumn("dev", F.col("rhat") * 2 - 0.1)
    weights = lambda e: e.select(F.col("u").alias("user_id"), F.col("v").alias("neighbor_id"), "sim")
    for got, edges in ((similarity.cosine_sums(table, test, block_rows=block_rows), similarity.cosine_edges(table)),
                       (similarity.jaccard_sums(table, table, test, block_rows=block_rows), similarity.jaccard_edges(table))):
        have = {(x.user_id, x.item_id): (x.num, x.den) for x in got.collect()}
        want = {(x.user_id, x.item_id): (x.num, x.den) for x in predict.rater_sums(test, weights(edges), table).collect()}
        assert have.keys() == want.keys()
        assert all(have[p] == pytest.approx(want[p], abs=1e-9) for p in want)


@pytest.mark.parametrize("least", [0.0, 0.3])
@pytest.mark.parametrize("consumer,options", [(blocks._Pairs, {}), (blocks._Best, {"k": 2}), (blocks._Sums, {})])
def test_dense_and_sparse_groups_agree(monkeypatch, consumer, options, least):
    rows = _ratings(40, 12, 6)
    r = random.Random(2)
    items = np.arange(14)

    def side(part, ones):
        own = [(u, i, x) for (u, i), x in rows.items() if u % 2 == part]
        own += [(u, i, math.nan) for u in {u for u, _, _ in own} for i in r.sample(range(14), 3)]
        u, i, x = (np.array(c) for c in zip(*own, strict=True))
        return blocks._Side(u, i, x * 0 + 1 if ones else x, np.where(np.isnan(x), np.nan, x + 0.3), np.stack([u % 5, np.full(len(u), 6)]))

    monkeypatch.setattr(blocks, "SLICE_TERMS", 50)
    monkeypatch.setattr(blocks, "SLICE_CELLS", 60)
    for rule in (Rule(apart=1, least=least), Rule(sets=True, least=least)):
        a, b = side(0, rule.sets), side(1, rule.sets)
        for other in (None, b):
            if least == 0.0 and not rule.sets and consumer is blocks._Best:
                rule.levels, rule.words, rule.apart = (1, 3), 1, 0
            found = []
            for dense in (True, False):
                monkeypatch.setattr(consumer, "_is_dense", lambda *_, d=dense: d)
                total = {}
                for cols in consumer(rule, 0, **options).run(a, other, items):
                    for x in zip(*(c.tolist() for c in cols), strict=True):
                        if consumer is blocks._Best:
                            total[x[:3]] = np.add(total.get(x[:3], 0), [len(x[3]), sum(x[3]), sum(x[4]), x[5]])
                        else:
                            n = 2 if consumer is blocks._Sums else 3
                            total[x[:n]] = np.add(total.get(x[:n], 0), x[n:])
                found.append(total)
            assert found[0] and found[0].keys() == found[1].keys()
            assert all(found[0][p] == pytest.approx(found[1][p], abs=1e-12) for p in found[0])


def test_bins_in_blocks(spark):
    rows = _ratings()
    users, sims = _sims(rows)
    rhat = _frame(spark, rows)
    bins = approx.user_bins(rhat.select("user_id").distinct(), 4, 2)
    of = {}
    for r in bins.collect():
        of.setdefault(r.user_id, set()).add(r.bin)
    got = [(r.bin, r.u, r.v) for r in approx.bin_pairs(rhat, bins, 4, block_rows=60).collect()]
    assert sorted(got) == sorted((min(of[u] & of[v]), u, v) for u, v in sims if u < v and of[u] & of[v])


def test_several_graphs_at_once_equal_each_alone(spark):
    rows = _ratings()
    train = _frame(spark, {p: 2.0 + x for p, x in rows.items()}, "rating")
    dev = _frame(spark, rows, "dev")
    test = spark.createDataFrame([(u, i, 3.0) for u in range(0, 430, 7) for i in range(0, 27, 5)],
                                 "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    r = random.Random(3)
    edges = [(u, v, r.uniform(-1, 1), sorted(r.sample([1, 4, 9], 2))) for u in range(0, 420, 7) for v in r.sample(range(0, 420, 7), 6)]
    graph = spark.createDataFrame([(u, v, s, g) for u, v, s, gs in edges for g in gs], "user_id BIGINT, neighbor_id BIGINT, sim DOUBLE, g BIGINT")
    got = predict.pred_weighted_per(train, test, dev, graph, "g", [9, 1, 4])
    assert "collect_list" not in _plan(got)  # graphs are bits of an edge
    have = {(x.g, x.user_id, x.item_id): x.prediction for x in got.collect()}
    want = {(g, x.user_id, x.item_id): x.prediction for g in (1, 4, 9)
            for x in predict.pred_weighted(train, test, dev, graph.where(F.col("g") == g)).collect()}
    assert have.keys() == want.keys() and all(have[p] == pytest.approx(want[p], abs=1e-9) for p in want)


def test_edges_take_test_items_along_as_lists(spark, monkeypatch):
    """No row per edge and test item is joined: an edge travels once per list; repeated and null rows count as before."""
    monkeypatch.setattr(predict, "LIST_ITEMS", 4)
    test = spark.createDataFrame([(u, i, 3.0) for u in (1, 2) for i in range(40)] + [(1, 5, 3.0), (None, 3, 3.0), (3, None, 3.0)],
                                 "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    sims = [(1, 8, 0.5), (1, 9, -0.25), (2, 9, 1.0), (2, 7, 0.5), (3, 9, 0.5)]
    edges = spark.createDataFrame(sims, "user_id BIGINT, neighbor_id BIGINT, sim DOUBLE")
    devs = [(8, 5, 1.0), (8, 39, 0.5), (9, 5, -1.0), (9, 5, -1.0), (9, 77, 1.0), (7, None, 1.0)]
    dev = spark.createDataFrame(devs, "user_id BIGINT, item_id BIGINT, dev DOUBLE")
    sums = predict.neighbour_sums(test, edges, dev)
    want = {}
    for u, v, s in sims[:4]:
        for w, i, d in devs:
            if v == w and i is not None and i < 40:
                x = want.setdefault((u, i), [0.0, 0.0])
                x[0], x[1] = x[0] + s * d, x[1] + abs(s)
    assert {(r.user_id, r.item_id): [r.num, r.den] for r in sums.collect()} == want
    lists = predict._lists(test.where("user_id IN (1, 2)")).collect()
    assert sorted(i for r in lists if r.user_id == 1 for i in r._asked) == list(range(40))
    assert len(lists) <= 2 * 11 and sum(len(r._asked) for r in lists) == 80
    assert "array_contains(_asked" in _plan(sums)


def test_blocks_do_not_grow_with_users_past_the_cores(spark, monkeypatch):
    """A rating is sent to each block: their number must not follow the number of users (F2-F4, F9-F11, F13)."""
    monkeypatch.setattr(blocks, "PAIR_TERMS", 10)
    monkeypatch.setattr(blocks, "BLOCK_USERS", 4)
    monkeypatch.setattr(blocks, "FEWEST_PAIRS", 6)
    monkeypatch.setattr(blocks, "CORE_PAIRS", 0)
    base = lambda n: spark.range(n).select(F.lit(0).cast("bigint").alias("cell"), F.col("id").alias("user_id"),
                                           F.explode(F.sequence(F.lit(0), F.lit(4))).alias("item_id"))
    assert [blocks._shape(base(n), None, 0)[1] for n in (80, 320, 1280)] == [4, 4, 4]
    assert blocks._shape(base(1280), 640, 0)[1] == 10  # but what a task holds is bounded


def test_bit_maps_only_where_they_leave_copies_out(spark):
    rows = lambda raters: spark.range(4000).select(F.lit(0).cast("bigint").alias("cell"), F.col("id").alias("user_id"),
                                                   F.floor(F.col("id") / raters).alias("item_id"))
    assert blocks._shape(rows(2), 1000, 0) == (1, 4, True)
    assert blocks._shape(rows(200), 1000, 0) == (1, 4, False)
    frame = _frame(spark, _ratings())
    assert "bit_or" not in _plan(similarity.cosine_pairs(frame, block_rows=100))  # 25 items, some 20 raters each


@pytest.mark.parametrize("masked", [True, False])
def test_blocks_without_users(spark, monkeypatch, masked):
    """More blocks than users, with and without bit maps: no pair is lost or comes twice."""
    rows = _ratings(4, 6, 4)
    _, sims = _sims(rows)
    monkeypatch.setattr(blocks, "_shape", lambda *_: (1, 9, masked))
    got = [(r.u, r.v, r.sim) for r in similarity.cosine_edges(_frame(spark, rows)).collect()]
    assert len(got) == len(sims) and {(u, v): s for u, v, s in got} == pytest.approx(sims, abs=1e-12)


@pytest.mark.parametrize("consumer,options", [(blocks._Pairs, {}), (blocks._Best, {"k": 4}), (blocks._Sums, {})])
def test_large_dense_blocks_are_cut_into_parts(monkeypatch, consumer, options):
    """Matrices over the limit are formed a part of the users at a time, not term by term."""
    rows = _ratings()
    r = random.Random(2)
    items = np.arange(25)

    def side(part):
        own = [(u, i, x) for (u, i), x in rows.items() if u % 2 == part]
        own += [(u, i, math.nan) for u in {u for u, _, _ in own} for i in r.sample(range(25), 3)]
        u, i, x = (np.array(c) for c in zip(*own, strict=True))
        return blocks._Side(u, i, x, x + 0.3, np.zeros((0, len(u)), int))

    def found(a, b):
        """Pairs as they are, lists united and cut, sums added."""
        total = {}
        for cols in consumer(Rule(), 0, **options).run(a, b, items):
            for x in zip(*(c.tolist() for c in cols), strict=True):
                if consumer is blocks._Pairs:
                    assert x[:3] not in total
                    total[x[:3]] = x[3]
                elif consumer is blocks._Best:
                    near, seen = total.get(x[2], ([], 0))
                    key = lambda e: (-math.floor(e[1] * 1e10 + 0.5), e[0])
                    total[x[2]] = sorted(near + list(zip(x[3], x[4], strict=True)), key=key)[:4], seen + x[5]
                else:
                    total[x[:2]] = np.add(total.get(x[:2], 0), x[2:])
        if consumer is blocks._Best:
            return {(u, "seen"): n for u, (_, n) in total.items()} | {(u, v): s for u, (near, _) in total.items() for v, s in near}
        return total

    monkeypatch.setattr(consumer, "_pays", lambda *_: True)
    monkeypatch.setattr(consumer, "_sparse", lambda *_: pytest.fail("term by term"))
    a, b = side(0), side(1)
    for other in (None, b):
        monkeypatch.setattr(blocks, "DENSE_BYTES", 400 << 20)
        want = found(a, other)
        monkeypatch.setattr(blocks, "DENSE_BYTES", 20 * 25 * 32)
        assert len(consumer(Rule(), 0, **options)._parts(a, other, 25)) >= 3
        got = found(a, other)
        assert want and got.keys() == want.keys() and all(got[p] == pytest.approx(want[p], abs=1e-12) for p in want)
