"""The k best of each user while the others stream past: the same as brute force, and each list leaves its task once."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cofi.operators import blocks, knn, similarity
from cofi.operators.blocks import Rule

ITEMS = np.arange(24)


def _ratings(n_users, each, seed=3):
    r = random.Random(seed)
    return {(u, i): r.choice([-0.6, -0.2, 0.1, 0.3, 0.5]) for u in range(n_users) for i in r.sample(range(len(ITEMS)), each)}


def _side(rows, users, words):
    own = [(u, i, x) for (u, i), x in rows.items() if u in users]
    u, i, x = (np.array(c) for c in zip(*own, strict=True))
    return blocks._Side(u, i, x, x, np.array([words[v] for v in u]).T.reshape(-1, len(u)))


def _key(e):
    return -math.floor(e[1] * 1e10 + 0.5), e[0]


def _all_sims(rows):
    users = {}
    for (u, i), x in rows.items():
        users.setdefault(u, {})[i] = x
    out = {}
    for u, a in users.items():
        for v, b in users.items():
            t = [a[i] * b[i] for i in a.keys() & b.keys()]
            if u != v and abs(sum(t)) > 1e-12 * sum(map(abs, t)):
                out.setdefault(u, []).append((v, sum(t)))
    return out


@pytest.mark.parametrize("dense", [True, False])
@pytest.mark.parametrize("edges", [10_000, 40])
@pytest.mark.parametrize("levels", [(), (1, 2, 4)])
@pytest.mark.parametrize("k", [5, 20, 60])
def test_streamed_lists_equal_brute_force(monkeypatch, dense, edges, levels, k):
    """Whatever the pieces and whenever lists are cut, the ranks up to k of every level are exact, negative ones too."""
    n = 90
    r = random.Random(8)
    rows = _ratings(n, 7)
    words = {u: [1 << r.randrange(3), 0, 0] if levels else [] for u in range(n)}
    for w in words.values() if levels else ():
        w[1] = w[0] | 1 << r.randrange(3, 5)
        w[2] = w[1] | 1 << r.randrange(5, 6)
    for name, x in (("SETTLE_EDGES", 30), ("LIST_EDGES", edges), ("SLICE_CELLS", 150), ("SLICE_TERMS", 200), ("DENSE_BYTES", 24 * 12 * 40)):
        monkeypatch.setattr(blocks, name, x)
    monkeypatch.setattr(blocks._Lists, "_pays", lambda *_: dense)
    sims, got, seen = _all_sims(rows), {}, {}
    rule = Rule(levels=levels, words=1 if levels else 0)
    for part in range(2):
        own = _side(rows, set(range(part, n, 2)), words)
        lists = blocks._Lists(rule, 7, k, own, ITEMS)
        lists.meet(own, True)
        found = []
        for lo in range(0, n, 15):
            lists.meet(_side(rows, set(range(lo + (lo + 1 + part) % 2, lo + 15, 2)), words), False)
            found += lists.early()
        for cols in found + list(lists.found()):
            for cell, level, u, near, s, c in zip(*(x.tolist() for x in cols), strict=True):
                assert cell == 7 and u % 2 == part
                got.setdefault((u, level), []).extend(zip(near, s, strict=True))
                seen[u, level] = seen.get((u, level), 0) + c
    level_of = lambda u, v: next((x for i, x in enumerate(levels) if words[u][i] & words[v][i]), None) if levels else 0
    negative = 0
    for u in range(n):
        for top in levels or (0,):
            want = sorted(((v, s) for v, s in sims.get(u, []) if (x := level_of(u, v)) is not None and x <= top), key=_key)
            mine = sorted((e for (w, x), es in got.items() if w == u and x <= top for e in es), key=_key)
            assert [v for v, _ in mine[:k]] == [v for v, _ in want[:k]]
            assert [s for _, s in mine[:k]] == pytest.approx([s for _, s in want[:k]], abs=1e-12)
            if any(s < 0 for _, s in want[:k]):  # the ranks of these need the whole number
                negative += 1
                assert sum(c for (w, x), c in seen.items() if w == u and x <= top) == len(want)
    assert negative or k < 60


def test_a_list_leaves_once_however_many_blocks(spark):
    """Before, a user had a list in every block pair, all of them shuffled (F2-F6, F8, F10)."""
    rows = _ratings(120, 6)
    frame = spark.createDataFrame([(u, i, x) for (u, i), x in rows.items()], "user_id BIGINT, item_id BIGINT, rhat DOUBLE")
    best = blocks.best_rows(similarity.rated(frame), Rule(), 4, block_rows=100).collect()
    assert len(best) == len({r.user_id for r in best}) == 120
    want = {u: [v for v, _ in sorted(es, key=_key)[:4]] for u, es in _all_sims(rows).items()}
    assert {r.user_id: r.near for r in best} == want


def test_items_that_few_blocks_hold(spark, monkeypatch):
    """With bit maps, so that a block gets the ratings of its items only."""
    monkeypatch.setattr(blocks, "MASK_BYTES", 0)
    rows = {(u, i): 0.1 * (1 + (u * 7 + i) % 9) for u in range(200) for i in (u // 2, 1000 + u // 3)}
    frame = spark.createDataFrame([(u, i, x) for (u, i), x in rows.items()], "user_id BIGINT, item_id BIGINT, rhat DOUBLE")
    base = frame.select(F.lit(0).alias("cell"), "user_id", "item_id")
    assert blocks._list_shape(base, 50, 3)[1:3] == (8, True)
    graph = knn.knn_graph(frame, 3, F.lit(199), block_rows=50).collect()
    want = {(u, v, n) for u, es in _all_sims(rows).items() for n, (v, _) in enumerate(sorted(es, key=_key)[:3], 1)}
    assert {(r.user_id, r.neighbor_id, r.rank) for r in graph} == want


def test_negative_ones_of_users_with_few_co_raters_are_not_kept():
    """They come after more than k users who share nothing, so no rank up to k is theirs."""
    rows = {(u, i): (-1) ** u * 0.5 for u in range(40) for i in (u // 4,)}
    own = _side(rows, set(range(40)), {u: [] for u in range(40)})
    for raters, least in ((4, 0.1), (0, -0.25), (35, -0.25)):
        lists = blocks._Lists(Rule(), 0, 4, own, ITEMS, raters=raters)
        lists.meet(own, True)
        assert min(s for cols in lists.found() for x in cols[4].tolist() for s in x) >= least


def test_packed_ratings_are_small_and_whole():
    """A user's values are few: places among them, not the values, are sent per rating."""
    r = np.random.default_rng(0)
    users, each = 3000, 40
    user = np.repeat(np.sort(r.choice(10**9, users, False)), each)
    item = np.sort(r.integers(-10**6, 10**6, (users, each)), axis=1).ravel()
    val = r.random((users, 5))[np.repeat(np.arange(users), each), r.integers(0, 5, users * each)]
    n = len(user)
    table = pa.table({"cell": np.zeros(n, int), "blk": pa.array(np.ones(n), pa.int32()), "user_id": user, "item_id": item, "val": val,
                      "dev": pa.array([None] * n, pa.float64()), "attrs": pa.array([[int(u) % 7, -1] for u in user], pa.list_(pa.int64())),
                      "held": pa.array([[7]] * n, pa.list_(pa.int64()))})
    for streamed in (True, False):
        out = [x for b in blocks._packer(3, streamed)(table.to_batches(max_chunksize=1111)) for x in b.to_pylist()]
        size = sum(len(x) for row in out for x in row.values() if isinstance(x, bytes))
        assert size < 4.5 * 3 * n  # of 24 bytes and the attributes; over 7 before
        for to in range(3):
            here = [x for x in out if (x["bi"] if streamed else x["bi"] + x["bj"] - 1) == to]
            got = blocks._joined(here)
            assert (got[0] == user).all() and (got[1] == item).all() and (got[2] == val).all() and np.isnan(got[3]).all()
            assert (got[4] == np.stack([user % 7, user * 0 - 1])).all()
            assert all((x["side"] == (to != 1)) if streamed else True for x in here)
    # few values repeat
    who = np.arange(n) // 4
    odd = r.random(n)
    assert (blocks._values(blocks._Coded(odd, who).pack(np.arange(n)), np.full(n // 4, 4)) == odd).all()


def test_sums_of_two_dense_blocks_form_a_similarity_once(monkeypatch):
    """Both directions from one product (F9); rounding errors are told by the size of the terms, formed for them only."""
    rows = _ratings(60, 12)
    r = random.Random(2)

    def side(part):
        own = [(u, i, x) for (u, i), x in rows.items() if u % 2 == part]
        own += [(u, i, math.nan) for u in {u for u, _, _ in own} for i in r.sample(range(24), 5)]
        u, i, x = (np.array(c) for c in zip(*own, strict=True))
        return blocks._Side(u, i, x, x + 0.3, np.full((1, len(u)), 12))

    formed = []
    keep = blocks._Consumer._products
    monkeypatch.setattr(blocks._Consumer, "_products", lambda self, *a: formed.append(1) or keep(self, *a))
    for rule in (Rule(), Rule(sets=True)):
        a, b = side(0), side(1)
        if rule.sets:
            a.val, b.val = a.val * 0 + 1, b.val * 0 + 1
        found = []
        for dense in (True, False):
            monkeypatch.setattr(blocks._Sums, "_is_dense", lambda *_, d=dense: d)
            formed.clear()
            found.append({x[:2]: x[2:] for cols in blocks._Sums(rule, 0).run(a, b, ITEMS) for x in zip(*(c.tolist() for c in cols), strict=True)})
            assert len(formed) == dense
        assert found[0].keys() == found[1].keys() and len(found[0]) > 200
        assert all(found[0][p] == pytest.approx(found[1][p], abs=1e-12) for p in found[0])


def test_rounding_errors_are_no_similarity():
    """0.1 * 0.3 and -0.3 * 0.1 add up to nearly nothing; a small sum of small terms counts, and so do repeated ratings."""
    def side(lo, rows):
        u, i, x = (np.array(c) for c in zip(*rows, strict=True))
        return blocks._Side(u + lo, i, x, x, np.zeros((0, len(u)), int))

    a = side(0, [(0, 0, 0.1), (0, 1, 0.7), (0, 2, 0.2), (1, 3, 1e-9), (2, 4, 0.5), (2, 4, 0.5)])
    b = side(9, [(0, 0, 0.7), (0, 1, -0.1), (1, 3, 1e-9), (2, 4, 0.5), (2, 4, -0.5), (3, 2, 1e-3)])
    for dense in (True, False):
        for consumer, how in ((blocks._Pairs, {}), (blocks._Best, {"k": 3})):
            one = consumer(Rule(), 0, **how)
            one._is_dense = lambda *_, d=dense: d
            cols = list(one.run(a, b, ITEMS))
            if consumer is blocks._Pairs:
                got = {(u, v): s for c in cols for _, u, v, s in zip(*(x.tolist() for x in c), strict=True)}
                assert got == {(1, 10): pytest.approx(1e-18), (0, 12): pytest.approx(2e-4)}
        lists = blocks._Lists(Rule(), 0, 3, a, ITEMS)
        lists._pays = lambda *_, d=dense: d
        lists.meet(b, False)
        assert {(u, v) for c in lists.found() for u, vs in zip(c[2].tolist(), c[3].tolist(), strict=True) for v in vs} == {(1, 10), (0, 12)}


@pytest.mark.parametrize("dense", [True, False])
def test_rounding_errors_add_nothing_to_sums(monkeypatch, dense):
    """A neighbour whose similarity is a rounding error weighs nothing, however the sums are formed."""
    nan = math.nan

    def side(lo, rows):
        u, i, x, d = (np.array(c) for c in zip(*rows, strict=True))
        return blocks._Side(u + lo, i, x, d, np.zeros((0, len(u)), int))

    a = side(0, [(0, 0, 0.1, 1.0), (0, 1, 0.7, 1.0), (0, 2, 1e-9, 1.0), (0, 3, nan, nan)])
    b = side(9, [(0, 0, 0.7, 1.0), (0, 1, -0.1, 1.0), (0, 3, 0.4, 9e9), (1, 2, 1e-9, 0.5), (1, 3, 0.4, 2.0), (1, 1, nan, nan), (2, 5, 1.0, 1.0),
                 *[(x, 5, 1.0, 1.0) for x in range(3, 30)]])
    monkeypatch.setattr(blocks._Sums, "_is_dense", lambda *_: dense)
    got = {x[:2]: x[2:] for cols in blocks._Sums(Rule(), 0).run(a, b, ITEMS) for x in zip(*(c.tolist() for c in cols), strict=True)}
    near = lambda x: pytest.approx(x, rel=1e-9, abs=0)
    assert got == {(0, 3): (near(2e-18), near(1e-18)), (10, 1): (near(1e-18), near(1e-18))}


def test_each_block_pair_is_a_task_of_its_own(spark):
    frame = spark.createDataFrame([(u, i, x) for (u, i), x in _ratings(120, 6).items()], "user_id BIGINT, item_id BIGINT, rhat DOUBLE")
    found = similarity.cosine_pairs(frame, block_rows=100)
    blocks_ = blocks._shape(similarity.rated(frame).select(F.lit(0).alias("cell"), "user_id", "item_id"), 100, 0)[1]
    own = F.greatest("u", "v")
    per = found.groupBy(F.spark_partition_id().alias("p")).agg(F.countDistinct(F.pmod(F.xxhash64(own), F.lit(blocks_)), F.pmod(
        F.xxhash64(F.least("u", "v")), F.lit(blocks_))).alias("n")).collect()
    assert len(per) == blocks_ * (blocks_ + 1) // 2 and max(r.n for r in per) <= 2  # (i, j) and (j, i)


def test_edges_of_a_user_come_together(spark, tmp_path):
    """Both directions of every pair once; written, a user's number is one run in a block pair, not one of two in turn (F1)."""
    frame = spark.createDataFrame([(u, i, 1.0) for (u, i) in _ratings(300, 9)], "user_id BIGINT, item_id BIGINT, rating DOUBLE")
    edges = similarity.jaccard_edges(frame, block_rows=900)
    got = [(r.u, r.v, r.sim) for r in edges.collect()]
    pairs = {(r.u, r.v): r.sim for r in similarity.jaccard_pairs(frame).collect()}
    assert len(got) == 2 * len(pairs) and {(u, v): s for u, v, s in got} == pairs | {(v, u): s for (u, v), s in pairs.items()}
    runs = 1 + sum(a[0] != b[0] for a, b in zip(got, got[1:], strict=False))
    assert runs * 20 < len(got)
