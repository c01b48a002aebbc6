"""Invariants on the derived events ratings (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from cofi.operators import approx, knn, similarity, stats
from cofi.operators.pairs import co_rated_pairs
from cofi.plans.catalog import Fixture

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ev(spark):
    return Fixture(spark, SF, "e", shared=True)


def test_salted_pairs_equal_plain(ev):
    """Cutting every key into blocks (tiny block size) must not change any pair sum."""
    def sums(**kw):
        return {(r.u, r.v): r.s for r in co_rated_pairs(ev.rhat, ["item_id"], "rhat", **kw)
                .groupBy("u", "v").agg(F.sum(F.col("a") * F.col("b")).alias("s"),
                                       F.count(F.lit(1)).alias("c")).collect()}
    plain = sums(block_rows=10**6)
    salted = sums(block_rows=2)
    assert plain.keys() == salted.keys()
    for k, v in plain.items():
        assert salted[k] == pytest.approx(v, abs=1e-12)
    assert all(u < v for u, v in plain)


def test_similarity_symmetric_and_bounded(ev):
    e = {(r.u, r.v): r.sim for r in ev.cosine_edges().collect()}
    assert all(e[(v, u)] == pytest.approx(s, abs=1e-12) for (u, v), s in e.items())
    assert all(-1 - 1e-9 <= s <= 1 + 1e-9 for s in e.values())
    assert all(u != v for u, v in e)


def test_knn_at_all_candidates_equals_all_neighbours(ev):
    n = ev.users.count()
    g = knn.knn_graph(ev.rhat, n - 1, F.lit(n - 1))
    assert {(r.user_id, r.neighbor_id) for r in g.collect()} == set(
        (r.u, r.v) for r in ev.cosine_edges().collect())


def test_knn_ranks_are_increasing(ev):
    for r in ev.knn(5).groupBy("user_id").agg(F.collect_list("rank").alias("rs")).collect():
        assert len(set(r.rs)) == len(r.rs) and max(r.rs) <= 5


def test_approx_replication_equals_partitions_is_exact(ev):
    exact = {tuple(r) for r in ev.knn(5).select("user_id", "neighbor_id", "rank").collect()}
    full = {tuple(r) for r in approx.knn_approx(ev.rhat, ev.users, 5, 4, 4)
            .select("user_id", "neighbor_id", "rank").collect()}
    assert exact == full


def test_user_bins_shape(ev):
    b = approx.user_bins(ev.users, 10, 2)
    per_user = {r.user_id: r.n for r in b.groupBy("user_id").agg(F.countDistinct("bin").alias("n")).collect()}
    assert set(per_user.values()) == {2}
    assert b.where("bin < 0 OR bin > 9").count() == 0


def test_approx_pairs_subset_of_exact(ev):
    """Every pair that shares a bin, once, in the lowest bin it shares, with its exact similarity."""
    bins = approx.user_bins(ev.users, 6, 3)
    of = {}
    for r in bins.collect():
        of.setdefault(r.user_id, set()).add(r.bin)
    rows = approx.bin_pairs(ev.rhat, bins, 6).collect()
    ap = {(r.u, r.v): r.sim for r in rows}
    ex = {(r.u, r.v): r.sim for r in similarity.cosine_pairs(ev.rhat).collect()}
    assert len(ap) == len(rows) and set(ap) == {(u, v) for u, v in ex if of[u] & of[v]}
    assert all(r.bin == min(of[r.u] & of[r.v]) for r in rows)
    for k, v in ap.items():
        assert v == pytest.approx(ex[k], abs=1e-12)


@pytest.mark.parametrize("k", [1, 4])
def test_lists_are_cut_before_the_merge(ev, k):
    """At most k edges per user and bin are written, and one count; their merge is the graph."""
    bins = approx.user_bins(ev.users, 4, 3)
    lists = approx.bin_lists(ev.rhat, bins, k, 4)
    per = lists.groupBy("user_id", "bin").agg(F.count("neighbor_id").alias("n"), F.max("_stored").alias("stored"),
                                              F.count("_stored").alias("counts")).collect()
    assert all(r.n == min(k, r.stored) and r.counts == 1 for r in per) and any(r.stored > k for r in per)
    assert lists.where("neighbor_id IS NOT NULL").count() <= k * 3 * ev.users.count()


def test_exact_graph_writes_no_pair_table(ev, monkeypatch):
    written = []
    keep = knn.materialize
    monkeypatch.setattr(knn, "materialize", lambda df, name="", **how: written.append((name, keep(df, name, **how))) or written[-1][1])
    knn.knn_graph(ev.rhat, 3, F.lit(ev.users.count() - 1)).collect()
    assert [n for n, _ in written] == ["partial_lists"]
    assert written[0][1].where("neighbor_id IS NOT NULL").groupBy("user_id").count().agg(F.max("count")).first()[0] == 3


def test_uniform_equals_baseline_shape(ev):
    """Averages stay inside the rating scale."""
    ua = stats.user_avg(ev.train).agg(F.min("user_avg"), F.max("user_avg")).first()
    assert 1.0 <= ua[0] <= ua[1] <= 5.0


@pytest.mark.parametrize("k", [1, 3, 10, 40])
def test_top_k_against_brute_force(spark, ev, k):
    """Histogram-bounded ranking vs. a full ranking of every candidate (zeros included)
    on a thinned fixture, where most pairs have nothing in common."""
    import math

    thin = ev.train.where("(user_id * 7 + item_id * 13) % 3 = 0")
    rhat = stats.preprocessed(stats.norm_dev(thin))
    pairs = similarity.cosine_pairs(rhat).collect()
    users = sorted(r.user_id for r in thin.select("user_id").distinct().collect())
    sim = {}
    for r in pairs:
        sim[(r.u, r.v)] = sim[(r.v, r.u)] = r.sim
    want = set()
    for u in users:
        cand = [(v, sim.get((u, v), 0.0)) for v in users if v != u]
        key = lambda x: (-math.floor(x[1] * 1e10 + 0.5), x[0])
        for rank, (v, s) in enumerate(sorted(cand, key=key), start=1):
            if rank <= k and (u, v) in sim:
                want.add((u, v, rank))
    g = knn.knn_graph(rhat, k, F.lit(len(users) - 1))
    got = {(r.user_id, r.neighbor_id, r.rank) for r in g.collect()}
    assert got == want


@pytest.mark.parametrize("partitions,replication", [(6, 2), (5, 4), (70, 3), (4, 4), (64, 16)])
def test_candidate_counts(ev, partitions, replication):
    """Unions of bit maps against every pair of users; the sweep's masks beyond one number of bins."""
    bins = approx.user_bins(ev.users, partitions, replication)
    of = {}
    for r in bins.collect():
        of.setdefault(r.user_id, set()).add(r.bin)
    got = {r.user_id: r.n_cand for r in approx.candidates(approx._bin_sets(bins, [])).collect()}
    assert got == {u: sum(bool(b & c) for v, c in of.items() if v != u) for u, b in of.items()}


def test_sweep_masks_of_many_bins(ev, monkeypatch):
    """The same graph whether the bins fit one mask number or need several."""
    graph = lambda: {tuple(r) for r in approx.replication_sweep_graph(ev.rhat, ev.users, 4, 9, [1, 3])
                     .select("user_id", "neighbor_id", "replication", "rank").collect()}
    one = graph()
    monkeypatch.setattr(approx, "MASK_BITS", 2)
    assert graph() == one and one


def test_requested_users_equal_the_whole_graph(ev, spark):
    users = spark.createDataFrame([(1,), (3,), (7,)], "user_id BIGINT")
    want = {tuple(r) for r in ev.knn(5).where("user_id IN (1, 3, 7)").select("user_id", "neighbor_id", "rank").collect()}
    for asked in (users, [1, 3, 7]):
        graph, _ = knn.knn_of(ev.train, asked, 5)
        assert {tuple(r) for r in graph.select("user_id", "neighbor_id", "rank").collect()} == want
    near = {(r.u, r.v): round(r.sim, 9) for r in similarity.jaccard_edges(ev.train).where("u = 3").collect()}
    assert {(r.u, r.v): round(r.sim, 9) for r in similarity.jaccard_of(ev.train, 3).collect()} == near


@pytest.mark.parametrize("k", [2, 5, 12])
def test_sweep_ranking_equals_per_level_top_k(ev, k):
    """One sort per user with running per-level counts == ranking each level separately."""
    from cofi.operators.pairs import symmetrize

    pairs = similarity.cosine_pairs(ev.rhat)
    levels = [1, 2, 3, 5]
    got = {tuple(r) for r in approx.replication_sweep_graph(ev.rhat, ev.users, k, 6, levels)
           .select("user_id", "neighbor_id", "replication", "rank").collect()}
    want = set()
    for r in levels:
        bins = approx.user_bins(ev.users, 6, r)
        both = bins.select(F.col("user_id").alias("u"), "bin").join(bins.select(F.col("user_id").alias("v"), "bin"), "bin")
        shared = pairs.join(both.select("u", "v").distinct(), ["u", "v"])
        sets = bins.groupBy("user_id").agg(F.sort_array(F.collect_list("bin")).alias("bins"))
        g = knn.top_k(symmetrize(shared), k, approx.candidates(sets))
        want |= {(x.user_id, x.neighbor_id, r, x.rank) for x in g.collect()}
    assert got == want


@pytest.mark.parametrize("n_new,k", [(1, 3), (4, 3), (4, 60)])
def test_lists_with_new_users_equal_a_rebuild(ev, spark, n_new, k):
    """Users appended to a graph (sharing items with others, with each other, or with no one) == building it anew."""
    ids = sorted(r.user_id for r in ev.users.collect())
    new = ids[-n_new:]
    lone = spark.createDataFrame([(10**6, 10**6, 3.0), (10**6, 10**6 + 1, 5.0)], ev.train.schema)
    data = ev.train.unionByName(lone)
    added = spark.createDataFrame([(u,) for u in [*new, 10**6, 10**6]], "user_id BIGINT")
    old = data.where(~F.col("user_id").isin([*new, 10**6]))
    lists = knn.knn_lists(stats.enrich(old).select("user_id", "item_id", "rhat"), k)
    got = knn.merged(knn.with_new_users(lists, data, added, k), k, stats.n_users(data) - 1)
    want = knn.knn_from_ratings(data, k)
    rows = lambda g: {(r.user_id, r.neighbor_id, r.rank, round(r.sim, 9)) for r in g.collect()}
    assert rows(got) == rows(want) and any(r[1] in new for r in rows(got))
    with pytest.raises(Exception, match="not a new user"):
        knn.with_new_users(lists, data, spark.createDataFrame([(ids[0],)], "user_id BIGINT"), k).collect()


def test_new_users_meet_written_preprocessed_ratings(ev, spark, monkeypatch):
    """With the earlier users' preprocessed ratings at hand only the new users' are formed; the graph is that of a rebuild."""
    new = sorted(r.user_id for r in ev.users.collect())[-3:]
    added = spark.createDataFrame([(u,) for u in new], "user_id BIGINT")
    rhat = stats.enrich(ev.train.where(~F.col("user_id").isin(new))).select("user_id", "item_id", "rhat")
    lists, want, formed = knn.knn_lists(rhat, 3), knn.knn_from_ratings(ev.train, 3), []
    enrich = stats.enrich
    monkeypatch.setattr(stats, "enrich", lambda t: formed.append({r.user_id for r in t.select("user_id").distinct().collect()}) or enrich(t))
    got = knn.merged(knn.with_new_users(lists, ev.train, added, 3, rhat), 3, stats.n_users(ev.train) - 1)
    rows = lambda g: {(r.user_id, r.neighbor_id, r.rank, round(r.sim, 9)) for r in g.collect()}
    assert rows(got) == rows(want) and formed == [set(new)]


def _sets(spark, seed=4):
    """Users in groups that share most of their rare items; everyone has frequent ones too."""
    import random
    r = random.Random(seed)
    rows = set()
    for group in range(30):
        own = [1000 + 50 * group + i for i in range(20)]
        for u in range(4):
            rows |= {(group * 10 + u, i) for i in r.sample(own, r.randint(12, 20)) + r.sample(range(10), r.randint(1, 8))}
    rows |= {(900, 1), (901, 1), (902, 77)}  # one item; an item of no one else
    return rows, spark.createDataFrame([(u, i, 3.0) for u, i in rows], "user_id BIGINT, item_id BIGINT, rating DOUBLE")


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.5, 0.6, 0.8, 1.0])
def test_jaccard_above_equals_brute_force_with_fewer_candidates(spark, threshold):
    rows, df = _sets(spark)
    items = {}
    for u, i in rows:
        items.setdefault(u, set()).add(i)
    sims = {(u, v): len(a & b) / len(a | b) for u, a in items.items() for v, b in items.items() if u < v and a & b}
    got = {(r.u, r.v): r.sim for r in similarity.jaccard_at_least(df, threshold, block_rows=16).collect()}
    assert got == {p: s for p, s in sims.items() if s >= threshold}
    n = similarity.jaccard_candidates(df, threshold).count()
    assert len(got) <= n <= len(sims)
    if threshold >= 0.5:
        assert 10 * n < len(sims)  # pairs that share frequent items only are not formed
    assert similarity.jaccard_at_least(df.limit(0), threshold).count() == 0


def test_jaccard_threshold_is_checked(spark):
    for bad in (0, -1, 1.1):
        with pytest.raises(ValueError):
            similarity.jaccard_at_least(_sets(spark)[1], bad)
