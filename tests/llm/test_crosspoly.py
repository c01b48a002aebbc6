"""Embedding links against all pairs, through every path: single vectors, balls, open pairs."""

import numpy as np
import pytest

from cofi.llm import crosspoly

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, n_links STRING, kept INT"


def plain(rows):
    """[(vec_id, n_links, component_id, kept)] of [(vec_id, vector)], every pair compared."""
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if good else None for (_, v), good in zip(rows, ok)]
    n = len(rows)
    links = [[j for j in range(n) if i != j and ok[i] and ok[j] and len(unit[i]) == len(unit[j])
              and unit[i] @ unit[j] >= 0.9] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), least, rows[i][0] is not None and rows[i][0] == least))
    return sorted(out, key=str)


def run(spark, rows):
    table = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)
    return sorted([tuple(r) for r in crosspoly.near_duplicates(table).collect()], key=str)


def around(rng, centre, cosine, n):
    """n vectors at ``cosine`` to the centre, so at about its square to each other."""
    x = rng.normal(size=(n, len(centre)))
    x -= (x @ centre)[:, None] * centre
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return (cosine * centre + np.sqrt(1 - cosine ** 2) * x).astype(np.float32).tolist()


def centre(rng, dim=64):
    x = rng.normal(size=dim)
    return x / np.linalg.norm(x)


def test_groups_of_all_kinds_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    c, d, e, f = (centre(rng) for _ in range(4))
    vectors = (around(rng, c, 0.999, 150) + around(rng, c, 0.93, 40)   # a ball and vectors around it that it half reaches
               + around(rng, d, 0.98, 120) + around(rng, e, 0.955, 100)  # a wide ball; a group too wide to be one
               + [f.astype(np.float32).tolist()] * 90                    # copies
               + rng.normal(size=(200, 64)).astype(np.float32).tolist())
    order = rng.permutation(len(vectors))
    rows = [(int(i), vectors[k]) for i, k in enumerate(order)]
    got, want = run(spark, rows), plain(rows)
    assert sum(w[1] for w in want) > 20_000
    found = {g[0]: g for g in got}
    assert all(found[w[0]][1] <= w[1] for w in want)  # no link below the threshold
    # vectors of one component still meet in some table: what is missed stays under the stated share
    assert sum(g[1] for g in got) >= 0.995 * sum(w[1] for w in want)
    assert [g[2] for g in got] == [w[2] for w in want]


def test_pairs_at_the_threshold_are_found(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(300):
        a = centre(rng)
        rows += [(2 * k, a.astype(np.float32).tolist()), (2 * k + 1, around(rng, a, 0.9005, 1)[0])]
    got = run(spark, rows)
    assert sum(g[1] for g in got) >= 0.98 * 600
    assert all(g[1] <= 1 for g in got)


def test_edge_rows(spark):
    nan = float("nan")
    unit = [1.0] + [0.0] * 7
    rows = [(1, unit), (1, unit), (2, [2.0] + [0.0] * 7), (3, [-1.0] + [0.0] * 7), (4, None), (5, []), (6, [0.0] * 8),
            (7, [1.0, None] + [0.0] * 6), (8, [1.0, nan] + [0.0] * 6), (9, [float("inf")] + [0.0] * 7), (None, unit), (None, None),
            (10, [1.0]), (11, [3.0]), (12, [1e-30] + [0.0] * 7), (13, [3e38] + [0.0] * 7), (14, [1.0] + [0.0] * 8)]
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("dim", [2, 3, 5])
def test_short_vectors(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(150, dim)).astype(np.float32).tolist())]
    got, want = run(spark, rows), plain(rows)
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(sorted(got, key=lambda r: r[0]), sorted(want, key=lambda r: r[0])))


def test_empty_table_and_doubles(spark):
    assert run(spark, []) == []
    table = spark.createDataFrame([(1, [1.0, 1e-9]), (2, [1.0, 0.0])], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    assert sorted(map(tuple, crosspoly.near_duplicates(table).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_hadamard_is_orthogonal():
    x = np.random.default_rng(0).normal(size=(20, 64))
    y = crosspoly.rotated(x, 7)
    assert np.allclose(y @ y.T, x @ x.T)
    assert np.allclose(crosspoly.hadamard(np.eye(4)) * 2, [[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]])


def test_tables_follow_depth():
    assert crosspoly.depth_for(500, 64) == 1 and crosspoly.depth_for(50_000, 64) == 2 and crosspoly.depth_for(10 ** 8, 64) == 4
    assert crosspoly.tables_for(64, 1, 0.9) <= crosspoly.tables_for(64, 2, 0.9) <= crosspoly.tables_for(64, 3, 0.9)
