"""Packed products against plain integers; mined rows against a plain search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cofi.llm import hardneg

SCHEMA = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT, rank STRING, peak INT"


@pytest.mark.parametrize("peak", [0, 1, 160, 5000, 3_000_000, 1 << 40])
def test_packed_scores_are_exact(peak):
    rng = np.random.default_rng(1)
    dim = 7
    fields, width, doubles = hardneg.layout(peak, dim)
    assert doubles == (peak < 1 << 22)
    a = rng.integers(-peak, peak + 1, size=(9, dim))
    small = 1 if peak < 1 << 31 else 1 << 20  # the scores have to fit in 64 bits
    c = rng.integers(-peak // small, peak // small + 1, size=(13, dim))
    a[0], c[0] = peak, -(peak // small)
    want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in c] for p in a]
    assert hardneg.Packed(c, peak, fields, width, doubles).scores(a).astype(np.int64).tolist() == want


def test_unit_vectors_share_a_double():
    assert hardneg.layout(160, 64) == (2, 23, True)


def plain(rows, every=3):
    ok = [(i, v, l) for i, v, l in rows if i is not None and l is not None and v is not None
          and all(x is not None and np.isfinite(x) for x in v)]
    ok = [(i, [int(np.floor(256.0 * x)) for x in v], (l + 1) % 10 if i % 7 == 0 else l) for i, v, l in ok]
    out = []
    for k, (i, v, label) in enumerate(ok):
        if i % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, m, l) for m, (j, w, l) in enumerate(ok)]
        order = sorted(scored, key=lambda s: (-s[0], s[1], s[2]))
        for ps, pid, m, _ in [s for s in order if s[3] == label and s[2] != k][:5]:
            fits = [s for s in order if s[3] != label and 50 * ps <= 100 * s[0] <= 95 * ps][:3]
            out += [(i, pid, rank + 1, s[1], ps, s[0]) for rank, s in enumerate(fits)]
    return sorted(out)


def run(spark, rows, every=3):
    table = spark.createDataFrame([(i, v, l, "x", 3) for i, v, l in rows], SCHEMA)
    got = hardneg.hard_negatives(hardneg.prepared(table, hardneg.shifted_label()), F.col("vec_id") % every == 0)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("tile", [(4, 3, 7), (512, 512, 4096)])
def test_mined_rows_equal_a_plain_search(spark, monkeypatch, tile):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(90, 6)).tolist()
    rows = [(i, v, int(rng.integers(0, 4))) for i, v in enumerate(vectors)]
    rows += [(3, vectors[3], 1), (3, vectors[3], 1), (200, vectors[9], 2), (201, vectors[9], 2), (202, vectors[9], 3)]  # ties, repeats
    for name, value in zip(("TILE", "FIRST", "STEP"), tile):
        monkeypatch.setattr(hardneg, name, value)
    want = plain(rows)
    assert len(want) > 100
    assert run(spark, rows) == want


def test_many_blocks_and_slices(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, v, i % 3) for i, v in enumerate(rng.normal(size=(60, 5)).tolist())]
    monkeypatch.setattr(hardneg, "BLOCK_ROWS", 9)
    assert run(spark, rows, 2) == plain(rows, 2)


def test_edge_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (6, [0.7, 0.1], 2), (9, [0.9, 0.0, 5.0], 2), (12, [], 1), (15, None, 1),
            (18, [1.0, None], 1), (21, [float("nan"), 1.0], 1), (24, [float("-inf"), 1.0], 1), (27, [1.0, 1.0], None),
            (None, [1.0, 0.0], 1), (30, [0.6, 0.0], 9), (-3, [0.8, 0.0], 4), (33, [0.0, 0.0], 4), (36, [0.0, 0.0], 4), (39, [1e6, 1.0], 7)]
    want = plain(rows)
    assert want and run(spark, rows) == want


def test_empty_and_large_components(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1)]) == []
    rows = [(0, [1e7, 1.0], 1), (1, [9e6, 1.0], 1), (2, [5e6, 2.0], 2), (3, [8e6, -1.0], 2)]  # products of over 53 bits
    assert run(spark, rows) == plain(rows) != []
    with pytest.raises(Exception, match="not exact in double precision"):
        run(spark, [(0, [1e30], 1), (1, [1e30], 1)])
