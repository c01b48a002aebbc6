"""Fingerprints and components against a plain version; each path of the search on its own."""

import random
import re

import numpy as np
import pytest
import xxhash

from cofi.llm import simhash


def plain_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, distance):
    root = {i: i for i in fps}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def texts():
    r = random.Random(4)
    words = ["Alpha", "beta", "gamma", "ÀÉ", "delta", "x"]
    out = [" ".join(r.choice(words) for _ in range(r.randint(0, 12))) for _ in range(80)]
    base = [f"w{r.randint(0, 999)}" for _ in range(400)]
    for k in range(40):
        x = list(base)
        x[r.randrange(400)] = f"z{k % 9}"
        out.append(" ".join(x))
    return out + [None, "", " \t\n", "one", "one two", "ONE two", "p q r " * 60_000, base and " ".join(base)]


@pytest.mark.parametrize("dense", [simhash.DENSE, 0])
def test_groups(spark, dense):
    t = texts()
    rows = [(i, x, "k", 0) for i, x in enumerate(t)]
    df = spark.createDataFrame([*rows, rows[3], (None, "no id", "k", 0)],
                               "doc_id BIGINT, text STRING, fingerprint STRING, fp INT")
    got = simhash.groups(df, dense=dense).collect()
    assert len(got) == len(t) + 2
    fps = {i: plain_fp(x) for i, x in enumerate(t)}
    comp = plain_components(fps, 2)
    for r in got:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == (f"{fps[r.doc_id]:016x}", comp[r.doc_id])
    kept = simhash.keep_one(df, dense=dense)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted(set(comp.values())) and ids.count(None) == 1


@pytest.mark.parametrize("distance,dense", [(2, 64), (2, 0), (3, 64), (3, 0), (1, 64), (4, 3)])
def test_links_of_random_fingerprints(spark, distance, dense):
    r = random.Random(distance)
    fps = [r.getrandbits(64) & ~0xFFFF for _ in range(60)]  # a partition that all share
    for _ in range(200):
        x = r.choice(fps)
        for b in r.sample(range(64), r.randint(1, distance + 1)):
            x ^= 1 << b
        fps.append(x)
    fps = sorted(set(fps))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp BIGINT")
    links = [(x.a, x.b) for x in simhash.links(df, distance, dense).collect()]
    if dense == 64:
        apart = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
        want = {(a, b) for a in signed for b in signed if a < b and apart(a, b) <= distance}
        assert {tuple(sorted(x)) for x in links} == want
    order = {x: i for i, x in enumerate(signed)}
    want = plain_components(dict(enumerate(fps)), distance)
    node = {r.node: r.root for r in simhash.components(df.sparkSession.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    same = lambda f: {frozenset(i for i in order.values() if f(i) == c) for c in {f(i) for i in order.values()}}
    assert same(lambda i: want[i]) == same(lambda i: node.get(signed[i], signed[i]))


def test_thresholds_pass_over_common_values():
    t, expected = simhash.thresholds(np.array([[1.0, 1, 1], [1e6, 1, 1]]), [22, 21, 21], 10**6, 2)
    assert t[0].tolist() == [0, 0, 0] and t[1][0] == -1 and (t + 1).sum(axis=1).tolist() == [3, 3]
    assert expected[1] < 1e6


def test_empty(spark):
    assert simhash.groups(spark.createDataFrame([], "doc_id BIGINT, text STRING")).count() == 0


def test_rows_that_share_a_doc_id_but_not_a_text(spark):
    """Each is judged by its own component: nothing that has no copy goes."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (7, c), (7, c), (8, b), (None, a), (9, None), (9, "only this")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id BIGINT, text STRING, `a.b` STRING")
    kept = sorted(((r[0], r[1]) for r in simhash.keep_one(docs).collect()), key=str)
    assert kept == sorted([(3, a), (5, b), (7, c), (None, a), (9, None), (9, "only this")], key=str)
