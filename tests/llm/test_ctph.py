"""Edited forms against plain string work; fingerprints' rules; likeness against a plain edit distance."""

import hashlib
import random

import pytest

from cofi.llm import ctph


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] if x == y else 1 + min(row[j], new[-1]))
        row = new
    return row[-1]


def texts():
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghé") for _ in range(r.randint(1, 8)))
    out = [" ".join(word() for _ in range(r.choice([0, 1, 5, 60, 300, 2000]))) for _ in range(60)]
    return out + [None, "", "x", "a" * 100_000, "ab\n" * 40_000, out[5], out[5], "é" * 7]


@pytest.mark.parametrize("partitions", [1, 7])
def test_rows(spark, partitions):
    rows = list(enumerate(texts()))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(3 * i, t, "k", "f") for i, t in rows], "doc_id BIGINT, text STRING, kind STRING, fingerprint STRING")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.doc_id: r for r in ctph.edited_likeness(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    rows = [(3 * i, t or "") for i, t in sorted(rows)]
    assert len(got) == len(rows)
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        q = len(t) // 4
        new = t[:len(t) - q] + after[:q]
        mark, r = ctph.fingerprint(t.encode()), got[i]
        assert (r.n_chars, r.fingerprint, r.edited_fingerprint) == (len(t), mark, ctph.fingerprint(new.encode()))
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.near_edited == ctph.likeness(mark, r.edited_fingerprint)
        assert r.near_next == ctph.likeness(mark, ctph.fingerprint(after.encode()))
        if len(t) > 1500 and len(set(t)) > 3:
            assert 0.5 < r.near_edited < 1
            assert r.near_next < 0.3 or t == after


def test_edges(spark):
    df = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert ctph.edited_likeness(df).count() == 0 and ctph.fingerprints(df).count() == 0
    one = ctph.edited_likeness(spark.createDataFrame([(None, "abcdefgh")], "doc_id BIGINT, text STRING")).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    same = ctph.edited_likeness(spark.createDataFrame([(1, "abcd"), (1, "abcd"), (None, None)], "doc_id BIGINT, text STRING"))
    assert same.count() == 3 and {r.n_chars for r in same.collect()} == {0, 4}


def test_likeness_is_the_edit_distance():
    r = random.Random(3)
    for _ in range(300):
        a, b = ("".join(r.choice(["AA", "AB", "BA", "CD"]) for _ in range(r.randint(1, 64))) for _ in range(2))
        x, y = ([s[i:i + 2] for i in range(0, len(s), 2)] for s in (a, b))
        assert ctph.likeness_of(a, b) == 1 - plain_distance(x, y) / (len(x) + len(y))


def test_pieces_do_not_depend_on_what_is_far_away():
    r = random.Random(9)
    body = bytes(r.randrange(256) for _ in range(60_000))
    size, units, coarse = ctph.fingerprint(body).split(":")
    assert len(units) <= 2 * ctph.UNITS and len(coarse) <= len(units)
    for new in (body[:30_000] + b"!" + body[30_000:], body[1:], body[:-1], body + body[:300]):
        assert ctph.likeness(ctph.fingerprint(body), ctph.fingerprint(new)) > 0.9
    assert ctph.likeness(ctph.fingerprint(body), ctph.fingerprint(body + body[::-1])) > 0.4  # twice the block size
    assert ctph.likeness("3::", ctph.fingerprint(b"abc")) == 0 and ctph.likeness("3::", "3::") == 1
