"""Collocations against a plain count of every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cofi.llm import phrases


def plain(rows, least, top):
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, 6):
                count[lang].update(zip(*[w[i:] for i in range(m)]))
    out = []
    for lang, f in count.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in cands.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                for q in [p[i:j]] if q != p and 100 * a >= 100 * f[q]}
        rows_ = []
        for p, a in cands.items():
            if p in gone:
                continue
            score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows_)[:top]):
            out.append((lang, rank + 1, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


def run(spark, rows, least, top):
    docs = spark.createDataFrame([(None, t, l, "x", 7) for l, t in rows], "doc_id BIGINT, text STRING, lang STRING, rank STRING, n INT")
    return sorted(tuple(r) for r in phrases.collocations(docs, least, top).collect())


def corpus(seed, n):
    r = random.Random(seed)
    words = ["the", "of", "Über", "x1", "a b", "go", "GO", "\x00z", "\U0001f600"] + [f"w{i}" for i in range(40)]
    weights = [400, 200] + [30] * 7 + [6] * 40
    fixed = ["new york city hall", "Alpha beta", "one two three four five six seven", "the the the the the the the"]
    seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!?", "\x0b"]
    rows = []
    for k in range(n):
        out = []
        for _ in range(r.randint(0, 120)):
            out += [r.choices(words, weights)[0] if r.random() < 0.9 else r.choice(fixed), r.choice(seps)]
        rows.append((["en", "de", None, ""][k % 4], "".join(out)))
    return rows


@pytest.mark.parametrize("least,top", [(4, 2000), (6, 25), (3, 7)])
def test_equal_to_a_plain_count(spark, least, top):
    rows = corpus(least, 120) + [("en", None), (None, None), ("en", ""), ("fr", "one word"), ("de", " \t\n.")]
    want = plain(rows, least, top)
    assert len(want) >= 28
    assert run(spark, rows, least, top) == want


def test_common_first_words_are_not_expanded(spark, monkeypatch):
    """Once a language is settled its remaining first words leave the frontier."""
    r = random.Random(8)
    rows = [("en", " ".join(r.choice(["the", "of", "and"]) for _ in range(300))) for _ in range(20)]
    rows += [("en", f"rare{k} pair{k}. " * 5) for k in range(60)]
    seen = []
    grown = phrases.grown
    monkeypatch.setattr(phrases, "grown", lambda *a: seen.append(a[1]) or grown(*a))
    got = run(spark, rows, 5, 20)
    assert got == plain(rows, 5, 20)
    assert len(seen) <= 4  # one wave: lengths 2, 3 (and none after)


def test_nothing_to_find(spark):
    assert run(spark, [], 3, 10) == []
    assert run(spark, [("en", "a b c")], 3, 10) == []
    assert run(spark, [("en", "a. a. a. b! b! b!")], 3, 10) == []


def test_wrong_hits_of_the_bit_map_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST_BITS", 32768)
    monkeypatch.setattr(phrases.BitMap, "has", lambda self, h: np.ones(len(h), bool))
    rows = corpus(1, 40)
    assert run(spark, rows, 4, 50) == plain(rows, 4, 50)


def test_words_of_a_batch():
    words, new = phrases.words_of(pa.array(["Ab c", None, "", "d.e\tF", ".", "g"], pa.string()).slice(0))
    assert [w.decode() for w in words.to_pylist()] == ["ab", "c", "d", "e", "f", "g"]
    assert new.tolist() == [True, False, True, True, False, True]
    assert len(phrases.words_of(pa.array([], pa.string()))[0]) == 0


def test_scores_over_64_bits(spark):
    big = 4_000_000_000
    found = spark.createDataFrame([("en", "a b", big)], "lang STRING, phrase STRING, a BIGINT")
    counts = spark.createDataFrame([("en", "a", big + 1), ("en", "b", big + 3)], "lang STRING, phrase STRING, n BIGINT")
    totals = spark.createDataFrame([("en", 9 * big)], "lang STRING, n BIGINT")
    row = phrases.scored(found, counts, totals).first()
    assert row["score"] == 1000 * big * 9 * big // ((big + 1) * (big + 3))


def test_batches_and_blocks_stay_small(spark, monkeypatch, tmp_path):
    """No batch to Python holds more than ``BATCH_BYTES`` and a row, the session's own limit is back afterwards, and
    a block is packed where it is made."""
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", str(tmp_path / "seen")
    monkeypatch.setattr(phrases, "BATCH_BYTES", 1 << 17)
    plain_map, blocks = phrases.map_batches, []

    def noted(df, fn, schema):
        def look(batch):
            with open(seen, "a") as f:
                f.write(f"{batch.nbytes - batch.nbytes // batch.num_rows}\n")
            return fn(batch)

        return plain_map(df, look, schema)

    def kept(df, name, *a):
        out = materialize(df, name, *a)
        blocks.extend([out] if name == "blocks" else [])
        return out

    materialize = phrases.materialize
    monkeypatch.setattr(phrases, "map_batches", noted)
    monkeypatch.setattr(phrases, "materialize", kept)
    rows = [("en", "Alpha beta gamma. \x0bdelta \x1f\x85 " * 700) for _ in range(60)]
    spark.conf.set(key, "32m")
    try:
        got = run(spark, rows, 100, 20)
        assert spark.conf.get(key) == "32m"
    finally:
        spark.conf.unset(key)
    assert got == plain(rows, 100, 20)
    assert max(map(int, open(seen).read().split())) <= (1 << 17)
    assert sum(len(r["numbers"]) for r in blocks[0].collect()) < 4 * 60 * 700
