"""Both substring operators against plain versions, and their indexes against sorted suffixes."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from cofi.llm import fm, repeats, suffix


def plain_words(rows, length):
    """{doc_id: (n_words, n_removed, kept)}: every window of every document."""
    words = {i: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for i, t in rows}
    places = defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - length + 1):
            places[tuple(w[k:k + length])].add((i, k))
    gone = defaultdict(set)
    for ps in places.values():
        if len(ps) > 1:
            for i, k in ps:
                gone[i] |= set(range(k, k + length))
    return {i: (len(w), len(gone[i]), b" ".join(x for k, x in enumerate(w) if k not in gone[i])) for i, w in words.items()}


def plain_bytes(rows, length):
    """{doc_id: (n_bytes, n_removed, n_spans, kept)}."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        raw, gone = (t or "").encode(), set()
        for k in range(len(raw) - length + 1):
            if raw[k:k + length] in seen:
                gone |= set(range(k, k + length))
            seen.add(raw[k:k + length])
        spans = sum(k - 1 not in gone for k in gone)
        out[i] = (len(raw), len(gone), spans, bytes(x for k, x in enumerate(raw) if k not in gone))
    return out


def texts(seed):
    r = random.Random(seed)
    vocabulary = [f"{r.choice('abcdé')}{i}" for i in range(400)]
    fresh = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    shared = [fresh(r.choice([34, 35, 36, 60, 120])) for _ in range(6)]
    out = []
    for _ in range(90):
        x = [fresh(r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            x += [r.choice(shared), fresh(r.randint(0, 30))]
        out.append(r.choice([" ", "\n", "  ", "\x0b"]).join(x))
    near = out[3].split()
    near[len(near) // 2:len(near) // 2] = ["new"]
    return out + [out[3], out[3], " ".join(near), None, "", " \n", "one", shared[0] + " " + shared[0], "z " * 300, "ab" * 400,
                  "é" * 150, "x" * 99, "x" * 100, "x" * 101, fresh(20_000)]


@pytest.mark.parametrize("hot,parts", [(repeats.HOT, 5), (2, 3)])
def test_words(spark, hot, parts):
    rows = list(enumerate(texts(1)))
    df = spark.createDataFrame([(i, t, "k", 0) for i, t in [*rows, rows[4], (None, rows[5][1])]],
                               "doc_id BIGINT, text STRING, kept STRING, n INT")
    want = plain_words(rows, 35)
    got = fm.remove_repeats(df, parts=parts, hot=hot).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, bytes(r.kept)) == want[r.doc_id]
            assert sum(s.end - s.start for s in r.spans) == r.n_removed
    assert sum(x[1] for x in want.values()) > 2000


@pytest.mark.parametrize("hot,parts", [(repeats.HOT, 5), (2, 3)])
def test_bytes(spark, hot, parts):
    rows = list(enumerate(texts(2)))
    df = spark.createDataFrame([(i, t, "k", 0) for i, t in [*rows, rows[4], (None, rows[5][1])]],
                               "doc_id BIGINT, text STRING, spans STRING, first INT")
    want = plain_bytes(rows, 100)
    got = suffix.remove_repeats(df, parts=parts, hot=hot).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == want[r.doc_id]
    assert sum(x[1] for x in want.values()) > 8000


def test_a_passage_of_many_documents_makes_no_large_group(spark):
    """Each text around it is another, so none of its stretches are equal at its edges."""
    r = random.Random(3)
    word = lambda: f"w{r.randint(0, 10**6)}"
    passage = " ".join(word() for _ in range(60))
    rows = [(i, f"{' '.join(word() for _ in range(40))} {passage} {' '.join(word() for _ in range(40))}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(20)
    for module, kind, plain, length in ((fm, fm.Words(), plain_words, 35), (suffix, suffix.Bytes(), plain_bytes, 100)):
        found = repeats.candidates(df, kind, 3)
        dealt, alone = repeats.shards(repeats.segments(df, found, kind), kind, 3, hot=5)
        stretches: dict[int, dict[bytes, set]] = defaultdict(lambda: defaultdict(set))
        for x in dealt.collect():
            for k in range(x.n):
                stretches[x.shard][kind.part(bytes(x.data), k)].add((x.doc_id, x.first + k))
        assert all(len(places) <= 5 for shard in stretches.values() for places in shard.values())
        windows = repeats.equal_windows(alone).collect()
        assert len(windows) == len({bytes(x.window) for x in windows}) > 0
        want = plain(rows, length)
        for x in module.remove_repeats(df, parts=3, hot=5).collect():
            assert (x[1], x.n_removed, bytes(x.kept)) == (want[x.doc_id][0], want[x.doc_id][1], want[x.doc_id][-1])
        assert sum(x[1] for x in want.values()) > 0


def test_repeated_rows_in_different_pieces(spark, monkeypatch):
    """Equal rows are one document wherever a piece ends: what stands in it alone stays."""
    monkeypatch.setattr(repeats, "BLOCK", 1)
    rows = list(enumerate(texts(4)))
    again = [rows[7], rows[8], rows[-1], rows[7]]
    df = spark.createDataFrame([*again, *rows], "doc_id BIGINT, text STRING")
    for module, plain in ((fm, plain_words(rows, 35)), (suffix, plain_bytes(rows, 100))):
        got = module.remove_repeats(df, parts=3).collect()
        assert len(got) == len(rows) + len(again)
        for x in got:
            assert (x[1], x.n_removed, bytes(x.kept)) == (*plain[x.doc_id][:2], plain[x.doc_id][-1])


def test_parts_follow_the_texts(spark, monkeypatch):
    df = spark.createDataFrame([(i, "é" * 500) for i in range(100)], "doc_id BIGINT, text STRING")
    assert repeats.default_parts(df) == 8
    monkeypatch.setattr(repeats, "PART", 1000)
    assert repeats.default_parts(df) == 101
    assert repeats.default_parts(df.limit(0)) == 8


def test_whole_small_table(spark):
    """The registered queries' rows on the smallest documents."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    w, b = plain_words(rows, 35), plain_bytes(rows, 100)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert {tuple(r) for r in fm.digest(df).collect()} == {(i, n, k, sha(x)) for i, (n, k, x) in w.items()}
    assert {tuple(r) for r in suffix.digest(df).collect()} == {(i, n, k, s, sha(x)) for i, (n, k, s, x) in b.items()}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert fm.digest(df).count() == suffix.digest(df).count() == 0
    df = spark.createDataFrame([(1, "short"), (2, None)], "doc_id BIGINT, text STRING")
    assert fm.digest(df).count() == suffix.digest(df).count() == 2


def test_suffix_arrays():
    r = random.Random(0)
    for _ in range(800):
        n, top = r.randint(1, 60), r.choice([0, 1, 2, 300, 10**6])
        s = np.array([r.randint(0, top) for _ in range(n)], np.int64)
        assert suffix.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


def test_fm_index_counts():
    r = random.Random(1)
    for _ in range(100):
        n, top, length = r.randint(1, 200), r.choice([1, 3, 70]), r.randint(1, 5)
        s = np.array([r.randint(1, top) for _ in range(n)] + [0], np.int64)
        starts = np.arange(max(0, n - length + 1))
        windows = [tuple(s[i:i + length]) for i in starts]
        assert fm.FmIndex(s, top).occurs(s, starts, length).tolist() == [windows.count(x) > 1 for x in windows]


def test_anchors_cover_every_window_and_depend_on_it_alone(monkeypatch):
    r = random.Random(2)
    for chunk in (7, 1000):
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        for _ in range(60):
            docs = [np.array([r.randint(0, 3) for _ in range(r.randint(0, 80))], np.uint64) for _ in range(4)]
            bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
            found = list(zip(*(x.tolist() for x in repeats.anchors(np.concatenate(docs), bounds, 20, 4))))
            places = sorted((d, f + j) for d, f, n, _ in found for j in range(n))
            assert places == [(i, j) for i, x in enumerate(docs) for j in range(len(x) - 19)]
            of: dict[bytes, int] = {}
            for d, f, n, h in found:
                for j in range(n):
                    assert of.setdefault(docs[d][f + j:f + j + 20].tobytes(), h) == h


@pytest.mark.parametrize("other", ["short", None, "", "LONG"])
def test_one_doc_id_with_different_texts(spark, other):
    """Rows with one doc_id and different texts are documents of their own; equal ones are one."""
    from cofi.llm import fm, suffix

    passage = " ".join(f"p{i}q" for i in range(80))
    other = " ".join(f"other{i}" for i in range(30)) + " " + passage if other == "LONG" else other
    rows = [(7, "before " + passage + " after"), (7, other), (7, other), (8, passage + " tail")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    words = sorted((r.doc_id, r.n_words, r.n_removed) for r in fm.remove_repeats(docs).collect())
    n = 0 if not other else len(other.split())
    gone = 80 if n > 80 else 0
    assert words == sorted([(7, 82, 80), (7, n, gone), (7, n, gone), (8, 81, 80)])
    got = suffix.remove_repeats(docs).collect()
    assert sorted(r.doc_id for r in got) == [7, 7, 7, 8]
    held = [r for r in got if r.doc_id == 8][0]
    assert held.n_removed == len(passage) + 1  # the passage and its space start earlier, in a document 7
