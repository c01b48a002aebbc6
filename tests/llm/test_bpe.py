"""Encoding against the rank-file library itself, decoding against the texts."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from cofi.llm import bpe

FILE = P.path("byte_bpe_50k.tiktoken")
PIECES = [" ", "  ", "\n", "\x1c", "\x85", "　", "'s", "'ll", "é", "Ⅷ", "²", "١", "漢字", "😀", "𝒳", "_", "a",
          "<|endoftext|>", "abc", "the", "$$", "\t", "\r", "​", "á", "\0"]


@pytest.fixture(scope="module")
def own():
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    r = random.Random(5)
    out = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 40))) for _ in range(400)]
    return out + ["", "word " * 300_000, "x" * 5000, " " * 3000, "é😀" * 2000]


def test_same_as_the_rank_library(spark, own):
    t = texts()
    df = spark.createDataFrame([(i, x, "z", 1) for i, x in enumerate(t)] + [(len(t), None, None, None)],
                               "doc_id BIGINT, text STRING, ids STRING, n_tokens INT")  # clashing extra columns
    rows = {r.doc_id: r for r in bpe.encode(df, FILE, P.PATTERN).collect()}
    done = {r.doc_id: r for r in bpe.round_trip_digest(df, FILE, P.PATTERN).collect()}
    for i, x in enumerate([*t, ""]):
        ids = own.encode_ordinary(x)
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == ids and rows[i].n_tokens == len(ids)
        assert done[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert done[i].decoded_sha256 == hashlib.sha256(x.encode()).hexdigest()


def test_offsets_cover_the_characters(spark, own):
    t = "né 😀𝒳 漢字x"
    row = bpe.encode(spark.createDataFrame([(1, t)], "doc_id BIGINT, text STRING"), FILE, P.PATTERN).first()
    raw, at, inside = t.encode(), 0, 0
    char_of = [i for i, c in enumerate(t) for _ in c.encode()]
    for token, a, b in zip(own.encode_ordinary(t), row.char_start, row.char_end):
        n = len(own.decode_single_token_bytes(token))
        assert (a, b) == (char_of[at], char_of[at + n - 1] + 1)
        inside += raw[at] & 0xC0 == 0x80
        at += n
    assert at == len(raw) and row.n_inside == inside > 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert bpe.round_trip_digest(df, FILE, P.PATTERN).count() == 0


def test_the_memo_is_bounded_in_bytes(own, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 20_000)
    c = bpe.Codec(FILE, P.PATTERN)
    r = random.Random(2)
    for size in (3, 90, 3000):  # short, remembered, too long to be remembered
        for _ in range(200):
            t = "".join(r.choice("abcdefghé") for _ in range(size))
            assert c.encode(t).tolist() == own.encode_ordinary(t)
            assert c.used <= 20_000 + 1000 and all(len(m) <= bpe.LONGEST for m in c.memo)
