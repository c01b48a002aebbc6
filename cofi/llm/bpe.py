"""Byte-level BPE encoding and decoding (operator 8).

The ``tokenizers`` library merges; each worker builds its model once from the rank file.
A text is cut by the public pattern, every match is mapped byte by byte to the library's
printable characters and merged on its own, and the results of equal matches are reused
inside a worker (a memo bounded in bytes, without very long matches, that is emptied when full; it
never changes a result). Texts are
cut between a non-space and a single space before a non-space, where no match can
cross, so a very long text needs memory for one stretch of matches at a time.

Defined cases: a null text is an empty text (no tokens); ids are little-endian unsigned
32-bit integers in one binary column; rows are independent, repeated rows are encoded
twice; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofi.llm.common import map_batches, pieces, text_rows

STRETCH = 1 << 20  # characters after which a long text is cut at the next safe place
MEMO_BYTES = 40 << 20  # what a worker's memo of encoded matches may take
LONGEST = 128      # characters of a match that is remembered


def byte_characters() -> list[str]:
    """The printable character of each byte: Latin-1's printable ones stand for
    themselves, the others follow from U+0100 in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def merge_pairs(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """The two parts each token of the rank file is merged from, in the order of ranks:
    what is left of its bytes after all merges of lower rank."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min((ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best[0] >= rank:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
        elif len(parts) > 2:
            raise ValueError(f"token {token!r} cannot be merged from tokens of lower rank")
    return out


def spelled_out(pattern: str, top: int = sys.maxunicode) -> str:
    """``pattern`` with its Unicode classes written as character ranges up to ``top``, so
    that the standard ``re`` matches what the property names mean. Classes that end at
    U+FFFF are tables there, and twice as fast as the property names."""
    import regex

    every = "".join(map(chr, range(top + 1)))
    for name, cls in ((r"\p{L}", r"\p{L}"), (r"\p{N}", r"\p{N}"), (r"\s", r"\p{White_Space}")):
        ranges = "".join(f"\\U{m.start():08x}-\\U{m.end() - 1:08x}" for m in regex.finditer(f"{cls}+", every))
        if name == r"\s":  # \S stands alone in these patterns, \s alone or inside a class
            pattern = pattern.replace(r"\S", f"[^{ranges}]")
            pattern = re.sub(r"(\[\^?)\\s", lambda m: m[1] + ranges, pattern).replace(r"\s", f"[{ranges}]")
        else:
            part = re.escape(name)
            pattern = re.sub(rf"(\[[^]]*?){part}", lambda m: m[1] + ranges, pattern)
            pattern = re.sub(rf"{part}", lambda m: f"[{ranges}]", pattern)
    return pattern


class Codec:
    """The model of one rank file in a worker."""

    def __init__(self, rank_file: str, pattern: str):
        from tokenizers.models import BPE

        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        chars = byte_characters()
        shown = lambda token: "".join(chars[b] for b in token)
        self.table = dict(enumerate(chars))
        self.model = BPE({shown(t): r for t, r in ranks.items()},
                         [(shown(a), shown(b)) for a, b in merge_pairs(ranks)])
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.tokens[r] = t
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.matches = re.compile(spelled_out(pattern, 0xFFFF)).findall
        self.all_matches = re.compile(spelled_out(pattern)).findall
        self.beyond = re.compile("[\U00010000-\U0010ffff]").search
        self.cut = re.compile(spelled_out(r"(?<=\S) (?=\S)")).search
        self.memo: dict[str, bytes] = {}
        self.used = 0

    def word(self, match: str) -> bytes:
        shown = match.encode("utf-8").decode("latin-1").translate(self.table)
        ids = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
        if len(match) <= LONGEST:
            if self.used >= MEMO_BYTES:
                self.memo.clear()
                self.used = 0
            self.memo[match] = ids
            self.used += sys.getsizeof(match) + sys.getsizeof(ids) + 100  # and the dictionary's slot
        return ids

    def encode(self, text: str) -> np.ndarray:
        out, at = [], 0
        while at < len(text):
            m = self.cut(text, at + STRETCH) if len(text) - at > STRETCH else None
            end = m.start() if m else len(text)
            get, word, stretch = self.memo.get, self.word, text[at:end]
            matches = self.all_matches if self.beyond(stretch) else self.matches
            out += [get(x) or word(x) for x in matches(stretch)]
            at = end
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join([self.tokens[i] for i in ids.tolist()])

    def offsets(self, text: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Characters (start, end) each token touches, and how many tokens start inside
        one. A character split over tokens counts for each of them."""
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
        char = np.cumsum(lead) - 1
        if not len(ids):
            return starts, ends, 0
        return char[starts], char[ends - 1] + 1, int((~lead[starts]).sum())


@lru_cache(maxsize=4)
def codec(rank_file: str, pattern: str) -> Codec:
    return Codec(rank_file, pattern)


def encode(docs: DataFrame, rank_file: str, pattern: str, offsets: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids BINARY, n_inside[, char_start, char_end ARRAY<INT>]) per row of
    ``docs``; ``n_inside`` counts tokens that start inside a character."""
    schema = "doc_id BIGINT, n_tokens BIGINT, ids BINARY, n_inside BIGINT"
    if offsets:
        schema += ", char_start ARRAY<INT>, char_end ARRAY<INT>"

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        c = codec(rank_file, pattern)
        for part in pieces(batch):
            ids, inside, first, last = [], [], [], []
            for text in part.column(1).to_pylist():
                x = c.encode(text or "")
                a, b, n = c.offsets((text or "").encode("utf-8"), x)
                ids.append(x)
                inside.append(n)
                first.append(a)
                last.append(b)
            cols = {"doc_id": part.column(0), "n_tokens": [len(x) for x in ids],
                    "ids": [x.tobytes() for x in ids], "n_inside": inside}
            yield cols | ({"char_start": first, "char_end": last} if offsets else {})

    return map_batches(text_rows(docs), run, schema)


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids, n_inside) with ``decoded`` BINARY, the bytes of
    the ids; characters split over tokens come together again as the bytes are joined."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        c = codec(rank_file, pattern)
        for part in pieces(batch, 2):
            yield {n: part.column(i) for i, n in enumerate(part.schema.names)} | {
                "decoded": [c.decode(np.frombuffer(x or b"", "<u4")) for x in part.column(2).to_pylist()]}

    return map_batches(encoded.select("doc_id", "n_tokens", "ids", "n_inside"), run,
                       "doc_id BIGINT, n_tokens BIGINT, ids BINARY, n_inside BIGINT, decoded BINARY")


def round_trip_digest(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Encode, decode, and the digests of both."""
    x = decode(encode(docs, rank_file, pattern, offsets=False), rank_file, pattern)
    return x.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"), "n_inside")
