"""Phrase collocation mining: best-first branch-and-bound growth of phrases from their prefixes.

A phrase of 2 to ``LONGEST`` words that occurs a >= ``LEAST`` times scores floor(1000 * a * n / (l * r))
at its worst cut, l and r the counts of the two parts, n all words of its language. The rest r of a
cut occurs at least as often as the phrase, so no phrase that grows from a prefix scores more than
floor(1000 * n / f(first word)), f being the prefix count at the first cut: an admissible bound. The
frontier is the list of first words by this bound, best first. It is expanded in waves (each with
about twice the occurrences of the one before); a wave grows its phrases word by word, keeping only
prefixes that are frequent themselves. After each wave the candidates are scored exactly and the
dropped ones taken out; a language is settled once the bound of its next first word is below
its ``TOP``-th surviving score, so that ties are all in. Settled languages leave the frontier:
the phrases of their common first words, the bulk of all occurrences, are never counted.

Work on text: one pass counts words; one writes *blocks* (the frequent words of some megabytes of text
as numbers into the block's own vocabulary, gaps at piece ends and at rare words); each step of
growth then reads blocks. Counts are exact grouped sums over (language, phrase), added up inside each
block first, so a very common word is a few rows per block and nothing depends on one task. What
tasks know of the frequent words and prefixes is a bit map over their hashes, at most ``MOST_BITS``
bits: a wrong hit costs a row that the exact count then drops, never a result.

Rows: a null text is empty, a null lang is ``und``; doc_id is not read, so rows that repeat or lack one
count like any other. Empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cofi.llm.common import map_batches, pieces
from cofi.session import materialize

LEAST = 100
LONGEST = 5
TOP = 2000
WAVES = 4               # shares of a language's occurrences per wave: 1/8, 1/8, 1/4, 1/2
BITS_PER_ENTRY = 16
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 30  # of a bit map: 4 KB to 128 MB
MAP_BITS = 32_768       # bits per row of Spark's bitmap_construct_agg
BATCH_BYTES = 8 << 20   # of a batch that goes to Python; Spark's own limit is 64 MB, held several times over per task

#: What a byte is: 0 part of a word, 1 between words, 2 between pieces.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches to Python hold ``BATCH_BYTES`` and one row at most, in the jobs run inside."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, starts): all words of the texts in order, A-Z lower-cased, and whether a word begins a
    piece. Works on the bytes of all texts at once; no word or piece goes over a text's end."""
    texts = texts.cast(pa.large_string()).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    ends = offsets[1:-1] - offsets[0]
    kind = KIND[data]
    # a separator is put between texts, so that they end words and pieces
    kind = np.insert(kind, ends, 2)
    data = np.insert(LOWER[data], ends, 0x0A)
    inside = np.concatenate([[False], kind == 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    lengths = stops - starts
    breaks = np.concatenate([[0], np.cumsum(kind == 2)])
    before = np.concatenate([[-1], breaks[starts[:-1]]]) if len(starts) else np.zeros(0)
    new = before != breaks[starts]
    flat = data[kind == 0]
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.tobytes())])
    return words, new


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """(lang, texts) of a batch of (lang, text), in parts of some megabytes."""
    for part in pieces(batch):
        langs = part.column(0)
        for lang in pc.unique(langs):
            yield lang.as_py(), part.column(1).filter(pc.equal(langs, lang))


def hashes(lang: str, words: list) -> np.ndarray:
    """64-bit hashes of words within their language."""
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def chain(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of its prefix and its last word."""
    x = (prefix * np.uint64(0x9E3779B97F4A7C15)) ^ (word + np.uint64(0x7F4A7C15))
    return x ^ (x >> np.uint64(29))


class BitMap:
    """A set of phrases and their first words as bits over hashes, sent to every task; may say yes
    wrongly, never no."""

    def __init__(self, spark, n_bits: int, data: bytes):
        self.n_bits, self.shared = n_bits, spark.sparkContext.broadcast(data)

    def __getstate__(self):
        return {"n_bits": self.n_bits, "shared": self.shared}

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h % np.uint64(self.n_bits)
        data = np.frombuffer(self.shared.value, np.uint8)
        return (data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bit_map(grams: DataFrame) -> BitMap | None:
    """Of (lang, phrase), None if there are none: its size follows the number of phrases up to
    ``MOST_BITS``. Bits are set by an aggregate of fixed-size rows; only these reach the driver."""
    spark = grams.sparkSession
    n_bits = LEAST_BITS
    count = grams.count()
    if not count:
        return None
    while n_bits < MOST_BITS and n_bits < BITS_PER_ENTRY * count:
        n_bits *= 2

    def places(batch: pa.RecordBatch) -> Iterator[dict]:
        out = []
        for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            h = hashes(lang, phrase.encode().split(b" "))
            x = h[:1]
            for w in h[1:]:
                x = chain(x, np.array([w]))
            out += [int(x[0] % np.uint64(n_bits)), int(h[0] % np.uint64(n_bits))]
        yield {"at": pa.array(out, pa.int64())}

    at = map_batches(grams.select("lang", "phrase"), places, "at BIGINT")
    rows = at.groupBy(F.expr(f"at div {MAP_BITS}").alias("part")).agg(
        F.bitmap_construct_agg(F.expr(f"at % {MAP_BITS}")).alias("bits"))
    data = bytearray(n_bits // 8)
    for row in rows.collect():  # at most MOST_BITS / MAP_BITS rows of 4 KB
        data[row["part"] * (MAP_BITS // 8):(row["part"] + 1) * (MAP_BITS // 8)] = row["bits"]
    return BitMap(spark, n_bits, bytes(data))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, n): how often each word occurs, written."""

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        for lang, texts in by_language(batch):
            words, _ = words_of(texts)
            if len(words):
                found = pc.value_counts(words)
                yield {"lang": [lang] * len(found), "phrase": found.field(0).cast(pa.large_string()).cast(pa.string()),
                       "n": found.field(1)}

    return materialize(map_batches(docs, count, "lang STRING, phrase STRING, n BIGINT")
                       .groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words")


def blocks_of(docs: DataFrame, frequent: BitMap) -> DataFrame:
    """(lang, vocabulary BINARY, hashes BINARY, numbers BINARY): the texts, written; 32-bit numbers
    into the vocabulary, -1 for a piece's end or a rare word. Vocabulary (words joined by spaces) and numbers are
    packed here, so that Spark holds and copies less; its own codec, which keeps buffers of a whole page's size
    (a hundred rows at least) off the heap, is left out."""

    def encode(batch: pa.RecordBatch) -> Iterator[dict]:
        for lang, texts in by_language(batch):
            words, new = words_of(texts)
            if not len(words):
                continue
            coded = words.dictionary_encode()
            h = hashes(lang, coded.dictionary.to_pylist())
            good = frequent.has(h)
            to = np.where(good, np.cumsum(good) - 1, -1).astype(np.int32)
            numbers = to[np.asarray(coded.indices)]
            # a gap before each piece; runs of gaps become one
            numbers = np.insert(numbers, np.flatnonzero(new), -1)
            keep = (numbers >= 0) | np.concatenate([[True], numbers[:-1] >= 0])
            yield {"lang": [lang], "vocabulary": [zstandard.compress(b" ".join(coded.dictionary.filter(pa.array(good)).to_pylist()), 1)],
                   "hashes": [h[good].astype("<u8").tobytes()], "numbers": [zstandard.compress(numbers[keep].astype("<i4").tobytes(), 1)]}

    return materialize(map_batches(docs, encode, "lang STRING, vocabulary BINARY, hashes BINARY, numbers BINARY"), "blocks", "uncompressed")


class Block:
    """One block's words: their numbers, hashes and the phrases that begin at each place."""

    def __init__(self, lang: str, vocabulary: pa.Array, hashed: bytes, numbers: bytes):
        self.lang, self.vocabulary = lang, vocabulary
        self.at = np.concatenate([np.frombuffer(numbers, "<i4"), np.full(LONGEST, -1, np.int32)])
        self.hash = np.frombuffer(hashed, "<u8")

    def starts(self, wanted: BitMap) -> np.ndarray:
        """The places of first words of ``wanted``: looked up once per word of the vocabulary."""
        return np.flatnonzero(np.concatenate([wanted.has(self.hash), [False]])[self.at])

    def phrases(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The places among ``starts`` from which ``length`` words follow without a gap, and the hashes
        of these phrases."""
        for i in range(1, length):
            starts = starts[self.at[starts + i] >= 0]
        out = self.hash[self.at[starts]]
        for i in range(1, length):
            out = chain(out, self.hash[self.at[starts + i]])
        return starts, out

    def numbered(self, length: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, group): one place of each different phrase, and each place's phrase. Exact: phrases are
        told apart by their words' numbers, pair by pair."""
        group, first = self.at[starts].astype(np.int64), np.zeros(0, np.int64)
        for i in range(1, length):
            _, first, group = np.unique(group * len(self.vocabulary) + self.at[starts + i], return_index=True, return_inverse=True)
        return starts[first], group

    def text(self, length: int, first: np.ndarray) -> pa.Array:
        parts = [self.vocabulary.take(pa.array(self.at[first + i])) for i in range(length)]
        return pc.binary_join_element_wise(*parts, b" ").cast(pa.string())


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    for i in range(batch.num_rows):
        lang, vocabulary, hashed, numbers = (batch.column(c)[i].as_py() for c in range(4))
        words = zstandard.decompress(vocabulary)
        words = pa.array(words.split(b" ") if words else [], pa.binary())
        yield Block(lang, words, hashed, zstandard.decompress(numbers))


def grown(blocks: DataFrame, length: int, prefix: DataFrame, prefixes: BitMap, least: int) -> DataFrame:
    """(lang, phrase, a): phrases of ``length`` frequent words whose first ``length`` - 1 words are in
    ``prefix`` (``prefixes`` as bits), that occur ``least`` times or more; written."""

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        for b in _blocks(batch):
            starts, h = b.phrases(b.starts(prefixes), length - 1)
            starts, _ = b.phrases(starts[prefixes.has(h)], length)
            if len(starts):
                first, group = b.numbered(length, starts)
                yield {"lang": [b.lang] * len(first), "phrase": b.text(length, first), "a": np.bincount(group, minlength=len(first))}

    frequent = (map_batches(blocks, count, "lang STRING, phrase STRING, a BIGINT")
                .groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least))
    # phrases that only a wrong hit let in belong to another wave
    mine = prefix.select("lang", F.col("phrase").alias("head"))
    return materialize(frequent.withColumn("head", _part(True, F.lit(length - 1))).join(mine, ["lang", "head"], "left_semi")
                       .select("lang", "phrase", "a"), f"phrases{length}")


def counted(blocks: DataFrame, asked: DataFrame) -> DataFrame | None:
    """(lang, phrase, n): counts of the asked phrases (lang, phrase) of two words or more, written; None if
    there are none."""
    wanted = bit_map(asked)
    if wanted is None:
        return None
    lengths = range(2, LONGEST)  # of a tail that is not one word

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        for b in _blocks(batch):
            begin = b.starts(wanted)
            for length in lengths:
                starts, h = b.phrases(begin, length)
                starts = starts[wanted.has(h)]
                if len(starts):
                    first, group = b.numbered(length, starts)
                    yield {"lang": [b.lang] * len(first), "phrase": b.text(length, first),
                           "n": np.bincount(group, minlength=len(first))}

    return materialize(map_batches(blocks, count, "lang STRING, phrase STRING, n BIGINT")
                       .groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
                       .join(asked.select("lang", "phrase"), ["lang", "phrase"], "left_semi"), "counted")


def extended(blocks: DataFrame, asked: DataFrame) -> DataFrame | None:
    """(lang, phrase): the asked phrases (lang, phrase) before or after which always the same
    word stands, so that a phrase one word longer occurs as often. Per phrase only the least and largest
    neighbour are kept; a gap counts as the empty word, which stands for none. None if
    no phrase is asked."""
    wanted = bit_map(asked)
    if wanted is None:
        return None
    lengths = range(2, LONGEST)  # longer candidates have at most LONGEST words

    def look(batch: pa.RecordBatch) -> Iterator[dict]:
        for b in _blocks(batch):
            begin = b.starts(wanted)
            words = np.array([*b.vocabulary.to_pylist(), b""], dtype=object)
            order = np.argsort(words, kind="stable")
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))  # of a word among the sorted; the empty word is number -1, the least
            for length in lengths:
                starts, h = b.phrases(begin, length)
                starts = starts[wanted.has(h)]
                if not len(starts):
                    continue
                first, group = b.numbered(length, starts)
                sides = {}
                for side, at in (("left", starts - 1), ("right", starts + length)):
                    seen = place[np.where(at >= 0, b.at[at], -1)]
                    for name, start, keep in (("least", len(words), np.minimum), ("most", -1, np.maximum)):
                        best = np.full(len(first), start)
                        keep.at(best, group, seen)
                        sides[f"{name}_{side}"] = pa.array(words[order[best]], pa.binary())
                yield {"lang": [b.lang] * len(first), "phrase": b.text(length, first)} | sides

    seen = map_batches(blocks, look, "lang STRING, phrase STRING, least_left BINARY, most_left BINARY, least_right BINARY, most_right BINARY")
    same = lambda s: (F.min(f"least_{s}") == F.max(f"most_{s}")) & (F.max(f"most_{s}") != F.lit(b""))
    return (seen.groupBy("lang", "phrase").agg((same("left") | same("right")).alias("same")).where("same")
            .join(asked.select("lang", "phrase"), ["lang", "phrase"], "left_semi").select("lang", "phrase"))


def n_words(phrase) -> F.Column:
    return F.size(F.split(phrase, " "))


def _part(first: bool, at) -> F.Column:
    words = F.split("phrase", " ")
    return F.array_join(F.slice(words, 1, at) if first else F.slice(words, at + 1, F.size(words)), " ")


def scored(candidates: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) at each candidate's lowest-scoring cut. ``counts`` (lang, phrase, n)
    holds all their parts. The quotient is taken in 38-digit decimals, so it is exact."""
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), n_words("phrase") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(True, F.col("k")).alias("head"), _part(False, F.col("k")).alias("tail"))
    side = lambda name, c: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(c))
    cuts = cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"]).join(totals, "lang")
    score = F.expr("(cast(1000 * a AS DECIMAL(20, 0)) * cast(n AS DECIMAL(18, 0))) div "
                   "(cast(l AS DECIMAL(19, 0)) * cast(r AS DECIMAL(18, 0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x"))
    return best.select("lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")


def frontier(words: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, n, bound, wave): the frequent words as first words, rarest (best bound) first; words of one
    count are in one wave. A wave ends at 1/8, 1/4, ... of the language's occurrences."""
    per_count = words.groupBy("lang", "n").agg(F.sum("n").alias("mass"))  # one row per different count
    order = Window.partitionBy("lang").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.sum("mass").over(order) / F.col("total")
    wave = F.least(F.greatest(F.ceil(F.log2(share)) + WAVES - 1, F.lit(0)), F.lit(WAVES - 1)).cast("int")
    dealt = (per_count.join(totals.withColumnRenamed("n", "total"), "lang").withColumn("wave", wave)
             .select("lang", "n", "wave", F.expr("(1000 * total) div n").alias("bound")))
    return words.join(dealt, ["lang", "n"])


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` surviving phrases of each language, of those
    that occur ``least`` times or more."""
    with small_batches(documents.sparkSession):  # every job with Python runs in here
        return _collocations(documents, least, top)


def _collocations(documents: DataFrame, least: int, top: int) -> DataFrame:
    docs = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                            F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    words = word_counts(docs)
    totals = materialize(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    first = materialize(frontier(words.where(F.col("n") >= least), totals), "frontier")
    frequent = bit_map(first)
    if frequent is None:
        return documents.sparkSession.createDataFrame(
            [], "lang STRING, rank BIGINT, phrase STRING, a BIGINT, l BIGINT, r BIGINT, n BIGINT, score BIGINT")
    blocks = blocks_of(docs, frequent)
    open_langs = first.select("lang").distinct()
    survivors: list[DataFrame] = []
    for wave in range(WAVES):
        prefix = first.where(F.col("wave") == wave).join(open_langs, "lang", "left_semi")
        prefixes = bit_map(prefix)
        if prefixes is None:
            continue
        texts = blocks.join(open_langs, "lang", "left_semi")
        found = None
        for length in range(2, LONGEST + 1):
            prefix = grown(texts, length, prefix, prefixes, least).withColumn("words", F.lit(length))
            found = prefix if found is None else found.unionAll(prefix)
            prefixes = bit_map(prefix)
            if prefixes is None:
                break
        survivors.append(_survivors(texts, found, first, totals))
        if wave + 1 < WAVES:
            ahead = first.where(F.col("wave") > wave).groupBy("lang").agg(F.max("bound").alias("bound"))
            last = _best(survivors, top).where(F.col("rank") == top).select("lang", "score")
            open_langs = materialize(open_langs.join(ahead, "lang").join(last, "lang", "left")
                                     .where("score IS NULL OR bound >= score").select("lang"), "open_languages")
    return _best(survivors, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _survivors(texts: DataFrame, found: DataFrame, first: DataFrame, totals: DataFrame) -> DataFrame:
    """The scored candidates of one wave, without the dropped ones; written. Heads of a candidate are
    candidates of its wave (or first words); its tails may begin with a word of any wave."""
    known = first.select("lang", "phrase", "n").unionAll(found.select("lang", "phrase", "a"))
    tails = materialize(found.where("words > 2").select(
        "lang", F.explode(F.transform(F.sequence(F.lit(1), F.col("words") - 2), lambda k: _part(False, k))).alias("phrase"))
        .distinct().join(found, ["lang", "phrase"], "left_anti"), "tails")
    counts = counted(texts, tails)
    if counts is not None:
        known = known.unionAll(counts)
    gone = extended(texts, found.where(F.col("words") < LONGEST))
    out = scored(found, known, totals)
    return materialize(out if gone is None else out.join(gone, ["lang", "phrase"], "left_anti"), "survivors")


def _best(survivors: list[DataFrame], top: int) -> DataFrame:
    x = survivors[0]
    for s in survivors[1:]:
        x = x.unionAll(s)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return x.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)


def oracle_sql() -> str:
    grams = "\n  UNION ALL ".join(
        f"SELECT lang, {m} AS words, concat_ws(' ', {', '.join(f'w{i}' for i in range(1, m + 1))}) AS phrase FROM placed WHERE w{m} IS NOT NULL"
        for m in range(1, LONGEST + 1))
    leads = ", ".join(f"lead(word, {i}) OVER piece AS w{i + 1}" for i in range(1, LONGEST))
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT doc, lang, unnest(p) AS piece, generate_subscripts(p, 1) AS part
           FROM (SELECT doc, lang, regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]') AS p FROM texts)),
split AS (SELECT doc, lang, part, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
words AS (SELECT doc, lang, part, unnest(ws) AS word, generate_subscripts(ws, 1) AS place FROM split),
placed AS (SELECT lang, word AS w1, {leads} FROM words WINDOW piece AS (PARTITION BY doc, part ORDER BY place)),
grams AS (
  {grams}),
f AS (SELECT lang, phrase, words, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
totals AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
parts AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE words > 1),
cuts AS (SELECT lang, phrase, f AS a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
         FROM (SELECT *, unnest(range(1, words)) AS k FROM parts)),
scores AS (
  SELECT c.lang, c.phrase, c.a, c.k, h.f AS l, t.f AS r, n, (1000::HUGEINT * c.a * n) // (h.f::HUGEINT * t.f) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail
  JOIN totals ON totals.lang = c.lang),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM scores) WHERE cut = 1),
longer AS (
  SELECT lang, f, array_to_string(ws[1:words - 1], ' ') AS phrase FROM parts UNION ALL
  SELECT lang, f, array_to_string(ws[2:], ' ') FROM parts),
left_over AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (SELECT 1 FROM longer g WHERE g.lang = s.lang AND g.phrase = s.phrase AND 100 * g.f >= 100 * s.a))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM left_over)
WHERE rank <= {TOP}"""
