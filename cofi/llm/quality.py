"""Quality rules with adaptive thresholds (operator 7).

Each document's measures are compared with fences that its own language and source set: the quartiles
of the measure there, widened by ``FENCE`` times the group's spread. The spread is the distance of the
quartiles, or what one event (a symbol, a capital, a repeated window) makes in the group's median
document where that is more, so a source of short texts allows larger shares than one of long texts.
No fence holds a hand-set value of a measure. The quantiles come from mergeable sketches: logarithmic
bins (values of a bin differ by less than 2 x ALPHA of their size) with exact counts, so sketches merge
by adding counts, in any order, with one result, and building them is one grouped count with partial
sums before the shuffle. A small group leans on its parent: its quantiles are averaged with those of
its language, which count as ``WEIGHT`` documents, and the language's in the same way with those of all.
The documents are then joined with the thresholds of their group.

Defined cases: a null text has no words and fails the base rule; null language or source
is a group like any other; a value at its fence is kept; repeated rows are judged each; an empty table
gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cofi.llm.common import map_batches, pieces, text_rows
from cofi.session import materialize

ASCII = re.compile("[\x00-\x7f]+")
SYMBOLS = "#*$%&|<>"
ALPHA = 0.01                        # relative error of a sketch's quantile
LEAST = 1e-6                        # values below count as zero
WEIGHT = 50.0                       # documents that a parent's quantiles count for
FENCE = 4.0                         # spreads a measure may lie outside its quartiles
QUARTILES = (0.25, 0.5, 0.75)
#: measure: (what a document's size is, the units of one event in it, whether small values are judged too);
#: a repeated window covers twice its 8 words
MEASURES = {"word_length": ("n_words", 1, True), "symbol_share": ("n_words", 1, False),
            "repeat_share": ("n_words", 16, False), "upper_share": ("word_chars", 1, False)}
SIZES = ("n_words", "word_chars")

STATS = ("n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, "
         "n_repeat_words BIGINT, n_lines BIGINT, n_upper BIGINT")


def repeated_window_words(words: list[bytes], hashes: np.ndarray, size: int = 8) -> int:
    """Words covered by windows of ``size`` words that occur twice or more in ``words``."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    x = np.zeros(n, np.uint64)
    for j in range(size):
        x = (x ^ hashes[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    order = np.argsort(x, kind="stable")
    same = x[order][1:] == x[order][:-1]
    if not same.any():
        return 0  # equal windows have equal hashes
    maybe = np.zeros(n, bool)
    maybe[order[1:][same]] = True
    maybe[order[:-1][same]] = True
    at = np.flatnonzero(maybe).tolist()
    windows = [tuple(words[i:i + size]) for i in at]
    found = Counter(windows)
    cover = np.zeros(len(words) + 1, np.int64)
    for i, w in zip(at, windows):
        if found[w] > 1:
            cover[i] += 1
            cover[i + size] -= 1
    return int((np.cumsum(cover[:-1]) > 0).sum())


def duplicate_lines(text: bytes) -> tuple[int, int]:
    """(lines with a word, those equal to an earlier one)."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def text_stats(text: str | None) -> tuple[int, ...]:
    """The values of STATS for one text."""
    text = text or ""
    raw = text.encode("utf-8")
    words = raw.split()
    code = np.frombuffer(raw, np.uint8)
    blanks = np.bincount(code, minlength=256) if len(code) else np.zeros(256, np.int64)
    chars = len(text) - int(blanks[[0x20, 9, 10, 11, 12, 13]].sum())
    symbols = int(blanks[list(map(ord, SYMBOLS))].sum())
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    lines, dup = duplicate_lines(raw)
    upper = int(blanks[ord("A"):ord("Z") + 1].sum()) + sum(map(str.isupper, ASCII.sub("", text)))
    return len(words), chars, symbols, dup, repeated_window_words(words, hashes), lines, upper


def measure(docs: DataFrame, *keys: str) -> DataFrame:
    """(doc_id, keys..., STATS..., base_failed) per row of ``docs``, texts read whole; a key ``row``
    holds the whole row."""
    x = text_rows(docs, *keys)
    names = [c.split()[0] for c in STATS.split(", ")]

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in pieces(batch):
            rows = [text_stats(t) for t in part.column(1).to_pylist()]
            cols = dict(zip(names, zip(*rows))) if rows else dict.fromkeys(names, ())
            yield {n: part.column(i) for i, n in enumerate(part.schema.names) if n != "text"} | cols

    kinds = "".join(f", {k} {x.schema[k].dataType.simpleString()}" for k in keys)
    out = map_batches(x, run, f"doc_id BIGINT{kinds}, {STATS}")
    return out.withColumn("base_failed", (F.col("n_words") < 20)
                          | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def shares() -> dict[str, Column]:
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return {"word_length": per("word_chars", "n_words"), "symbol_share": per("n_symbols", "n_words"),
            "repeat_share": per("n_repeat_words", "n_words"), "upper_share": per("n_upper", "word_chars")}


def sketch(stats: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): the sketch of every group, one count per bin. Bin -1
    holds zeros; bin b > -1 holds values up to LEAST * g^b, g = (1 + ALPHA) / (1 - ALPHA)."""
    step = float(np.log((1 + ALPHA) / (1 - ALPHA)))
    own = shares() | {c: F.col(c).cast("double") for c in SIZES}
    long = stats.select("lang", "source", F.explode(F.array(
        *[F.struct(F.lit(m).alias("measure"), own[m].alias("value")) for m in own])).alias("x"))
    bin_no = F.when(F.col("x.value") <= LEAST, F.lit(-1)).otherwise(
        F.ceil(F.log(F.col("x.value") / LEAST) / step).cast("int"))
    return (long.select("lang", "source", "x.measure", bin_no.alias("bin"))
            .groupBy("lang", "source", "measure", "bin").agg(F.count(F.lit(1)).alias("n")))


def quantiles(bins: DataFrame, keys: list[str], at: tuple[float, ...]) -> DataFrame:
    """(keys..., measure, total, q0, q1, ...): merges sketches by ``keys`` and reads them.
    A window runs over the bins of one sketch, some thousand rows at most."""
    step = float(np.log((1 + ALPHA) / (1 - ALPHA)))
    merged = bins.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "measure").orderBy("bin")
    run = merged.withColumn("upto", F.sum("n").over(w)).withColumn(
        "total", F.sum("n").over(Window.partitionBy(*keys, "measure")))
    value = F.when(F.col("bin") < 0, F.lit(0.0)).otherwise(
        F.lit(LEAST) * F.exp((F.col("bin") - 0.5) * step))
    return run.groupBy(*keys, "measure", "total").agg(
        *[F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), value)).alias(f"q{i}")
          for i, q in enumerate(at)])


def thresholds(stats: DataFrame, weight: float = WEIGHT, fence: float = FENCE) -> DataFrame:
    """(lang, source, <measure>_low, <measure>_high...): one row per group of ``stats``."""
    bins = materialize(sketch(stats), "quality-sketch")
    own = quantiles(bins, ["lang", "source"], QUARTILES).toDF("lang", "source", "measure", "t0", "a0", "m0", "b0")
    lang = quantiles(bins, ["lang"], QUARTILES).toDF("lang1", "measure1", "t1", "a1", "m1", "b1")
    every = quantiles(bins, [], QUARTILES).toDF("measure2", "t2", "a2", "m2", "b2")
    x = (own.join(lang, F.col("lang").eqNullSafe(F.col("lang1")) & (F.col("measure") == F.col("measure1")))
         .join(every, F.col("measure") == F.col("measure2")))
    lean = lambda n, value, parent: (F.col(n) * F.col(value) + weight * parent) / (F.col(n) + weight)
    x = x.select("lang", "source", "measure", *[
        lean("t0", f"{c}0", lean("t1", f"{c}1", F.col(f"{c}2"))).alias(c) for c in "amb"])
    wide = x.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{m}_{c}") for m in (*MEASURES, *SIZES) for c in "amb"])
    out = []
    for m, (size, units, _) in MEASURES.items():
        a, b = F.col(f"{m}_a"), F.col(f"{m}_b")
        spread = F.greatest(b - a, units / F.greatest(F.col(f"{size}_m"), F.lit(1.0)))
        out += [(a - fence * spread).alias(f"{m}_low"), (b + fence * spread).alias(f"{m}_high")]
    return wide.select("lang", "source", *out)


def judge(docs: DataFrame, weight: float = WEIGHT, fence: float = FENCE) -> DataFrame:
    """(doc_id, lang, source, STATS..., base_failed, kept) per row of ``docs``."""
    stats = materialize(measure(docs, "lang", "source"), "quality-stats")
    return decide(stats, thresholds(stats, weight, fence))


def decide(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """``stats`` with ``kept``: joined with the thresholds of its group, a table of a row per language
    and source."""
    limits = limits.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    own = shares()
    inside = F.lit(True)
    for m, (_, _, low_too) in MEASURES.items():
        inside &= own[m] <= F.col(f"{m}_high")
        if low_too:
            inside &= own[m] >= F.col(f"{m}_low")
    joined = stats.join(limits, F.col("lang").eqNullSafe(F.col("of_lang"))
                        & F.col("source").eqNullSafe(F.col("of_source")), "left")
    return joined.select(*stats.columns, (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass. The texts are measured a second time beside their rows, which
    costs less than shuffling all texts to join them with a verdict by doc_id."""
    stats = materialize(measure(docs, "lang", "source"), "quality-stats")
    limits = materialize(thresholds(stats), "quality-thresholds")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row", *[F.col("row").getField(c).alias(c) for c in ("doc_id", "text", "lang", "source")])
    return decide(measure(rows, "row", "lang", "source"), limits).where("kept").select("row.*")
