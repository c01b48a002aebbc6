"""Mixing sources to target weights (operator 1), DataFrame functions only.

The leaves of a tree (domain, language, source) hold tokens, and may be read ``max_epochs``
times. A budget of tokens goes down the tree: a node's budget is dealt to its children in
proportion to their weights; a child that can't use its share (its subtree has fewer
tokens) keeps what it can, and the shortage goes to its siblings, again by weight. Only
where a whole subtree is exhausted does its shortage reach the siblings of an ancestor,
since a node never gets more than its subtree holds. Per set of siblings the common level
``L`` (tokens per unit of weight) is exact: with children in order of capacity / weight,
L = max over i of (budget - capacity of those before i) / (weight of i and those after).

A leaf's stream is epoch after epoch, each in an order of its own: by MD5 of seed, epoch
and doc_id. The leaf takes the prefix of its budget: whole epochs, then one partial epoch
that ends inside a document. That place is found by counting tokens per range of the order
(4096 ranges, then 4096 ranges of the one where the budget ends), so only the rows of one
small range are ever sorted, however large the leaf. Each row then compares its key with
its leaf's place: texts are not shuffled.

Defined cases: a null or empty text has no tokens and is taken with every whole epoch;
null or unknown domains, languages and sources are nodes of their own (weight ``OTHER``
unless given); equal keys are ordered by doc_id and tokens, rows that are equal in these too
are taken together at the place where the budget ends; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cofi.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
OTHER = 1             # weight of a node that the weights don't name
RANGE_DIGITS = 3      # hexadecimal digits of the order's key that name a range
LEVELS = ("domain", "lang", "source")

#: Production weights, whole numbers; a level that isn't named has equal weights.
WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 60, "de": 15, "fr": 15, "es": 10}}
BUDGET = (3, 5)       # share of all tokens, as a fraction
MAX_EPOCHS = 2
SEED = 20


def domain_of(source: Column) -> Column:
    """The domain a source belongs to: by its number, else ``other``."""
    n = F.regexp_extract(source, "([0-9]+)$", 1).try_cast("int") % 3
    return F.when(n == 0, "web").when(n == 1, "books").when(n == 2, "code").otherwise("other")


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    named = weights.get(level, {})
    return reduce(lambda c, kv: c.when(F.col(level) == kv[0], F.lit(kv[1])), named.items(),
                  F.when(F.lit(False), F.lit(0))).otherwise(F.lit(OTHER)).cast("bigint")


def budgets(leaves: DataFrame, budget: tuple[int, int], weights: dict[str, dict[str, int]],
            max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, budget) from the leaves' (domain, lang, source, tokens):
    whole tokens, rounded down at each node."""
    now = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    everything = Window.partitionBy(F.lit(0))  # rows are leaves here, a few per source
    now = now.withColumn("budget", F.floor(F.sum("tokens").over(everything) * budget[0] / budget[1]).cast("bigint"))
    for depth, level in enumerate(LEVELS):
        parent, path = list(LEVELS[:depth]), list(LEVELS[:depth + 1])
        nodes = now.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.min("budget").alias("budget"))
        nodes = nodes.withColumn("weight", _weight(level, weights)).where("weight > 0")
        sibling = Window.partitionBy(*(parent or [F.lit(0)]))
        order = sibling.orderBy(F.col("capacity") / F.col("weight"), F.col(level))
        used = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        nodes = (nodes.withColumn("level", (F.col("budget") - used) / rest)
                 .withColumn("level", F.max("level").over(sibling))
                 .withColumn("share", F.least(F.col("capacity"), F.floor(F.col("weight") * F.col("level")).cast("bigint")))
                 .select(*[F.col(c).alias(f"_{c}") for c in path], F.greatest("share", F.lit(0)).alias("share")))
        same = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"_{c}")), path[1:], F.col(path[0]).eqNullSafe(F.col(f"_{path[0]}")))
        now = now.join(nodes, same).select(*LEVELS, "tokens", "capacity", F.col("share").alias("budget"))
    return now.select(*LEVELS, "tokens", "budget")


def _key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string")))


def _same_leaf(a: str, b: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in LEVELS])


def plan(tokens: DataFrame, budget: tuple[int, int] = BUDGET, weights: dict[str, dict[str, int]] = WEIGHTS,
         max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per leaf that gets tokens: (domain, lang, source, epochs, rest, end_key, end_id,
    end_tokens, before): whole epochs, the tokens of the partial epoch, its last row and the
    tokens before that row. ``tokens``: (doc_id, domain, lang, source, tokens)."""
    leaves = materialize(tokens.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    dealt = budgets(leaves, budget, weights, max_epochs).where("tokens > 0 AND budget > 0")
    dealt = materialize(dealt.select(*LEVELS, F.expr("budget div tokens").alias("epochs"),
                                     (F.col("budget") % F.col("tokens")).alias("rest")), "mix-budgets")
    rows = tokens.alias("t").join(dealt.where("rest > 0").alias("d"), _same_leaf("t", "d")).select(
        *[f"t.{c}" for c in LEVELS], "t.doc_id", "t.tokens", F.col("d.rest").alias("left"),
        _key(seed, F.col("d.epochs"), F.col("t.doc_id")).alias("key")).withColumn("before", F.lit(0).cast("bigint"))
    for depth in range(2):  # the range where the budget ends, then the range of that range
        part = F.substring("key", 1 + depth * RANGE_DIGITS, RANGE_DIGITS)
        sums = rows.groupBy(*LEVELS, part.alias("part"), "before").agg(F.sum("tokens").alias("n"), F.max("left").alias("left"))
        run = Window.partitionBy(*LEVELS).orderBy("part")
        sums = sums.withColumn("upto", F.sum("n").over(run)).where("upto >= left AND upto - n < left")
        ends = materialize(sums.select(*LEVELS, "part", (F.col("left") - F.col("upto") + F.col("n")).alias("left"),
                                       (F.col("before") + F.col("upto") - F.col("n")).alias("before")), "mix-ranges")
        rows = rows.alias("t").join(ends.alias("d"), _same_leaf("t", "d") & (F.col("part") == F.substring(
            "t.key", 1 + depth * RANGE_DIGITS, RANGE_DIGITS))).select(
            *[f"t.{c}" for c in LEVELS], "t.doc_id", "t.tokens", "t.key", "d.left", "d.before")
    run = Window.partitionBy(*LEVELS).orderBy("key", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    last = rows.withColumn("upto", F.sum("tokens").over(run)).where(
        "upto >= left AND upto - tokens < left").select(
        *LEVELS, "key", "doc_id", "tokens", (F.col("before") + F.col("upto") - F.col("tokens")).alias("before"))
    return dealt.alias("t").join(last.alias("d"), _same_leaf("t", "d"), "left").select(
        *[f"t.{c}" for c in LEVELS], "t.epochs", "t.rest", F.col("d.key").alias("end_key"),
        F.col("d.doc_id").alias("end_id"), F.col("d.tokens").alias("end_tokens"), "d.before")


def _decided(rows: DataFrame, of: DataFrame, seed: int) -> DataFrame:
    """``rows`` (its own columns in ``row``; doc_id, domain, lang, source, tokens) once per
    epoch that takes it: (row, ..., epoch, n_taken)."""
    x = rows.alias("t").join(of.alias("d"), _same_leaf("t", "d")).select(
        "t.*", "d.epochs", "d.rest", "d.end_key", "d.end_id", "d.end_tokens", "d.before",
        _key(seed, F.col("d.epochs"), F.col("t.doc_id")).alias("key"))
    place = lambda k, i, n: F.struct(F.col(k).alias("k"), F.col(i).alias("i"), F.col(n).alias("n"))
    mine, end = place("key", "doc_id", "tokens"), place("end_key", "end_id", "end_tokens")
    taken = F.when(F.col("end_key").isNull() | (mine > end), None).when(mine < end, F.col("tokens")).otherwise(
        F.col("rest") - F.col("before"))
    x = x.withColumn("part", taken).withColumn("epoch", F.explode(F.when(
        (F.col("epochs") > 0) | F.col("part").isNotNull(), F.sequence(
            F.lit(0).cast("bigint"), F.col("epochs") - F.when(F.col("part").isNull(), 1).otherwise(0)))))
    return x.withColumn("n_taken", F.when(F.col("epoch") < F.col("epochs"), F.col("tokens")).otherwise(F.col("part")))


def _tokens(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), domain_of(F.col("source")).alias("domain"),
                       F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       token_count(F.col("text")).alias("tokens"))


def selection(docs: DataFrame, budget: tuple[int, int] = BUDGET, weights: dict[str, dict[str, int]] = WEIGHTS,
              max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epoch, n_taken): a row per document and epoch taken;
    ``n_taken`` is less than ``n_tokens`` where a leaf's budget ends inside the document."""
    tokens = materialize(_tokens(docs), "mix-tokens")
    of = materialize(plan(tokens, budget, weights, max_epochs, seed), "mix-plan")
    return _decided(tokens, of, seed).select("doc_id", *LEVELS, F.col("tokens").alias("n_tokens"), "epoch", "n_taken")


def mix(docs: DataFrame, budget: tuple[int, int] = BUDGET, weights: dict[str, dict[str, int]] = WEIGHTS,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that the mixture takes, once per epoch, with the columns of ``docs``;
    a document in which a budget ends is kept whole."""
    of = materialize(plan(materialize(_tokens(docs), "mix-tokens"), budget, weights, max_epochs, seed), "mix-plan")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select("row", *[
        c for c in (F.col("row.doc_id").cast("bigint").alias("doc_id"), domain_of(F.col("row.source")).alias("domain"),
                    F.col("row.lang").cast("string").alias("lang"), F.col("row.source").cast("string").alias("source"),
                    token_count(F.col("row.text")).alias("tokens"))])
    return _decided(rows, of, seed).select("row.*")


def oracle_sql(budget: tuple[int, int] = BUDGET, weights: dict[str, dict[str, int]] = WEIGHTS,
               max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """DuckDB SQL of ``selection``: plain windows over all rows of a leaf."""
    def weight(level: str) -> str:
        named = "".join(f" WHEN {level} = '{k}' THEN {v}" for k, v in weights.get(level, {}).items())
        return f"CASE{named} ELSE {OTHER} END" if named else str(OTHER)

    ctes, before = [], "root"
    for depth, level in enumerate(LEVELS):
        path, parent = ", ".join(LEVELS[:depth + 1]), ", ".join(LEVELS[:depth])
        by = f"PARTITION BY {parent}" if parent else ""
        on = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in LEVELS[:depth + 1])
        ctes.append(f"""n{depth} AS (SELECT {path}, sum(capacity) AS capacity, min(budget) AS budget, {weight(level)} AS weight
    FROM {before} GROUP BY {path}),
  l{depth} AS (SELECT *, (budget - coalesce(sum(capacity) OVER ({by} ORDER BY capacity / weight, {level}
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE / (sum(weight) OVER ({by} ORDER BY capacity / weight, {level}
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS lv FROM n{depth}),
  s{depth} AS (SELECT *, greatest(0, least(capacity, floor(weight * max(lv) OVER ({by}))))::BIGINT AS share FROM l{depth}),
  b{depth} AS (SELECT a.domain, a.lang, a.source, a.tokens, a.capacity, b.share AS budget FROM {before} a JOIN s{depth} b ON {on})""")
        before = f"b{depth}"
    same = " AND ".join(f"t.{c} IS NOT DISTINCT FROM p.{c}" for c in LEVELS)
    return f"""
WITH tokens AS (SELECT doc_id, lang, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS tokens,
    CASE TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 3
      WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'code' ELSE 'other' END AS domain FROM documents),
  leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens FROM tokens GROUP BY ALL),
  root AS (SELECT *, tokens * {max_epochs} AS capacity,
    floor((SELECT sum(tokens) FROM leaves) * {budget[0]} / {budget[1]})::BIGINT AS budget FROM leaves),
  {", ".join(ctes)},
  p AS (SELECT *, budget // tokens AS epochs, budget % tokens AS rest FROM {before} WHERE tokens > 0 AND budget > 0),
  x AS (SELECT t.*, p.epochs, p.rest, sum(t.tokens) OVER (PARTITION BY t.domain, t.lang, t.source
      ORDER BY md5(concat_ws('|', '{seed}', p.epochs, t.doc_id)), t.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      - t.tokens AS before FROM tokens t JOIN p ON {same})
SELECT doc_id, domain, lang, source, tokens AS n_tokens, unnest(range(epochs))::BIGINT AS epoch, tokens AS n_taken FROM x
UNION ALL
SELECT doc_id, domain, lang, source, tokens, epochs, least(tokens, rest - before) FROM x WHERE before < rest"""
