"""All pairs of users as blocks x blocks: no pair crosses a shuffle before it is summed and cut.

Users are dealt into blocks by hash. A block pair (i, j) is one group: it gets the ratings of both blocks whose
item has rows in both, packed, and forms the similarities of its users a slice of rows at a time, so a
group's memory is two blocks of ratings and one slice. What leaves it is what the caller asked for: every pair
(``pair_rows``) or sums over all neighbours who rated a requested item (``sum_rows``). What is shuffled is ratings, each
at most once per block in which its item has rows.

The k best of each user (``best_rows``) are found by one task per block (``_Lists``): it holds its block's ratings and the lists so far,
and the others' ratings stream past, some hundred thousand at a time. The k-th best so far is a bound for what comes later: in dense
data pairs are first formed in single precision, and only those that can reach the bound are formed exactly. A
user's list leaves its task once, not once per block pair.

Ratings travel packed by user: items as differences, values as places among the user's different values.

Dense groups (a product of matrices costs less than the terms one by one) use a matrix product per slice, the others
expand the terms item by item and sum them by a sort. The number of blocks follows the ratings and the
pairs' terms, but blocks keep enough users for lists of k to be cut, and past the number that gives every core some
block pairs only memory (``BLOCK_ROWS``) asks for more: a rating is sent to each block, so what is shuffled is then in
proportion to the ratings. Where nearly every item has rows in nearly every block, bit maps would leave out nothing and
are not made.

``cell`` cuts the users further (bins): only users of one cell meet, a user may be in several.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 6_000_000     # ratings of a block, at most
PAIR_TERMS = 10_000_000    # terms (item, rater, rater) of a block pair, where blocks stay large enough
BLOCK_USERS = 4_096        # users of a block, at least, unless its ratings are too many
FEWEST_USERS = 16          # the same when ``block_rows`` is small
MAX_GROUPS = 4_000         # partitions of block pairs
LIST_ROWS = 12_000_000     # ratings of a block that the others stream past, at most
LIST_EDGES = 10_000_000    # edges of its users' lists; more leave early, if few of the edges are cut anyway
STREAM_ROWS = 400_000      # ratings that stream past at once
CORE_LISTS = 2             # such blocks a core
FEWEST_LISTS = 16          # the same for all cores together, at least
RATING_BYTES = 5           # of a packed copy of a rating, about
MASK_BYTES = 60            # of a rating's way to its item's bit map and back, about
CORE_PAIRS = 3             # block pairs a core
FEWEST_PAIRS = 24          # the same for all cores together, at least
FULL_SHARE = 0.85          # of the copies a rating would have without bit maps: none are made from here on
MASK_BITS = 62
NOISE = 1e-12              # a sum this small against the sum of its terms' sizes is rounding error
KEY_SCALE = 10.0 ** 10     # of the ranking key, as ``knn.RANK_DIGITS``
SLICE_CELLS = 2_000_000    # similarities of a slice
SLICE_TERMS = 4_000_000    # terms of a slice
PACK_ROWS = 100_000        # ratings packed at once
PACK_BYTES = 8 << 20       # of packed ratings handed on at once
STEPS = [2 ** i for i in range(1, 11)]  # numbers of blocks for which copies are counted
DENSE_BYTES = 400 << 20    # of the matrices of a dense group
SETTLE_EDGES = 1_000_000   # edges found before lists are cut again, at least
SPREAD = 256               # tasks that pack ratings, about
PACKED = ("cell BIGINT, bi INT, bj INT, side INT, n INT, n_attrs INT, users BINARY, counts BINARY, items BINARY, vals BINARY, "
          "devs BINARY, attrs BINARY")


@dataclass
class Rule:
    """What makes a similarity, and which pairs count. Attributes of a user are 64-bit words: ``apart`` masks first
    (users who share a bit form no pair), then ``words`` masks for each of ``levels`` (a pair's level is the
    lowest at which they share a bit), or the number of a user's items for ``sets`` (Jaccard)."""
    sets: bool = False
    apart: int = 0
    levels: tuple[int, ...] = ()
    words: int = 0
    least: float = 0.0     # no pair below it
    prefix: bool = False   # pairs of this similarity share an item that both marked by a ``dev`` of 1


def pair_rows(rows: DataFrame, rule: Rule, **how) -> DataFrame:
    """(cell, u, v, sim), u < v, of every pair that counts."""
    return _run(rows, rule, "cell BIGINT, u BIGINT, v BIGINT, sim DOUBLE", _Pairs, {}, **how)


def edge_rows(rows: DataFrame, rule: Rule, **how) -> DataFrame:
    """(cell, u, v, sim) of every pair that counts, in both directions. The edges of a user come one after another, so that
    written columns encode well."""
    return _run(rows, rule, "cell BIGINT, u BIGINT, v BIGINT, sim DOUBLE", _Pairs, {"edges": True}, **how)


def best_rows(rows: DataFrame, rule: Rule, k: int, **how) -> DataFrame:
    """(cell, level, user_id, near, sims, seen): per user and level the k best neighbours as two arrays (the best in one row or
    some), and their number before the cut. What can't be among the k best of any level from its own on is left out, and the
    number may be too small where k neighbours of this or a lower level are not negative, or where negative ones can't
    come among k because over k users share no item: no rank up to k depends on it."""
    return _run(rows, rule, "cell BIGINT, level BIGINT, user_id BIGINT, near ARRAY<BIGINT>, sims ARRAY<DOUBLE>, seen BIGINT", _Lists,
                {"k": k}, k=k * max(1, len(rule.levels)), **how)


def sum_rows(rows: DataFrame, rule: Rule, **how) -> DataFrame:
    """(user_id, item_id, num, den) per block pair with any: sums of sim * dev and |sim| over the neighbours who rated
    a requested item. Requests are rows without ``val``."""
    return _run(rows, rule, "user_id BIGINT, item_id BIGINT, num DOUBLE, den DOUBLE", _Sums, {}, **how)


# ------------------------------------------------------------------------------------------------ Spark

def _run(rows: DataFrame, rule: Rule, schema: str, consumer: type, options: dict, block_rows: int | None = None,
         k: int = 0) -> DataFrame:
    """``rows``: user_id, item_id, val[, dev][, cell][, attrs ARRAY<BIGINT>]. Read three times. ``k``: lists of so many edges
    are kept, a block meets all others in one task."""
    has = set(rows.columns)
    bigint = lambda c: F.col(c).cast("bigint").alias(c)
    base = rows.where("user_id IS NOT NULL AND item_id IS NOT NULL").select(
        (bigint("cell") if "cell" in has else F.lit(0).cast("bigint").alias("cell")), bigint("user_id"), bigint("item_id"),
        F.col("val").cast("double").alias("val"), (F.col("dev") if "dev" in has else F.lit(None)).cast("double").alias("dev"),
        (F.col("attrs") if "attrs" in has else F.array().cast("array<bigint>")).alias("attrs"))
    cells, blocks, masked, raters = _list_shape(base, block_rows, k) if k else (*_shape(base, block_rows, 0), 0)
    blk = F.pmod(F.xxhash64("user_id"), F.lit(blocks)).cast("int")
    dealt = base.withColumn("blk", blk)
    words = range(-(-blocks // MASK_BITS))
    if masked:
        # the blocks in which an item has rows: a rating goes to these only
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("blk") % MASK_BITS).cast("int"))
        held = dealt.groupBy("cell", "item_id").agg(*[
            F.bit_or(F.when(F.floor(F.col("blk") / MASK_BITS) == w, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"h{w}")
            for w in words])
        dealt = dealt.join(held, ["cell", "item_id"])
    else:
        dealt = dealt.select("*", *[F.lit((1 << MASK_BITS) - 1).cast("bigint").alias(f"h{w}") for w in words])
    dealt = dealt.select("cell", "blk", "user_id", "item_id", "val", "dev", "attrs", F.array(*[f"h{w}" for w in words]).alias("held"))
    # a block's rows go to several tasks, in order, so that packed pieces are long and compress well
    salt = F.pmod(F.xxhash64("user_id", F.lit(1)), F.lit(max(1, (SPREAD if k else 32) // max(1, cells * blocks))))
    packed = (dealt.repartition("cell", "blk", salt).sortWithinPartitions("cell", "blk", "user_id", "item_id")
              .mapInArrow(_packer(blocks, bool(k)), PACKED))
    if k:
        groups = min(MAX_GROUPS, cells * blocks)
        task = F.pmod(F.col("cell") * blocks + F.col("bi"), F.lit(groups)).cast("int")  # cells are small numbers: one group a task
        return (packed.repartitionById(groups, task).sortWithinPartitions("cell", "bi", "side")
                .mapInArrow(_streamer(rule, consumer, options, raters if cells == 1 else 0, _arrow(schema)), schema))
    # each block pair a task of its own: pairs dealt by hash would meet in one
    pairs = blocks * (blocks + 1) // 2
    groups = min(MAX_GROUPS, cells * pairs)
    task = F.pmod(F.col("cell") * pairs + F.expr("bj * (bj + 1) div 2") + F.col("bi"), F.lit(groups)).cast("int")
    return (packed.repartitionById(groups, task).sortWithinPartitions("cell", "bi", "bj", "side")
            .mapInArrow(_worker(rule, consumer, options, _arrow(schema)), schema))


def _arrow(schema: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _counts(base: DataFrame) -> tuple:
    """(cells, ratings, terms and most raters of an item in the largest cell, all ratings, their copies among 2, 4, 8, ... blocks)."""
    per_item = base.groupBy("cell", "item_id").agg(F.count(F.lit(1)).cast("double").alias("n"))
    # the copies of an item's ratings among 2, 4, 8, ... blocks
    copies = [F.sum(F.col("n") * (1 - F.pow(F.lit(1 - 1 / b), F.col("n"))) * b).alias(f"c{b}") for b in STEPS]
    counts = per_item.groupBy("cell").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("t"), F.max("n").alias("m"), *copies)
    top = counts.agg(F.count(F.lit(1)), F.max("n"), F.max("t"), F.max("m"), F.sum("n"), *[F.sum(f"c{b}") for b in STEPS]).first()
    return max(1, int(top[0])), *[x or 0.0 for x in top[1:5]], top[5:]


def _users(base: DataFrame) -> int:
    """Of the largest cell, about."""
    return base.groupBy("cell").agg(F.approx_count_distinct("user_id").alias("u")).agg(F.max("u")).first()[0] or 0


def _copied(blocks: int, copies) -> float | None:
    at = next((i for i, b in enumerate(STEPS) if b >= blocks), None)
    return None if at is None else copies[at] / STEPS[at]


def _shape(base: DataFrame, block_rows: int | None, users: int) -> tuple[int, int, bool]:
    """(cells, blocks of a cell, whether bit maps of the items' blocks leave out enough), from counts."""
    cells, n, terms, _, total, copies = _counts(base)
    must = math.ceil(n / (block_rows or BLOCK_ROWS))
    want = math.ceil(math.sqrt(terms / PAIR_TERMS))
    if max(must, want) <= 1:
        return cells, 1, False
    pairs = max(FEWEST_PAIRS, CORE_PAIRS * base.sparkSession.sparkContext.defaultParallelism)
    want = min(want, math.ceil(math.sqrt(2 * pairs / cells)))
    found = _users(base)
    must = min(must, math.ceil(found / FEWEST_USERS))
    blocks = max(1, must, min(want, math.ceil(found / max(BLOCK_USERS, users))))
    share = _copied(blocks, copies)
    return cells, blocks, blocks > 1 and not (share is not None and share >= FULL_SHARE * total)


def _list_shape(base: DataFrame, block_rows: int | None, k: int) -> tuple[int, int, bool, int]:
    """As ``_shape`` for blocks that all others stream past, and the raters of an item at most. Blocks follow the cores, and past that
    memory: their ratings, and the lists of their users where these are much shorter than what they are cut from."""
    cells, n, terms, raters, total, copies = _counts(base)
    must = math.ceil(n / (block_rows or LIST_ROWS))
    tasks = max(FEWEST_LISTS, CORE_LISTS * base.sparkSession.sparkContext.defaultParallelism)
    want = min(math.ceil(terms / PAIR_TERMS), math.ceil(tasks / cells))
    if max(must, want) <= 1:
        return cells, 1, False, int(raters)
    found = _users(base)
    must = min(must, math.ceil(found / FEWEST_USERS))
    if terms > 4 * k * found:
        must = max(must, math.ceil(found * k / LIST_EDGES))
    blocks = max(1, must, min(want, math.ceil(found / FEWEST_USERS)))
    share = _copied(blocks, copies)
    # a rating's way to its bit map costs some copies
    spared = 0.0 if share is None else (total - share) * blocks * RATING_BYTES - total * MASK_BYTES
    return cells, blocks, blocks > 1 and (share is None or spared > 0), int(raters)


def _zip(x) -> bytes:
    """Numbers as byte planes (the high bytes of neighbours are alike), and their number."""
    import numpy as np
    import pyarrow as pa

    x = np.ascontiguousarray(x)
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()
    return len(x).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def _unzip(raw: bytes, dtype):
    import numpy as np
    import pyarrow as pa

    n, width = int.from_bytes(raw[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.empty(0, dtype)
    planes = np.frombuffer(pa.decompress(raw[8:], decompressed_size=n * width, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(dtype).ravel()


class _Coded:
    """Values as places among the different values of their user: a user's ratings have few."""

    def __init__(self, x, who):
        import numpy as np

        bits = x.view(np.int64)
        by = np.lexsort((bits, who))
        new = np.concatenate([[True], (who[by][1:] != who[by][:-1]) | (bits[by][1:] != bits[by][:-1])])
        self.x, self.entry = x, np.empty(len(x), np.int64)
        self.entry[by] = np.cumsum(new) - 1
        self.values, self.owner = x[by[new]], who[by[new]]

    def pack(self, at) -> bytes:
        import numpy as np

        held = np.zeros(len(self.values), bool)
        held[self.entry[at]] = True
        used = np.flatnonzero(held)
        owner = self.owner[used]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        place = np.arange(len(used)) - np.repeat(first, np.diff(np.append(first, len(used))))
        if len(used) > 0.75 * len(at) or place.max() > 255:
            return b"\0" + _zip(self.x[at])
        places = np.zeros(len(self.values), np.uint8)
        places[used] = place
        parts = [_zip(self.values[used]), _zip(np.diff(np.append(first, len(used))).astype(np.uint16)), _zip(places[self.entry[at]])]
        return b"\1" + b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _values(raw: bytes, counts):
    """What ``_Coded.pack`` made, given the rows of each user."""
    import numpy as np

    if raw[:1] == b"\0":
        return _unzip(raw[1:], np.float64)
    parts, at = [], 1
    for dtype in (np.float64, np.uint16, np.uint8):
        n = int.from_bytes(raw[at:at + 4], "little")
        parts.append(_unzip(raw[at + 4:at + 4 + n], dtype))
        at += 4 + n
    values, each, places = parts
    first = np.cumsum(each, dtype=np.int64) - each
    return values[np.repeat(first, counts) + places]


def _packer(blocks: int, streamed: bool = False) -> Callable:
    """Rows in the order of their users, as pieces for block pairs; ``streamed``: for blocks that meet all others, a user's
    rows in one piece."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def flush(cell, blk, cols):
            user, item, val, dev, attrs, held = cols
            who = np.cumsum(np.concatenate([[0], user[1:] != user[:-1]]))
            val, dev = _Coded(val, who), _Coded(dev, who)

            def pack(at):
                u, i = user[at], item[at]
                first = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
                steps = np.diff(i, prepend=i[:1])
                steps[first] = i[first]
                return (len(at), attrs.shape[1], _zip(np.diff(u[first], prepend=0)), _zip(np.diff(np.append(first, len(u))).astype(np.int32)),
                        _zip(steps), val.pack(at), dev.pack(at), _zip(attrs[at][first].T.ravel()))

            out, size, whole = [], 0, None
            for j in range(blocks):
                at = np.flatnonzero((held[:, j // MASK_BITS] >> (j % MASK_BITS)) & 1) if blocks > 1 else np.arange(len(user))
                if not len(at):
                    continue
                if len(at) == len(user):
                    data = whole = whole or pack(at)
                else:
                    data = pack(at)
                key = (cell, j, 0, int(blk != j)) if streamed else (cell, min(blk, j), max(blk, j), int(blk > j))
                out.append((*key, *data))
                size += sum(map(len, data[2:]))
                if size >= PACK_BYTES:
                    yield batch_of(out)
                    out, size = [], 0
            if out:
                yield batch_of(out)

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), KINDS, strict=True)], names=NAMES)

        KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32()] + [pa.binary()] * 6
        NAMES = ["cell", "bi", "bj", "side", "n", "n_attrs", "users", "counts", "items", "vals", "devs", "attrs"]
        key, held_rows, cols = None, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, blk = (batch.column(i).to_numpy() for i in (0, 1))
            nan = lambda i: batch.column(i).cast("float64").to_numpy(zero_copy_only=False)
            wide = lambda i: batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            got = [batch.column(2).to_numpy(), batch.column(3).to_numpy(), nan(4), nan(5), wide(6), wide(7)]
            cut = np.flatnonzero((np.diff(cell) != 0) | (np.diff(blk) != 0)) + 1
            for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
                now = (int(cell[a]), int(blk[a]))
                if key is not None and now != key:
                    yield from flush(*key, [np.concatenate(c) for c in cols])
                    key = None
                elif key is not None and held_rows >= PACK_ROWS:
                    # the last user may go on
                    joined = [np.concatenate(c) for c in cols]
                    end = int(np.searchsorted(joined[0], joined[0][-1]))
                    if end:
                        yield from flush(*key, [c[:end] for c in joined])
                    cols, held_rows = [[c[end:]] for c in joined], len(joined[0]) - end
                if key is None:
                    key, held_rows, cols = now, 0, [[] for _ in got]
                for c, x in zip(cols, got, strict=True):
                    c.append(x[a:b])
                held_rows += b - a
        if key is not None:
            yield from flush(*key, [np.concatenate(c) for c in cols])

    return run


def _rows_of(batches) -> Iterator[dict]:
    for batch in batches:
        names = batch.schema.names
        for i in range(batch.num_rows):
            yield dict(zip(names, (batch.column(c)[i].as_py() for c in range(batch.num_columns)), strict=True))


def _answer(cols, arrow):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)],
                                      schema=arrow)


def _streamer(rule: Rule, consumer: type, options: dict, raters: int, arrow) -> Callable:
    """A block's own ratings come first, then the others' stream past."""
    def run(batches):
        import numpy as np

        def pieces(rows):
            some, n = [], 0
            for r in rows:
                some.append(r)
                n += r["n"]
                if n >= STREAM_ROWS:
                    yield _joined(some)
                    some, n = [], 0
            if some:
                yield _joined(some)

        for (cell, _), group in itertools.groupby(_rows_of(batches), lambda r: (r["cell"], r["bi"])):
            own, lists = [], None
            sides = itertools.groupby(group, lambda r: r["side"])
            for side, rows in sides:
                if side == 0:
                    own = _joined(rows)
                    items = np.unique(own[1])
                    lists = consumer(rule, cell, **options, own=_Side(own[0], np.searchsorted(items, own[1]), *own[2:]), items=items, raters=raters)
                    del own
                    lists.meet(lists.own, True)
                elif lists is not None:  # else the block has no users of its own
                    for user, item, val, dev, attrs in pieces(rows):
                        at = np.minimum(np.searchsorted(lists.items, item), len(lists.items) - 1)
                        here = lists.items[at] == item
                        if here.any():
                            lists.meet(_Side(user[here], at[here], val[here], dev[here], attrs[:, here]), False)
                        for cols in lists.early():
                            yield _answer(cols, arrow)
            if lists is not None:
                for cols in lists.found():
                    yield _answer(cols, arrow)

    return run


def _worker(rule: Rule, consumer: type, options: dict, arrow) -> Callable:
    def run(batches):
        for key, group in itertools.groupby(_rows_of(batches), lambda r: (r["cell"], r["bi"], r["bj"])):
            rows = list(group)
            if key[1] != key[2] and len({r["side"] for r in rows}) == 1:
                continue  # one of the blocks is empty
            sides = _read(rows)
            for cols in consumer(rule, key[0], **options).run(*sides):
                if len(cols[0]):
                    yield _answer(cols, arrow)

    return run


# ------------------------------------------------------------------------------------------------ one block pair

class _Side:
    """A block's ratings by user (``ul``, ``il``: places of the user and the item), its requests and its users'
    attributes."""

    def __init__(self, user, item, val, dev, attrs):
        import numpy as np

        self.users, first, ul = np.unique(user, return_index=True, return_inverse=True)
        self.attrs = attrs[:, first]
        asked = np.isnan(val)
        keep = np.flatnonzero(~asked)
        keep = keep[np.argsort(ul[keep], kind="stable")]
        self.ul, self.il, self.val, self.dev = ul[keep], item[keep], val[keep], dev[keep]
        ask = np.unique(np.stack([ul[asked], item[asked]], axis=1), axis=0)
        self.ask_u, self.ask_i = ask[:, 0], ask[:, 1]

    def by_item(self, n_items):
        """Starts per item, and the entries in item order."""
        import numpy as np

        if not hasattr(self, "_by"):
            order = np.argsort(self.il, kind="stable")
            self._by = np.concatenate([[0], np.cumsum(np.bincount(self.il, minlength=n_items))]), order
        return self._by

    def marked(self):
        """The same users with their marked entries only."""
        import copy

        at, out = self.dev == 1, copy.copy(self)
        out.__dict__.pop("_by", None)
        out.ul, out.il, out.val, out.dev = (x[at] for x in (self.ul, self.il, self.val, self.dev))
        return out

    def part(self, lo, hi):
        """The users at the places lo to hi (not included)."""
        import copy

        import numpy as np

        out = copy.copy(self)
        for made in ("_by", "_longest", "_words", "devs", "held"):
            out.__dict__.pop(made, None)
        x, y = slice(*np.searchsorted(self.ul, [lo, hi])), slice(*np.searchsorted(self.ask_u, [lo, hi]))
        out.users, out.attrs, out.ul, out.ask_u = self.users[lo:hi], self.attrs[:, lo:hi], self.ul[x] - lo, self.ask_u[y] - lo
        out.il, out.val, out.dev, out.ask_i = self.il[x], self.val[x], self.dev[x], self.ask_i[y]
        return out

    def words(self, first):
        """The attributes from ``first`` on, a user's side by side."""
        import numpy as np

        if not hasattr(self, "_words"):
            self._words = np.ascontiguousarray(self.attrs[first:].T)
        return self._words

    def longest(self) -> float:
        """The largest norm of a user's sizes of values, repeated ratings added up."""
        import numpy as np

        if not hasattr(self, "_longest"):
            # over all repeats: a sum of squares of sums is at most the number of repeats times the sum of squares
            repeats = 1
            if len(self.il):
                key = self.ul * (int(self.il.max()) + 1) + self.il
                repeats = int(np.unique(key, return_counts=True)[1].max())
            self._longest = math.sqrt(repeats * float(np.bincount(self.ul, self.val * self.val).max(initial=0.0)))
        return self._longest

    def sizes(self, places, n_items):
        """Rows of the matrix of the values' sizes, for the users at these places (any order, repeats too)."""
        import numpy as np

        who, row = np.unique(places, return_inverse=True)
        first = np.searchsorted(self.ul, who)
        n = np.searchsorted(self.ul, who, side="right") - first
        entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        cell = np.repeat(np.arange(len(who)), n) * n_items + self.il[entry]
        return np.bincount(cell, np.abs(self.val[entry]), len(who) * n_items).reshape(-1, n_items)[row]

    def matrix(self, x, n_items):
        import numpy as np

        return np.bincount(self.ul * n_items + self.il, weights=x, minlength=len(self.users) * n_items).reshape(-1, n_items)


def _joined(rows) -> list:
    """(users, items, values, deviations, attributes) of packed pieces, one entry a rating."""
    import numpy as np

    parts = []
    for r in rows:
        counts = _unzip(r["counts"], np.int32)
        first = np.cumsum(counts, dtype=np.int64) - counts
        steps = np.cumsum(_unzip(r["items"], np.int64))
        item = steps - np.repeat(np.append(0, steps)[first], counts)
        attrs = np.repeat(_unzip(r["attrs"], np.int64).reshape(r["n_attrs"], len(counts)), counts, axis=1)
        user = np.repeat(np.cumsum(_unzip(r["users"], np.int64)), counts)
        parts.append((user, item, _values(r["vals"], counts), _values(r["devs"], counts), attrs))
    return [np.concatenate(c, axis=-1) for c in zip(*parts, strict=True)]


def _read(rows: list[dict]):
    """(side of bi, side of bj or None for a block with itself, items)."""
    import numpy as np

    whole = {s: _joined(p) for s in (0, 1) if (p := [r for r in rows if r["side"] == s])}
    same = rows[0]["bi"] == rows[0]["bj"]
    items = np.unique(np.concatenate([w[1] for w in whole.values()]))
    sides = {s: _Side(w[0], np.searchsorted(items, w[1]), *w[2:]) for s, w in whole.items()}
    if same:
        return sides[0], None, items
    return sides.get(0), sides.get(1), items


class _Consumer:
    def __init__(self, rule: Rule, cell: int):
        self.rule, self.cell = rule, cell

    both = True  # each direction on its own

    def run(self, a, b, items) -> Iterator[list]:
        for x, y in self._parts(a, b, len(items)):
            if y is None:
                yield from self.slices(x, x, items, True)
            elif x is not None:
                yield from self.slices(x, y, items, False)
                if self.both:
                    yield from self.slices(y, x, items, False)

    def _parts(self, a, b, n_items):
        """The block pair, or pairs of parts of its blocks where matrices are worth it but would be too large at once."""
        import numpy as np

        if a is None or self.rule.prefix:
            return [(a, b)]
        other = a if b is None else b
        terms = float(np.bincount(a.il, minlength=n_items) @ np.bincount(other.il, minlength=n_items))
        n = math.ceil(self._bytes(a, other, n_items) / DENSE_BYTES) if terms and self._pays(a, other, n_items, terms) else 1
        if n <= 1:
            return [(a, b)]
        cut = lambda s: [s.part(*x) for x in itertools.pairwise(len(s.users) * i // n for i in range(n + 1)) if x[0] < x[1]]
        own = cut(a)
        if b is None:
            return [(x, None) for x in own] + list(itertools.combinations(own, 2))
        return list(itertools.product(own, cut(b)))

    def _pays(self, a, b, n_items, terms) -> bool:
        """Whether a product of matrices costs less than the terms one by one."""
        return len(a.users) * len(b.users) * (n_items / 1.5e9 + 2e-8) < terms * 1.5e-7

    def _bytes(self, a, b, n_items) -> int:
        return (len(a.users) + len(b.users)) * n_items * 8 * (1 if self.rule.sets else 2) * (1 if self.both else 2)

    def slices(self, a, b, items, same):
        import numpy as np

        n_items = len(items)
        if self.rule.prefix:
            yield from self._marked(a, b, items, same)
            return
        starts, order = b.by_item(n_items)
        terms = np.diff(starts)[a.il]
        total = int(terms.sum())
        if not total:
            return
        if self._is_dense(a, b, n_items, total):
            yield from self._dense(a, b, items, same)
        else:
            yield from self._sparse(a, b, items, same, starts, order, terms)

    def _is_dense(self, a, b, n_items, terms) -> bool:
        return self._pays(a, b, n_items, terms) and self._bytes(a, b, n_items) <= DENSE_BYTES

    def _marked(self, a, b, items, same):
        """Pairs that share a marked item and whose sizes allow the similarity, verified on the items of a."""
        import numpy as np

        rule, ub, n_items = self.rule, len(b.users), len(items)
        x, y = a.marked(), b.marked()
        starts, order = y.by_item(n_items)
        terms = np.diff(starts)[x.il]
        total = int(terms.sum())
        if not total:
            return
        if self._is_dense(a, b, n_items, total):
            yield from self._dense(a, b, items, same)
            return
        held = np.sort(b.il * ub + b.ul)
        first = np.searchsorted(a.ul, np.arange(len(a.users) + 1))
        for lo, hi, rows, cols, _ in self._terms(x, y, same, starts, order, terms):
            key = np.unique((rows - lo) * ub + cols)
            rows, cols = key // ub + lo, key % ub
            na, nb = a.attrs[-1][rows], b.attrs[-1][cols]
            ok = np.minimum(na, nb) >= np.maximum(na, nb) * rule.least - 1e-9
            rows, cols = rows[ok], cols[ok]
            n = (first[1:] - first[:-1])[rows]
            ends = np.concatenate([[0], np.cumsum(n)])
            at = 0
            while at < len(rows):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_TERMS, side="right")) - 1)
                r, c, m = rows[at:to], cols[at:to], n[at:to]
                pair = np.repeat(np.arange(to - at), m)
                entry = np.arange(len(pair)) - np.repeat(ends[at:to] - ends[at], m) + np.repeat(first[r], m)
                want = a.il[entry] * ub + c[pair]
                common = np.bincount(pair, np.searchsorted(held, want, side="right") - np.searchsorted(held, want), to - at)
                sim = common / (a.attrs[-1][r].astype(float) + b.attrs[-1][c] - common)
                good = sim >= rule.least
                yield from self.sparse(a, b, items, same, lo, hi, r[good], c[good], sim[good])
                at = to

    def _dense(self, a, b, items, same):
        for lo, hi, s, ok in self._products(a, b, items, same):
            yield from self.dense(a, b, items, same, lo, hi, s, ok)

    def _products(self, a, b, items, same):
        """(first user, end, similarities with all of b, which count) of a slice of a's users."""
        import numpy as np

        n_items, ua, ub = len(items), len(a.users), len(b.users)
        rule = self.rule
        ma = a.matrix(a.val, n_items)
        mb = ma if same else b.matrix(b.val, n_items)
        step = max(1, SLICE_CELLS // ub)
        for lo in range(0, ua, step):
            hi = min(ua, lo + step)
            s = ma[lo:hi] @ mb.T
            if rule.sets:
                ok = s > 0.5
                s = s / (a.attrs[-1][lo:hi, None].astype(float) + b.attrs[-1][None, :] - s)
            else:
                ok = _apart_from_noise(np.abs(s), s, a, b, n_items, lo)
            if rule.least:
                ok &= s >= rule.least
            if same:
                ok[np.arange(hi - lo), np.arange(lo, hi)] = False
            for w in range(rule.apart):
                ok &= (a.attrs[w][lo:hi, None] & b.attrs[w][None, :]) == 0
            yield lo, hi, s, ok

    def _terms(self, a, b, same, starts, order, terms):
        """(first user, end, rows, cols, products): the terms of a slice of a's users; a slice ends where a user ends."""
        import numpy as np

        b_ul, b_val = b.ul[order], b.val[order]
        ends = np.concatenate([[0], np.cumsum(terms)])
        first = np.searchsorted(a.ul, np.arange(len(a.users) + 1))
        at = ends[first]
        lo = 0
        while lo < len(a.users):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + SLICE_TERMS, side="right")) - 1)
            e0, e1 = first[lo], first[hi]
            n = terms[e0:e1]
            entry = np.repeat(np.arange(e0, e1), n)
            pos = np.arange(len(entry)) - np.repeat(ends[e0:e1] - ends[e0], n) + np.repeat(starts[a.il[e0:e1]], n)
            rows, cols = a.ul[entry], b_ul[pos]
            prod = a.val[entry] * b_val[pos]
            if same:
                keep = (rows != cols) if self.both else (rows < cols)
                rows, cols, prod = rows[keep], cols[keep], prod[keep]
            if len(rows):
                yield lo, hi, rows, cols, prod
            lo = hi

    def _sparse(self, a, b, items, same, starts, order, terms):
        import numpy as np

        rule, ub = self.rule, len(b.users)
        for lo, hi, rows, cols, prod in self._terms(a, b, same, starts, order, terms):
            key = (rows - lo) * ub + cols
            by = np.argsort(key)
            key, prod = key[by], prod[by]
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            key, sim = key[new], np.add.reduceat(prod, new)
            rows, cols = key // ub + lo, key % ub
            if rule.sets:
                ok = np.ones(len(key), bool)
                sim = sim / (a.attrs[-1][rows].astype(float) + b.attrs[-1][cols] - sim)
            else:
                ok = np.abs(sim) > NOISE * np.add.reduceat(np.abs(prod), new)
            if rule.least:
                ok &= sim >= rule.least
            for w in range(rule.apart):
                ok &= (a.attrs[w][rows] & b.attrs[w][cols]) == 0
            yield from self.sparse(a, b, items, same, lo, hi, rows[ok], cols[ok], sim[ok])


def _apart_from_noise(size, s, a, b, n_items, lo):
    """Where a sum of products is more than the rounding error of its terms. No sum of sizes exceeds the product of the norms, so
    these are formed only where the sum is that small (and not zero, which no size makes a similarity)."""
    import numpy as np

    ok = size > NOISE * a.longest() * b.longest()
    at = np.flatnonzero(~ok)
    at = at[s.ravel()[at] != 0]
    for x in range(0, len(at), max(1, SLICE_TERMS // n_items)):
        some = at[x:x + max(1, SLICE_TERMS // n_items)]
        r, c = np.divmod(some, s.shape[1])
        # repeated ratings add up in a matrix; their sizes do not cancel
        za, zb = a.sizes(r + lo, n_items), b.sizes(c, n_items)
        ok.ravel()[some] = size.ravel()[some] > NOISE * np.einsum("ij,ij->i", za, zb)
    return ok


class _Pairs(_Consumer):
    both = False

    def __init__(self, rule, cell, edges=False):
        super().__init__(rule, cell)
        self.edges = edges

    def dense(self, a, b, items, same, lo, hi, s, ok):
        import numpy as np

        rows, cols = np.nonzero(ok)
        sims = s[rows, cols]
        rows = rows + lo
        if same:
            keep = rows < cols
            rows, cols, sims = rows[keep], cols[keep], sims[keep]
        yield from self.sparse(a, b, items, same, lo, hi, rows, cols, sims)

    def sparse(self, a, b, items, same, lo, hi, rows, cols, sims):
        import numpy as np

        if self.edges:
            back = np.argsort(cols, kind="stable")
            for u, v, s in ((a.users[rows], b.users[cols], sims), (b.users[cols[back]], a.users[rows[back]], sims[back])):
                for at in range(0, len(u), 200_000):
                    x = u[at:at + 200_000]
                    yield [np.full(len(x), self.cell), x, v[at:at + 200_000], s[at:at + 200_000]]
            return
        for at in range(0, len(rows), 200_000):
            x, y = a.users[rows[at:at + 200_000]], b.users[cols[at:at + 200_000]]
            yield [np.full(len(x), self.cell), np.minimum(x, y), np.maximum(x, y), sims[at:at + 200_000]]


class _Best(_Consumer):
    def __init__(self, rule, cell, k):
        super().__init__(rule, cell)
        self.k = k

    def _levels(self, a, b, pick):
        """(level, whether a pair shares a bit there and at none before) for the pairs ``pick`` names."""
        rule, before = self.rule, None
        for i, level in enumerate(rule.levels):
            shared = False
            for w in range(rule.words):
                x, y = pick(rule.apart + i * rule.words + w)
                shared = shared | ((x & y) != 0)
            yield level, shared if before is None else shared & ~before
            before = shared if before is None else shared | before

    def dense(self, a, b, items, same, lo, hi, s, ok):
        import numpy as np

        key = np.floor(s * KEY_SCALE + 0.5)
        pick = lambda w: (a.attrs[w][lo:hi, None], b.attrs[w][None, :])
        for level, here in (self._levels(a, b, pick) if self.rule.levels else [(0, True)]):
            mask = ok & here
            seen = mask.sum(axis=1)
            if self.k < mask.shape[1]:
                neg = np.where(mask, -key, np.inf)
                mask &= neg <= np.partition(neg, self.k - 1, axis=1)[:, self.k - 1:self.k]
            rows, cols = np.nonzero(mask)
            yield self._cut(a, b, level, lo, rows, cols, s[rows, cols], seen)

    def sparse(self, a, b, items, same, lo, hi, rows, cols, sims):
        import numpy as np

        pick = lambda w: (a.attrs[w][rows], b.attrs[w][cols])
        for level, here in (self._levels(a, b, pick) if self.rule.levels else [(0, None)]):
            r, c, s = (rows, cols, sims) if here is None else (rows[here], cols[here], sims[here])
            yield self._cut(a, b, level, lo, r - lo, c, s, np.bincount(r - lo, minlength=hi - lo))

    def _cut(self, a, b, level, lo, rows, cols, sims, seen):
        """The k best per row: similarity at ten decimals descending, then the neighbour's id (places follow ids)."""
        import numpy as np
        import pyarrow as pa

        by = np.lexsort((cols, -np.floor(sims * KEY_SCALE + 0.5), rows))
        rows = rows[by]
        start = np.searchsorted(rows, np.arange(len(seen)))
        rank = np.arange(len(rows)) - start[rows]
        keep = rank < self.k
        rows, by = rows[keep], by[keep]
        who, first = np.unique(rows, return_index=True)
        cuts = pa.array(np.append(first, len(rows)), pa.int32())
        near, sims = (pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (b.users[cols[by]], sims[by]))
        return [np.full(len(who), self.cell), np.full(len(who), level), a.users[who + lo], near, sims, seen[who]]


class _Lists(_Best):
    """The lists of a block's users while others stream past. A list is a user's at one level, its number level * users + user.
    ``least``: the key of the k-th best found so far at a level, or at a lower one if that is not negative; what is below it can't
    be among the k best of any level from there on."""

    def __init__(self, rule, cell, k, own, items, raters=0):
        import numpy as np

        super().__init__(rule, cell, k)
        if rule.sets or rule.prefix:
            raise ValueError("lists are of sums of products")
        self.own, self.items = own, items
        self.n, self.levels = len(own.users), rule.levels or (0,)
        self.lists, self.fresh, self.n_fresh = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)), [], 0
        self.least = np.full(len(self.levels) * self.n, -np.inf)
        self.seen = np.zeros(len(self.levels) * self.n, np.int64)
        self.out, self.version = [], 0
        if raters and not rule.levels and not rule.apart:
            # so many users share no item with this one that negative ones come after the k-th place
            shared = np.bincount(own.ul, minlength=self.n) * float(raters)
            self.least[self.n - 1 - shared >= k] = 0.0
        wide = max(1, len(items)) * 12
        width = max(1, min(DENSE_BYTES // 2 // wide, SLICE_CELLS))
        cuts = range(0, self.n, width) if self.n > width else ()
        self.parts = [(lo, own.part(lo, min(self.n, lo + width))) for lo in cuts] or [(0, own)]
        self.chunk = max(1, DENSE_BYTES // 4 // wide)

    def meet(self, a, same):
        """Users of a (``same``: this block's own) with the block's."""
        import numpy as np

        n_items = len(self.items)
        starts, order = self.own.by_item(n_items)
        terms = np.diff(starts)[a.il]
        total = int(terms.sum())
        if not total:
            return
        if not self._pays(a, self.own, n_items, total):
            for _ in self._sparse(a, self.own, self.items, same, starts, order, terms):
                pass
            return
        for x in range(0, len(a.users), self.chunk):
            some = a if len(a.users) <= self.chunk else a.part(x, min(len(a.users), x + self.chunk))
            for at, part in self.parts:
                self._near(some, part, at, same)

    def sparse(self, a, b, items, same, lo, hi, rows, cols, sims):
        self._take(a.users[rows], self._list_of(a, rows, cols), sims)
        return ()

    def _near(self, a, b, at, same):
        """Users of a with the part of the block that begins at ``at``: exactly where a list is not settled, else in single precision
        first."""
        import numpy as np

        n_items = len(self.items)
        ma, mb = a.matrix(a.val, n_items), b.matrix(b.val, n_items)
        a32 = ma.astype(np.float32)
        # of a product in single precision: rounded inputs, products and sums
        slip = (n_items + 8) * 2.0 ** -23 * math.sqrt(float((ma * ma).sum(axis=1).max(initial=0.0))) * np.sqrt((mb * mb).sum(axis=1))
        own = np.searchsorted(b.users, a.users) if same else None
        step, some = max(1, SLICE_CELLS // len(b.users)), max(1, SLICE_TERMS // n_items)
        version, lo = -1, 0
        while lo < len(a.users):
            if version != self.version:
                version = self.version
                least = self.least[at:at + len(b.users)]  # no level's is below that of the first
                open_, done = np.flatnonzero(least < 0), np.flatnonzero(least >= 0)
                mo, md = mb[open_], mb[done]
                d32 = md.astype(np.float32)
                bound = np.nextafter(((least[done] - 0.5) / KEY_SCALE - slip[done]).astype(np.float32), np.float32(-np.inf))
            hi = min(len(a.users), lo + step)
            if len(open_):
                s = ma[lo:hi] @ mo.T
                rows, cols = np.nonzero(s)
                self._exact(a, b, at, lo + rows, open_[cols], s[rows, cols], own)
            if len(done):
                s = a32[lo:hi] @ d32.T
                near = np.flatnonzero(s >= bound)
                rows, cols = np.divmod(near, len(done))
                rows, cols = rows + lo, done[cols]
                if len(near) > 0.04 * s.size:
                    self._exact(a, b, at, rows, cols, (ma[lo:hi] @ md.T).ravel()[near], own)
                else:
                    if self.rule.levels:
                        most = np.floor((s.ravel()[near] + slip[cols]) * KEY_SCALE + 0.5)
                        where = self._list_of(a, rows, cols + at)
                        keep = np.flatnonzero((where >= 0) & (most >= self.least[where]))
                        rows, cols = rows[keep], cols[keep]
                    for x in range(0, len(rows), some):
                        r, c = rows[x:x + some], cols[x:x + some]
                        self._exact(a, b, at, r, c, np.einsum("ij,ij->i", ma[r], mb[c]), own)
            lo = hi

    def _exact(self, a, b, at, rows, cols, sims, own):
        """Takes what is no user with itself, no pair of another cell and no rounding error."""
        import numpy as np

        ok = np.ones(len(rows), bool)
        if own is not None:
            ok = b.users[cols] != a.users[rows]
        for w in range(self.rule.apart):
            ok &= (a.attrs[w][rows] & b.attrs[w][cols]) == 0
        small = np.flatnonzero(ok & (np.abs(sims) <= NOISE * a.longest() * b.longest()))
        n_items = len(self.items)
        for x in range(0, len(small), max(1, SLICE_TERMS // n_items)):
            some = small[x:x + max(1, SLICE_TERMS // n_items)]
            size = np.einsum("ij,ij->i", a.sizes(rows[some], n_items), b.sizes(cols[some], n_items))
            ok[some] = np.abs(sims[some]) > NOISE * size
        if self.rule.least:
            ok &= sims >= self.rule.least
        if not ok.all():
            rows, cols, sims = rows[ok], cols[ok], sims[ok]
        self._take(a.users[rows], self._list_of(a, rows, cols + at), sims)

    def _list_of(self, a, rows, cols):
        """The list a pair comes to, that of the lowest level at which its users share a bit (-1: none)."""
        import numpy as np

        if not self.rule.levels:
            return cols
        x, y = (s.words(self.rule.apart) for s in (a, self.own))
        shared = ((x[rows] & y[cols]) != 0).reshape(len(rows), len(self.levels), self.rule.words).any(axis=2)
        level = shared.argmax(axis=1)
        return np.where(shared[np.arange(len(rows)), level], level * self.n + cols, -1)

    def _take(self, users, where, sims):
        """Edges to these users, each for the list named by ``where``."""
        import numpy as np

        if self.rule.levels:
            there = np.flatnonzero(where >= 0)
            users, where, sims = users[there], where[there], sims[there]
        self.seen += np.bincount(where, minlength=len(self.seen))
        good = np.flatnonzero(np.floor(sims * KEY_SCALE + 0.5) >= self.least[where])
        if len(good):
            self.fresh.append((where[good], users[good], sims[good]))
            self.n_fresh += len(good)
        if self.n_fresh > max(SETTLE_EDGES, len(self.lists[0]) // 2):
            self._settle()

    def _settle(self):
        """Cuts each list, with what was found since, to the k best: similarity at ten decimals descending, then the id."""
        import numpy as np

        if self.fresh:
            u, v, s = (np.concatenate(c) for c in zip(self.lists, *self.fresh, strict=True))
            self.fresh, self.n_fresh = [], 0
            key = np.floor(s * KEY_SCALE + 0.5)
            by = _ranked(u, key, v)
            u = u[by]
            first = np.searchsorted(u, np.arange(len(self.least) + 1))
            keep = np.flatnonzero(np.arange(len(u)) - first[u] < self.k)
            full = np.flatnonzero(np.diff(first) >= self.k)
            self.least[full] = np.maximum(self.least[full], key[by[first[full] + self.k - 1]])
            by, u = by[keep], u[keep]
            self.lists = u, v[by], s[by]
            for i in range(1, len(self.levels)):
                # a negative bound holds for its own level only: the counts of the levels above still matter
                low, here = (self.least[x * self.n:(x + 1) * self.n] for x in (i - 1, i))
                here[:] = np.where(low >= 0, np.maximum(here, low), here)
        self.version += 1
        if len(self.lists[0]) > LIST_EDGES:
            self._leave()

    def _leave(self):
        """Lists too long to be kept: all but each list's best edge, which takes the count along at the end."""
        import numpy as np

        u, v, s = self.lists
        head = np.concatenate([[True], u[1:] != u[:-1]])
        self.out.append((u[~head], v[~head], s[~head], False))
        self.lists = u[head], v[head], s[head]

    def early(self) -> Iterator[list]:
        out, self.out = self.out, []
        for part in out:
            yield from self._rows(*part)

    def found(self) -> Iterator[list]:
        import numpy as np

        self._settle()
        yield from self.early()
        u, v, s = self.lists
        good = np.flatnonzero(np.floor(s * KEY_SCALE + 0.5) >= self.least[u])
        yield from self._rows(u[good], v[good], s[good], True)

    def _rows(self, u, v, s, counted):
        import numpy as np
        import pyarrow as pa

        who, first = np.unique(u, return_index=True)
        ends, x = np.append(first, len(u)), 0
        while x < len(who):
            y = min(len(who), max(x + 1, int(np.searchsorted(ends, ends[x] + 200_000, side="right")) - 1))
            cuts = pa.array(ends[x:y + 1] - ends[x], pa.int32())
            near, sims = (pa.ListArray.from_arrays(cuts, pa.array(z[ends[x]:ends[y]])) for z in (v, s))
            level, user = np.divmod(who[x:y], self.n)
            seen = self.seen[who[x:y]] if counted else np.zeros(y - x, np.int64)
            yield [np.full(y - x, self.cell), np.array(self.levels)[level], self.own.users[user], near, sims, seen]
            x = y


def _ranked(u, key, v):
    """The order by u, then key descending, then v."""
    import numpy as np

    if not len(u):
        return np.empty(0, np.int64)
    top = key.max()
    span = top - key.min() + 1
    if (u.max() + 1) * span >= 2.0 ** 62:
        return np.lexsort((v, -key, u))
    whole = u * int(span) + (top - key).astype(np.int64)
    by = np.argsort(whole)
    whole = whole[by]
    tied = whole[1:] == whole[:-1]
    at = np.flatnonzero(np.append(tied, False) | np.append(False, tied))
    if len(at):
        some = by[at]
        by[at] = some[np.lexsort((v[some], whole[at]))]
    return by


class _Sums(_Consumer):
    def run(self, a, b, items):
        n_items = len(items)
        for x, y in self._parts(a, b, n_items):
            if y is not None and x is not None and self._worth(x, y, n_items):
                yield from self._dense_both(x, y, items)
            elif y is None:
                yield from self.slices(x, x, items, True)
            elif x is not None:
                yield from self.slices(x, y, items, False)
                yield from self.slices(y, x, items, False)

    def _worth(self, x, y, n_items) -> bool:
        import numpy as np

        if self.rule.prefix:
            return False
        total = int(np.bincount(x.il, minlength=n_items) @ np.bincount(y.il, minlength=n_items))
        return total > 0 and self._is_dense(x, y, n_items, total)

    def _rated(self, s, n_items):
        """Deviations and whether there is one, per user and item, kept with the side."""
        import numpy as np

        if not hasattr(s, "devs"):
            s.devs, s.held = s.matrix(np.nan_to_num(s.dev), n_items), s.matrix(np.ones(len(s.ul)), n_items)
        return s.devs, s.held

    def _dense_both(self, a, b, items):
        """Each similarity of two blocks is formed once and used for the requests of both its users."""
        import numpy as np

        n_items, ub = len(items), len(b.users)
        (da, ha), (db, hb) = self._rated(a, n_items), self._rated(b, n_items)
        asked = len(b.ask_u) > 0
        num, den = (np.zeros((ub, n_items)) for _ in range(2)) if asked else (None, None)
        # sum(s * dev) over products s of ratings: the others' ratings and deviations first, what does not count taken off
        plain = not self.rule.sets and not self.rule.least and not self.rule.apart and n_items <= ub
        if plain:
            ma, mb = a.matrix(a.val, n_items), b.matrix(b.val, n_items)
            through = mb.T @ db
            if asked:
                num += mb @ (ma.T @ da)
        for lo, hi, s, ok in self._products(a, b, items, False):
            at = np.arange(*np.searchsorted(a.ask_u, [lo, hi]))
            if plain:
                top = ma[lo:hi] @ through
                if not ok.all():
                    r, c = np.nonzero(~ok & (s != 0))
                    for x in range(0, len(r), max(1, SLICE_TERMS // n_items)):
                        i, j = (y[x:x + max(1, SLICE_TERMS // n_items)] for y in (r, c))
                        np.subtract.at(top, i, s[i, j, None] * db[j])
                        if asked:
                            np.subtract.at(num, j, s[i, j, None] * da[lo + i])
                    s *= ok
                size = np.abs(s)
            else:
                s *= ok
                size = s if self.rule.sets else np.abs(s)
                top = s @ db if len(at) else None
                if asked:
                    num += s.T @ da[lo:hi]
            if len(at):
                place = a.ask_u[at] - lo, a.ask_i[at]
                over, under = top[place], (size @ hb)[place]
                yield self._out(a, items, at, self._direct(a, b, items, at, over, under) if plain else over, under)
            if asked:
                den += size.T @ ha[lo:hi]
        if asked:
            place, at = (b.ask_u, b.ask_i), np.arange(len(b.ask_u))
            over, under = num[place], den[place]
            yield self._out(b, items, at, self._direct(b, a, items, at, over, under) if plain else over, under)

    def _direct(self, a, b, items, at, num, den):
        """The sums over b for a's requests; those so small that terms which cancel could be seen in them are summed one by one."""
        import numpy as np

        devs, held = self._rated(b, len(items))
        least = 1e-6 * held.sum(axis=0) * a.longest() * b.longest()
        weak = np.flatnonzero((den > 0) & (den < least[a.ask_i[at]]))
        for u in np.unique(a.ask_u[at[weak]]):
            for _, _, s, ok in self._products(a.part(u, u + 1), b, items, False):
                mine = weak[a.ask_u[at[weak]] == u]
                num[mine] = (s * ok)[0] @ devs[:, a.ask_i[at[mine]]]
        return num

    def dense(self, a, b, items, same, lo, hi, s, ok):
        import numpy as np

        at = np.arange(*np.searchsorted(a.ask_u, [lo, hi]))
        if not len(at):
            return
        devs, held = self._rated(b, len(items))
        s = np.where(ok, s, 0.0)
        place = a.ask_u[at] - lo, a.ask_i[at]
        yield self._out(a, items, at, (s @ devs)[place], (np.abs(s) @ held)[place])

    def sparse(self, a, b, items, same, lo, hi, rows, cols, sims):
        import numpy as np

        ask = np.arange(*np.searchsorted(a.ask_u, [lo, hi]))
        if not len(ask) or not len(rows):
            return
        starts, order = b.by_item(len(items))
        key = (rows - lo) * len(b.users) + cols  # in order
        # the raters of the requested items, a bounded number at a time
        n = np.diff(starts)[a.ask_i[ask]]
        ends = np.concatenate([[0], np.cumsum(n)])
        x = 0
        while x < len(ask):
            y = max(x + 1, int(np.searchsorted(ends, ends[x] + SLICE_TERMS, side="right")) - 1)
            which = np.repeat(np.arange(x, y), n[x:y])
            pos = np.arange(len(which)) - np.repeat(ends[x:y] - ends[x], n[x:y]) + np.repeat(starts[a.ask_i[ask[x:y]]], n[x:y])
            entry = order[pos]
            want = (a.ask_u[ask[which]] - lo) * len(b.users) + b.ul[entry]
            found = np.minimum(np.searchsorted(key, want), len(key) - 1)
            hit = key[found] == want
            w, e, s = which[hit] - x, entry[hit], sims[found[hit]]
            yield self._out(a, items, ask[x:y], np.bincount(w, s * np.nan_to_num(b.dev[e]), y - x),
                            np.bincount(w, np.abs(s), y - x))
            x = y

    def _out(self, a, items, at, num, den):
        import numpy as np

        keep = np.flatnonzero(den > 0)
        return [a.users[a.ask_u[at[keep]]], items[a.ask_i[at[keep]]], num[keep], den[keep]]


def attrs(*words: Column | str) -> Column:
    return F.array(*[(F.col(w) if isinstance(w, str) else w).cast("bigint") for w in words]).alias("attrs")
