"""DuckDB SQL for the query catalogue: an independent, brute-force statement of each
query over the same parquet tables (views region ... conversations). Shared pieces are
CTE fragments; each query appends its final SELECT."""

from __future__ import annotations

# Fixed values shared with the Spark side (split, rating scale, bin seed).
LO, HI = 1.0, 5.0
SEED = 1337


def scale(x: str, a: str) -> str:
    return f"(CASE WHEN {x} > {a} THEN {HI} - {a} WHEN {x} < {a} THEN {a} - {LO} ELSE 1.0 END)"


def denorm(a: str, d: str) -> str:
    return f"({a} + {d} * {scale(f'({a} + {d})', a)})"


ORDERS = """SELECT o_custkey AS user_id, l_partkey AS item_id,
    CAST(MAX(1 + FLOOR((l_quantity - 1) / 10)) AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""

EVENTS = """SELECT user_id, item_id, rating FROM (
    SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
           CAST(LEAST(5, 1 + FLOOR(value / 20)) AS DOUBLE) AS rating,
           ROW_NUMBER() OVER (PARTITION BY user_id, CAST(json_extract_string(props, '$.k') AS BIGINT)
                              ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) WHERE rn = 1"""

FIXTURE = {"o": ORDERS, "e": EVENTS}


def base(fix: str, train: str = "SELECT user_id, item_id, rating FROM r WHERE (user_id * 31 + item_id * 17) % 5 <> 0") -> list[str]:
    """CTEs r, train, test, g, nu, ua, ia, dev, idev, nrm, rhat, cpairs, cedges, jpairs, jedges."""
    return [
        f"r AS ({FIXTURE[fix]})",
        f"train AS ({train})",
        "test AS (SELECT user_id, item_id, rating FROM r WHERE (user_id * 31 + item_id * 17) % 5 = 0)",
        "g AS (SELECT AVG(rating) AS g FROM train)",
        "nu AS (SELECT COUNT(DISTINCT user_id) AS n FROM train)",
        "ua AS (SELECT user_id, AVG(rating) AS user_avg, COUNT(*) AS n FROM train GROUP BY user_id)",
        "ia AS (SELECT item_id, AVG(rating) AS item_avg, COUNT(*) AS n FROM train GROUP BY item_id)",
        f"""dev AS (SELECT t.user_id, t.item_id, t.rating, ua.user_avg,
               (t.rating - ua.user_avg) / {scale('t.rating', 'ua.user_avg')} AS dev
             FROM train t JOIN ua ON ua.user_id = t.user_id)""",
        "idev AS (SELECT item_id, AVG(dev) AS dev, COUNT(*) AS n FROM dev GROUP BY item_id)",
        "nrm AS (SELECT user_id, SQRT(SUM(dev * dev)) AS norm FROM dev GROUP BY user_id)",
        """rhat AS (SELECT d.user_id, d.item_id, d.dev,
               CASE WHEN n.norm = 0 THEN 0.0 ELSE d.dev / n.norm END AS rhat
             FROM dev d JOIN nrm n ON n.user_id = d.user_id)""",
        """cpairs AS (SELECT a.user_id AS u, b.user_id AS v, SUM(a.rhat * b.rhat) AS sim, SUM(ABS(a.rhat * b.rhat)) AS size
             FROM rhat a JOIN rhat b ON a.item_id = b.item_id AND a.user_id < b.user_id GROUP BY 1, 2)""",
        """cedges AS (SELECT u, v, sim FROM cpairs WHERE ABS(sim) > 1e-12 * size
             UNION ALL SELECT v AS u, u AS v, sim FROM cpairs WHERE ABS(sim) > 1e-12 * size)""",
        """jcommon AS (SELECT a.user_id AS u, b.user_id AS v, COUNT(*) AS c
             FROM train a JOIN train b ON a.item_id = b.item_id AND a.user_id < b.user_id GROUP BY 1, 2)""",
        """jpairs AS (SELECT j.u, j.v, CAST(j.c AS DOUBLE) / (x.n + y.n - j.c) AS sim
             FROM jcommon j JOIN ua x ON x.user_id = j.u JOIN ua y ON y.user_id = j.v)""",
        "jedges AS (SELECT u, v, sim FROM jpairs UNION ALL SELECT v AS u, u AS v, sim FROM jpairs)",
    ]


def knn(name: str, edges: str, k: int, cand: str | None = None, keys: tuple[str, ...] = ()) -> list[str]:
    """Top-k by ranking every candidate pair, those without an edge at similarity 0. ``cand`` is a
    table (u, v[, keys]) of the candidates; default every two users of train."""
    kp = "".join(f", {c}" for c in keys)
    xkp = "".join(f", x.{c}" for c in keys)
    on = "".join(f" AND e.{c} = x.{c}" for c in keys)
    cand = cand or "(SELECT a.user_id AS u, b.user_id AS v FROM ua a JOIN ua b ON a.user_id <> b.user_id)"
    return [
        f"""{name}_r AS (SELECT x.u, x.v{xkp}, e.sim, ROW_NUMBER() OVER (PARTITION BY x.u{xkp}
               ORDER BY FLOOR(COALESCE(e.sim, 0.0) * 10000000000.0 + 0.5) DESC, e.sim IS NULL, x.v) AS rank
             FROM {cand} x LEFT JOIN {edges} e ON e.u = x.u AND e.v = x.v{on})""",
        f"""{name} AS (SELECT u AS user_id, v AS neighbor_id, sim{kp}, rank FROM {name}_r
             WHERE sim IS NOT NULL AND rank <= {k})""",
    ]


def weighted(name: str, edges: str, test: str = "test") -> list[str]:
    """Predictions for ``test`` weighted by ``edges`` (user_id, neighbor_id, sim)."""
    d = "COALESCE(s.num / NULLIF(s.den, 0), 0.0)"
    a = "COALESCE(ua.user_avg, (SELECT g FROM g))"
    return [
        f"""{name}_s AS (SELECT t.user_id, t.item_id, SUM(e.sim * d.dev) AS num, SUM(ABS(e.sim)) AS den
             FROM {test} t JOIN {edges} e ON e.user_id = t.user_id
             JOIN dev d ON d.user_id = e.neighbor_id AND d.item_id = t.item_id GROUP BY 1, 2)""",
        f"""{name} AS (SELECT t.user_id, t.item_id, t.rating, {denorm(a, d)} AS prediction
             FROM {test} t LEFT JOIN {name}_s s ON s.user_id = t.user_id AND s.item_id = t.item_id
             LEFT JOIN ua ON ua.user_id = t.user_id)""",
    ]


def simple_preds(test: str = "test", prefix: str = "p_") -> list[str]:
    a = "COALESCE(ua.user_avg, (SELECT g FROM g))"
    return [
        f"{prefix}global AS (SELECT user_id, item_id, rating, (SELECT g FROM g) AS prediction FROM {test})",
        f"""{prefix}user AS (SELECT t.user_id, t.item_id, t.rating, {a} AS prediction
             FROM {test} t LEFT JOIN ua ON ua.user_id = t.user_id)""",
        f"""{prefix}item AS (SELECT t.user_id, t.item_id, t.rating,
               COALESCE(ia.item_avg, (SELECT g FROM g)) AS prediction
             FROM {test} t LEFT JOIN ia ON ia.item_id = t.item_id)""",
        f"""{prefix}baseline AS (SELECT t.user_id, t.item_id, t.rating,
               CASE WHEN idev.dev IS NULL THEN {a} ELSE {denorm(a, 'idev.dev')} END AS prediction
             FROM {test} t LEFT JOIN ua ON ua.user_id = t.user_id LEFT JOIN idev ON idev.item_id = t.item_id)""",
    ]


def uniform(name: str = "p_uniform", test: str = "test") -> list[str]:
    """The mean deviation over the real pairs of the user and the item's other raters."""
    a = "COALESCE(ua.user_avg, (SELECT g FROM g))"
    d = "CASE WHEN ua.user_avg IS NULL THEN 0.0 ELSE COALESCE(s.d, 0.0) END"
    return [
        f"""{name}_s AS (SELECT t.user_id, t.item_id, AVG(o.dev) AS d FROM {test} t
             JOIN dev o ON o.item_id = t.item_id AND o.user_id <> t.user_id GROUP BY 1, 2)""",
        f"""{name} AS (SELECT t.user_id, t.item_id, t.rating, {denorm(a, d)} AS prediction
             FROM {test} t LEFT JOIN ua ON ua.user_id = t.user_id
             LEFT JOIN {name}_s s ON s.user_id = t.user_id AND s.item_id = t.item_id)""",
    ]


def edges_of(graph: str) -> str:
    return f"(SELECT user_id, neighbor_id, sim FROM {graph})"


def as_weights(edges: str) -> str:
    return f"(SELECT u AS user_id, v AS neighbor_id, sim FROM {edges})"


def bins(name: str, users: str, partitions: int, reps: str | int) -> list[str]:
    """(user_id, bin, bin_rank) for all bins, and ``name`` = (user_id, replication, bin)
    for the first ``reps`` draws (``reps`` an int or a one-column table ``replication``)."""
    reps_tbl = f"(SELECT CAST({reps} AS BIGINT) AS replication)" if isinstance(reps, int) else reps
    return [
        f"""{name}_all AS (SELECT user_id, bin,
               ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY md5(concat_ws('-', user_id, bin, {SEED}))) AS bin_rank
             FROM {users} CROSS JOIN (SELECT CAST(range AS BIGINT) AS bin FROM range(0, {partitions})))""",
        f"""{name} AS (SELECT b.user_id, r.replication, b.bin FROM {name}_all b JOIN {reps_tbl} r
             ON b.bin_rank <= r.replication)""",
        f"""{name}_cand AS (SELECT DISTINCT x.user_id AS u, y.user_id AS v, x.replication
             FROM {name} x JOIN {name} y ON x.bin = y.bin AND x.replication = y.replication
               AND y.user_id <> x.user_id)""",
        f"{name}_shared AS (SELECT u, v, replication FROM {name}_cand WHERE u < v)",
        f"""{name}_edges AS (SELECT p.u, p.v, p.sim, s.replication FROM cpairs p
               JOIN {name}_shared s ON s.u = p.u AND s.v = p.v WHERE ABS(p.sim) > 1e-12 * p.size
             UNION ALL SELECT p.v AS u, p.u AS v, p.sim, s.replication FROM cpairs p
               JOIN {name}_shared s ON s.u = p.u AND s.v = p.v WHERE ABS(p.sim) > 1e-12 * p.size)""",
    ]


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
