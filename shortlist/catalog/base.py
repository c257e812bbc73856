"""Registry of the checkable queries and of the SQL views their oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shortlist.functions.randomness import normal_sql, uniform_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

K = 10
SEED = 7


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# name -> (views it reads, text)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "users": ((), "SELECT c_custkey AS user_idx, c_mktsegment AS segment, c_acctbal AS income FROM customer"),
    "items": (
        (),
        "SELECT p_partkey AS item_idx, p_type AS category, p_retailprice AS price, p_size AS size, p_brand AS brand FROM part",
    ),
    "log": (
        (),
        """SELECT o_custkey AS user_idx, l_partkey AS item_idx,
                  CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END::BIGINT AS relevance,
                  year(o_orderdate)::INTEGER AS iter, o_orderdate AS ts, l_orderkey, l_linenumber,
                  l_extendedprice AS revenue
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    ),
    "seen": (("log",), "SELECT DISTINCT user_idx, item_idx FROM log"),
    "counts": (
        ("log",),
        "SELECT item_idx, sum(relevance)::BIGINT AS pos, count(relevance) AS total FROM log GROUP BY item_idx",
    ),
    "ucb": (
        ("counts", "log"),
        "SELECT item_idx, pos, total, pos / total + sqrt(ln(2.0 * (SELECT count(*) FROM log)) / total) AS relevance FROM counts",
    ),
    "ucb_table": (
        ("items", "ucb", "log"),
        """SELECT item_idx, round(coalesce(ucb.relevance, 1.0 + sqrt(ln(2.0 * (SELECT count(*) FROM log)))), 9) AS relevance
           FROM items LEFT JOIN ucb USING (item_idx)""",
    ),
    "pop_table": (
        ("items", "counts"),
        """SELECT item_idx, round(coalesce((pos + 1.0) / (total + 2.0), 0.5), 9) AS relevance
           FROM items LEFT JOIN counts USING (item_idx)""",
    ),
    "history": (
        ("users", "seen"),
        "SELECT user_idx, count(item_idx) AS items FROM users LEFT JOIN seen USING (user_idx) GROUP BY user_idx",
    ),
    "vec": ((), "SELECT vec_id AS item_idx, embedding::DOUBLE[] AS vec FROM embeddings"),
    "seq": (
        ("log",),
        """SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY ts, l_orderkey, l_linenumber, item_idx) AS pos,
                  count(*) OVER (PARTITION BY user_idx) AS length FROM log""",
    ),
}


def topk_view(scores: str, k: int = K, seen: str = "seen", columns: str = "user_idx, item_idx, relevance") -> str:
    """Brute force: every unseen pair, ranked. ``scores`` has (user_idx,) item_idx, relevance."""
    return f"""SELECT {columns}, rank::INTEGER AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY relevance DESC, item_idx DESC) AS rank
        FROM ({scores}) s
        WHERE NOT EXISTS (SELECT 1 FROM {seen} x WHERE x.user_idx = s.user_idx AND x.item_idx = s.item_idx)
    ) WHERE rank <= {k}"""


VIEWS["recs"] = (
    ("users", "ucb_table", "seen"),
    topk_view("SELECT user_idx, item_idx, relevance FROM users CROSS JOIN ucb_table"),
)
VIEWS["with_features"] = (
    ("recs", "users", "items"),
    "SELECT * FROM recs LEFT JOIN users USING (user_idx) LEFT JOIN items USING (item_idx)",
)
_NOISE = normal_sql(f"{SEED}/__noisy_relevance", "user_idx", "item_idx", mean=0.1, std=0.05)
_U = uniform_sql(f"{SEED}/response", "user_idx", "item_idx")
# the flagship simulated outcome: relevance scaled to a probability, plus noise
VIEWS["responses"] = (
    ("with_features",),
    f"""SELECT *, response * price AS revenue FROM (
          SELECT *, CASE WHEN {_U} <= __noisy_relevance THEN 1 ELSE 0 END AS response FROM (
            SELECT *, greatest({_NOISE}, 0.0) AS __noisy_relevance FROM with_features))""",
)


def with_views(names: list[str], body: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        deps, _ = VIEWS[name]
        for d in deps:
            add(d)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order) + "\n" + body
