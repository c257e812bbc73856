"""Samples, splits, synthetic tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shortlist.catalog.base import SEED, query, with_views
from shortlist.functions.randomness import gamma_int_sql, normal_sql, uniform_sql
from shortlist.operators import profile as prof
from shortlist.operators import sampling as smp
from shortlist.sources import tables as tb

_U = uniform_sql(SEED, "o_orderkey")
_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice"]


def _orders(spark, d):
    return tb.table(spark, d, "orders").select(*_ORDER_COLUMNS)


@query("sample_fraction", f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {_U} < 0.1")
def sample_fraction(spark, d):
    return smp.fraction(_orders(spark, d), 0.1, SEED, ["o_orderkey"])


@query("sample_exact_n", f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY {_U}, o_orderkey LIMIT 500")
def sample_exact_n(spark, d):
    return smp.generate(_orders(spark, d), 500, SEED, ["o_orderkey"])


@query("sample_capped", f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY {_U}, o_orderkey LIMIT 1000")
def sample_capped(spark, d):
    return smp.capped(_orders(spark, d), 1000, SEED, ["o_orderkey"])


@query(
    "composite_sample",
    f"""WITH a AS (SELECT c_custkey AS id, 'customer' AS label FROM customer),
             s AS (SELECT s_suppkey AS id, 'supplier' AS label FROM supplier),
             n AS (SELECT (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM s) AS ns)
        SELECT id, label FROM a, n WHERE {uniform_sql(f"{SEED}/0", "id")} < trunc((na + ns) * 0.2::DOUBLE * 0.9::DOUBLE) / na
        UNION ALL
        SELECT id, label FROM s, n WHERE {uniform_sql(f"{SEED}/1", "id")} < trunc((na + ns) * 0.2::DOUBLE * 0.1::DOUBLE) / ns""",
)
def composite_sample(spark, d):
    return _composite(spark, d, [0.9, 0.1]).sample(0.2, SEED)


def _composite(spark, d, weights=None):
    a = tb.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("label"))
    b = tb.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("label"))
    return smp.Composite([a, b], ["id"], weights)


@query(
    "composite_generate",
    f"""(SELECT c_custkey AS id, 'customer' AS label FROM customer ORDER BY {uniform_sql(f"{SEED}/0", "c_custkey")}, 1
         LIMIT (SELECT round_even(count(*) / 20 * 0.95::DOUBLE, 0)::BIGINT FROM customer))
        UNION ALL
        (SELECT s_suppkey AS id, 'supplier' AS label FROM supplier ORDER BY {uniform_sql(f"{SEED}/1", "s_suppkey")}, 1
         LIMIT (SELECT round_even(count(*) / 20 * 0.05::DOUBLE, 0)::BIGINT FROM customer))""",
)
def composite_generate(spark, d):
    """A twentieth of the customers' number, 95 to 5."""
    source = _composite(spark, d, [0.95, 0.05])
    parts = source.generate(source.sizes[0] // 20, SEED).sources
    return parts[0].unionByName(parts[1])


@query(
    "random_items",
    with_views(["items"], f"SELECT item_idx FROM items ORDER BY {uniform_sql(SEED, 'item_idx')}, item_idx LIMIT 50"),
)
def random_items(spark, d):
    return smp.exactly(tb.items(spark, d).select("item_idx"), 50, SEED, ["item_idx"])


@query("holdout_split", f"SELECT o_orderkey, {uniform_sql(SEED, 'o_orderkey')} < 0.25 AS is_test FROM orders")
def holdout_split(spark, d):
    return smp.holdout(tb.table(spark, d, "orders").select("o_orderkey"), 0.25, SEED, ["o_orderkey"])


@query(
    "stratified_folds",
    f"""SELECT o_orderkey, o_orderstatus,
               ((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_U}, o_orderkey) - 1) % 5)::INTEGER AS fold FROM orders""",
)
def stratified_folds(spark, d):
    return smp.stratified_folds(tb.table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", 5, SEED, ["o_orderkey"])


@query(
    "head_tail_split",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor((SELECT count(*) FROM orders) * 0.8) AS is_train
       FROM orders""",
)
def head_tail_split(spark, d):
    orders = tb.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return smp.head_tail(orders, 0.8, [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


# fixed values: mixture shares and means of the synthetic tables
USER_MIX = [("budget", 0.3, -0.5), ("mainstream", 0.5, 0.0), ("premium", 0.2, 0.5)]
ITEM_MIX = [("electronics", 0.2, 0.3), ("books", 0.3, -0.3), ("clothing", 0.3, 0.0), ("home", 0.2, 0.2)]
DIMS, DENSITY = 4, 0.01


def _mix_sql(table: str, key: str, group: str, prefix: str, mix, extra: str = "") -> str:
    cases, means, upto = [], [], "0"
    for i, (g, share, mean) in enumerate(mix):
        upto = f"{upto} + trunc({share}::DOUBLE * n)" if i < len(mix) - 1 else "n"
        cases.append(f"WHEN {key} < {upto} THEN '{g}'")
        means.append(f"WHEN {key} < {upto} THEN {mean}::DOUBLE")
    m = f"(CASE {' '.join(means)} END)"
    attrs = ", ".join(
        f"round({m} + {normal_sql(f'{SEED}/{prefix}{k}', key)}, 9) AS {prefix}{k}" for k in range(DIMS)
    )
    return (
        f"SELECT {key}, CASE {' '.join(cases)} END AS {group}, {attrs}{extra} "
        f"FROM (SELECT i AS {key} FROM range((SELECT count(*) FROM {table})) t(i)), (SELECT count(*) AS n FROM {table})"
    )


_USERS_SQL = _mix_sql("customer", "user_idx", "segment", "user_attr_", USER_MIX)
_PRICE = f", round({gamma_int_sql(f'{SEED}/price', 'item_idx', shape=5, scale=10.0)}, 9) AS price"
_ITEMS_SQL = _mix_sql("part", "item_idx", "category", "item_attr_", ITEM_MIX, _PRICE)


def _rounded(df):
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def make_users(spark, d):
    """As many users as there are customers."""
    return smp.synthetic_users(spark, tb.table(spark, d, "customer").count(), DIMS, USER_MIX, SEED)


def make_items(spark, d):
    return smp.synthetic_items(spark, tb.table(spark, d, "part").count(), DIMS, ITEM_MIX, SEED)


@query("synthetic_users", _USERS_SQL)
def synthetic_users(spark, d):
    return _rounded(make_users(spark, d))


@query("synthetic_items", _ITEMS_SQL)
def synthetic_items(spark, d):
    return _rounded(make_items(spark, d))


@query(
    "synthetic_history",
    f"""WITH u AS ({_USERS_SQL}), i AS ({_ITEMS_SQL}),
        n AS (SELECT (SELECT count(*) FROM u) AS nu, (SELECT count(*) FROM i) AS ni),
        p AS (SELECT DISTINCT floor({uniform_sql(f'{SEED}/user', 'id')} * nu)::BIGINT AS user_idx,
                              floor({uniform_sql(f'{SEED}/item', 'id')} * ni)::BIGINT AS item_idx
              FROM range((SELECT trunc({DENSITY}::DOUBLE * nu * ni)::BIGINT FROM n)) t(id), n)
        SELECT user_idx, item_idx,
               CASE WHEN {' + '.join(f'user_attr_{k} * item_attr_{k}' for k in range(DIMS))} > 0 THEN 1 ELSE 0 END::BIGINT AS relevance
        FROM p JOIN u USING (user_idx) JOIN i USING (item_idx)""",
)
def synthetic_history(spark, d):
    n_users, n_items = tb.table(spark, d, "customer").count(), tb.table(spark, d, "part").count()
    return smp.synthetic_history(make_users(spark, d), make_items(spark, d), DENSITY, SEED, n_users, n_items)


@query("segment_tables_union", with_views(["users"], "SELECT user_idx, segment, income FROM users WHERE segment IS NOT NULL"))
def segment_tables_union(spark, d):
    """One table for each segment, bound by name whatever the order of their columns."""
    users = tb.users(spark, d)
    segments = sorted(r[0] for r in users.select("segment").distinct().collect() if r[0] is not None)  # five names
    tables = [users.filter(F.col("segment") == s) for s in segments]
    turned = [t.select("income", "segment", "user_idx") if i % 2 else t for i, t in enumerate(tables)]
    return prof.union_all(turned).select("user_idx", "segment", "income")


@query("distinct_pairs", with_views(["seen"], "SELECT user_idx, item_idx FROM seen"))
def distinct_pairs(spark, d):
    return tb.interactions(spark, d).select("user_idx", "item_idx").distinct()


@query(
    "first_of_pairs",
    with_views(["log"], "SELECT user_idx, item_idx, max(relevance) AS relevance FROM log GROUP BY 1, 2"),
)
def first_of_pairs(spark, d):
    """One row per pair; the kept row is fixed by taking the highest relevance, not the first seen."""
    return tb.interactions(spark, d).groupBy("user_idx", "item_idx").agg(F.max("relevance").alias("relevance"))
