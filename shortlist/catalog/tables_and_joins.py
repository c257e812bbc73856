"""Tables, the stored log, projections, joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shortlist.catalog.base import K, SEED, VIEWS, query, with_views
from shortlist.functions.randomness import uniform_sql
from shortlist.operators import features as feat
from shortlist.operators import graph, popularity as pop, recommend as rec
from shortlist.operators.response import with_features
from shortlist.plans.skew import lookup
from shortlist.plans.topk import drop_seen
from shortlist.session import shared_dir
from shortlist.sources import tables as tb
from shortlist.sources.log import IterationLog, user_log
from shortlist.sources.tables import LAST_TRAIN_YEAR

N_CANDIDATES = 20
LOG_COLUMNS = "user_idx, item_idx, relevance, revenue"


def stored_log(spark, d) -> IterationLog:
    """The interactions written as an iteration log: the training years, then the later ones."""
    log = IterationLog(spark, f"{shared_dir(spark)}/log-{uuid.uuid4().hex}")
    rows = tb.interactions(spark, d)
    body = [c.strip() for c in LOG_COLUMNS.split(",")]
    log.append(rows.filter(F.col("iter") <= LAST_TRAIN_YEAR).select(*body), "train_0")
    log.append(rows.filter(F.col("iter") > LAST_TRAIN_YEAR).select(*body), "test_0")
    return log


_LABELLED = f"SELECT {LOG_COLUMNS}, CASE WHEN iter <= {LAST_TRAIN_YEAR} THEN 'train_0' ELSE 'test_0' END AS __iter FROM log"


@query("log_append_union", with_views(["log"], _LABELLED))
def log_append_union(spark, d):
    return stored_log(spark, d).read()


@query("log_iteration_scan", with_views(["log"], f"SELECT * FROM ({_LABELLED}) WHERE __iter = 'test_0'"))
def log_iteration_scan(spark, d):
    return stored_log(spark, d).read("test_0")


@query(
    "iteration_split_eval",
    with_views(
        ["log", "users", "items"],
        f"""SELECT iter, count(*) AS n, sum(relevance)::BIGINT AS pos, round(avg(p.relevance_fit), 9) AS mean_score
            FROM (SELECT * FROM log WHERE iter > {LAST_TRAIN_YEAR}) t
            LEFT JOIN (SELECT item_idx, coalesce((pos + 1.0) / (total + 2.0), 0.5) AS relevance_fit
                       FROM items LEFT JOIN (SELECT item_idx, sum(relevance)::BIGINT AS pos, count(relevance) AS total
                                             FROM log WHERE iter <= {LAST_TRAIN_YEAR} GROUP BY item_idx) USING (item_idx)) p
            USING (item_idx) GROUP BY iter""",
    ),
)
def iteration_split_eval(spark, d):
    """Popularity fitted on the training iterations only, averaged over each test iteration."""
    log, items = tb.interactions(spark, d), tb.items(spark, d)
    fitted = pop.popularity_table(log.filter(F.col("iter") <= LAST_TRAIN_YEAR), items)
    test = log.filter(F.col("iter") > LAST_TRAIN_YEAR).groupBy("iter", "item_idx").agg(
        F.count(F.lit(1)).alias("n"), F.sum("relevance").alias("pos")
    )
    scored = test.join(fitted, "item_idx", "left")
    return scored.groupBy("iter").agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos"),
        F.round(F.sum(F.col("n") * F.col("relevance")) / F.sum("n"), 9).alias("mean_score"),
    )


@query(
    "prefixed_features",
    with_views(
        ["log", "users", "items"],
        """SELECT user_idx, item_idx, relevance, segment AS u_segment, income AS u_income, category AS i_category,
                  price AS i_price, size AS i_size, brand AS i_brand
           FROM log JOIN users USING (user_idx) JOIN items USING (item_idx)""",
    ),
)
def prefixed_features(spark, d):
    log = tb.interactions(spark, d).select("user_idx", "item_idx", "relevance")
    out = lookup(log, feat.prefixed(tb.users(spark, d), "u_", "user_idx"), "user_idx")
    return lookup(out, feat.prefixed(tb.items(spark, d), "i_", "item_idx"), "item_idx")


@query(
    "segment_filter",
    with_views(["users"], "SELECT user_idx, income FROM users WHERE segment = 'MACHINERY'"),
)
def segment_filter(spark, d):
    return tb.users(spark, d).filter(F.col("segment") == "MACHINERY").select("user_idx", "income")


@query(
    "binarize_log",
    "SELECT l_orderkey, l_linenumber, l_partkey AS item_idx, CASE WHEN l_discount - 0.05 > 0 THEN 1 ELSE 0 END AS relevance FROM lineitem",
)
def binarize_log(spark, d):
    lines = tb.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("item_idx"), (F.col("l_discount") - 0.05).alias("relevance")
    )
    return feat.binarized(lines)


@query(
    "label_violations",
    "SELECT l_partkey AS item_idx, l_linenumber AS relevance FROM lineitem WHERE l_linenumber <> 0 AND l_linenumber <> 1",
)
def label_violations(spark, d):
    lines = tb.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("item_idx"), F.col("l_linenumber").alias("relevance")
    )
    return pop.label_violations(lines)


@query(
    "truncated_log",
    """SELECT o_custkey AS user_idx, l_partkey AS item_idx, trunc(l_quantity * l_discount - 1.0)::BIGINT AS relevance
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def truncated_log(spark, d):
    orders = tb.table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user_idx"))
    lines = tb.table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("item_idx"), (F.col("l_quantity") * F.col("l_discount") - 1.0).alias("relevance")
    )
    return feat.truncated_log(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")))


@query("labelled_ids", "SELECT 'customer_' || i AS user_idx FROM range((SELECT count(*) FROM customer)) t(i)")
def labelled_ids(spark, d):
    return tb.labelled_ids(spark, tb.table(spark, d, "customer").count(), "customer")


@query(
    "renamed_keys",
    "SELECT o_custkey AS user_idx, o_orderkey AS item_idx, o_totalprice AS relevance FROM orders",
)
def renamed_keys(spark, d):
    orders = tb.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return orders.withColumnsRenamed({"o_custkey": "user_idx", "o_orderkey": "item_idx", "o_totalprice": "relevance"})


VIEWS["edges"] = (
    ("log", "users", "items"),
    """SELECT u.node AS src, i.node AS dst, sum(relevance)::DOUBLE AS w FROM log
       JOIN (SELECT user_idx, row_number() OVER (ORDER BY user_idx) - 1 AS node FROM users) u USING (user_idx)
       JOIN (SELECT item_idx, row_number() OVER (ORDER BY item_idx) - 1 + (SELECT count(*) FROM users) AS node FROM items) i
       USING (item_idx) GROUP BY 1, 2""",
)


@query("edge_mask_node_ids", with_views(["edges"], "SELECT src, dst, w FROM edges"))
def edge_mask_node_ids(spark, d):
    return graph.edges(tb.interactions(spark, d), tb.users(spark, d), tb.items(spark, d))


@query(
    "aligned_features",
    """SELECT coalesce(o_orderpriority, 'missing') AS o_orderpriority, 'missing' AS channel,
              coalesce(try_cast(left(o_orderpriority, 1) AS DOUBLE), 0.0) AS level, o_totalprice, 0.0::DOUBLE AS margin FROM orders""",
)
def aligned_features(spark, d):
    orders = tb.table(spark, d, "orders").withColumn("level", F.substring("o_orderpriority", 1, 1))
    return feat.aligned(orders, ["o_orderpriority", "channel"], ["level", "o_totalprice", "margin"])


@query(
    "user_log_semi",
    with_views(["log", "users"], "SELECT user_idx, item_idx, relevance FROM log WHERE user_idx IN (SELECT user_idx FROM users WHERE segment = 'BUILDING')"),
)
def user_log_semi(spark, d):
    wanted = tb.users(spark, d).filter(F.col("segment") == "BUILDING")
    return user_log(tb.interactions(spark, d).select("user_idx", "item_idx", "relevance"), wanted)


@query(
    "recs_with_features",
    with_views(["with_features"], "SELECT user_idx, item_idx, relevance, rank, segment, income, category, price, size, brand FROM with_features"),
)
def recs_with_features(spark, d):
    return with_features(ucb_recs(spark, d), tb.users(spark, d), tb.items(spark, d))


def ucb_recs(spark, d):
    return rec.ucb(tb.interactions(spark, d), tb.users(spark, d), tb.items(spark, d), K)


@query(
    "catalog_popularity",
    with_views(
        ["items"],
        """SELECT item_idx, round(coalesce((pos + 1.0) / (total + 2.0), 0.5), 9) AS relevance FROM items LEFT JOIN (
             SELECT l_partkey AS item_idx, sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END)::BIGINT AS pos, count(*) AS total
             FROM lineitem GROUP BY 1) USING (item_idx)""",
    ),
)
def catalog_popularity(spark, d):
    """Every item of the catalogue; one without a line gets the neutral score."""
    lines = tb.table(spark, d, "lineitem").select(F.col("l_partkey").alias("item_idx"), tb.kept("l_returnflag").alias("relevance"))
    return pop.popularity_table(lines, tb.items(spark, d)).withColumn("relevance", F.round("relevance", 9))


_U_ITEM = uniform_sql(SEED, "item_idx")
VIEWS["chosen"] = (("items",), f"SELECT item_idx FROM items ORDER BY {_U_ITEM}, item_idx LIMIT {N_CANDIDATES}")
VIEWS["candidates"] = (("users", "chosen"), "SELECT user_idx, item_idx FROM users CROSS JOIN chosen")


@query("candidates_random_k", with_views(["candidates"], "SELECT * FROM candidates"))
def candidates_random_k(spark, d):
    return rec.random_candidates(tb.users(spark, d), tb.items(spark, d), N_CANDIDATES, SEED)


@query(
    "unseen_pairs",
    with_views(["candidates", "seen"], "SELECT user_idx, item_idx FROM candidates ANTI JOIN seen USING (user_idx, item_idx)"),
)
def unseen_pairs(spark, d):
    return drop_seen(candidates_random_k(spark, d), tb.interactions(spark, d))


@query(
    "user_items_and_log",
    with_views(
        ["candidates", "log"],
        """SELECT user_idx, item_idx, count(relevance) AS n, coalesce(sum(relevance), 0)::BIGINT AS pos
           FROM candidates LEFT JOIN log USING (user_idx, item_idx) GROUP BY 1, 2""",
    ),
)
def user_items_and_log(spark, d):
    """The two tables of the selector, shown together: what each user did with the candidates."""
    pairs, log = rec.user_items_and_log(tb.users(spark, d), tb.items(spark, d), tb.interactions(spark, d), N_CANDIDATES, SEED)
    done = log.groupBy("user_idx", "item_idx").agg(F.count("relevance").alias("n"), F.sum("relevance").alias("pos"))
    return pairs.join(done, ["user_idx", "item_idx"], "left").fillna(0, ["n", "pos"])


@query("category_join", with_views(
    ["log", "items"], "SELECT user_idx, item_idx, relevance, category FROM log JOIN items USING (item_idx)"))
def category_join(spark, d):
    log = tb.interactions(spark, d).select("user_idx", "item_idx", "relevance")
    return lookup(log, tb.items(spark, d).select("item_idx", "category"), "item_idx")
