"""Feature propagation over the user-item graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortlist.plans.ordering import global_row_number
from shortlist.plans.skew import lookup
from shortlist.session import durable


def known_edges(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Log rows whose user and item both exist."""
    out = lookup(log, users.select("user_idx"), "user_idx")
    return lookup(out, items.select("item_idx"), "item_idx")


def node_ids(users: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dense node numbers: users first, then items, each in key order."""
    u = global_row_number(users.select("user_idx"), [F.col("user_idx").asc()], "node")
    i = global_row_number(items.select("item_idx"), [F.col("item_idx").asc()], "node")
    n_users = users.agg(F.count(F.lit(1))).scalar()
    return u.withColumn("node", F.col("node") - 1), i.withColumn("node", F.col("node") - 1 + n_users)


def stored_node_ids(users: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same, numbered once for all later reads."""
    u, i = node_ids(users, items)
    return durable(u), durable(i)


def edges(log: DataFrame, users: DataFrame, items: DataFrame, ids: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Distinct edges (src, dst, w): w is the relevance summed over repeated rows."""
    pairs = log.groupBy("user_idx", "item_idx").agg(F.sum("relevance").cast("double").alias("w"))
    u, i = ids or node_ids(users, items)
    pairs = durable(pairs)  # read by the joins and for the heavy keys of both
    out = lookup(pairs, u.withColumnRenamed("node", "src"), "user_idx", dim_rows=users, heavy_in=pairs)
    out = lookup(out, i.withColumnRenamed("node", "dst"), "item_idx", dim_rows=items, heavy_in=pairs)
    return out.select("src", "dst", "w")


def reversed_too(e: DataFrame) -> DataFrame:
    return e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))


def propagate(nodes: DataFrame, e: DataFrame, columns: list[str], hops: int = 1) -> DataFrame:
    """``hops`` rounds of normalized neighbour sums.

    With deg(v) = 1 + incoming weight, a hop maps x(v) to
    x(v) / deg(v) + sum over edges u -> v of w x(u) / sqrt(deg(u) deg(v)).
    Feature sums are separate columns, so every task combines its edges before the shuffle. A hop
    that another one follows is stored: each reads the one before it twice.
    """
    incoming = e.groupBy(F.col("dst").alias("node")).agg(F.sum("w").alias("w"))
    degree = nodes.select("node").join(incoming, "node", "left").select("node", (1.0 + F.coalesce("w", F.lit(0.0))).alias("deg"))
    out = durable(nodes.select("node", *columns).join(degree, "node"))
    for hop in range(hops):
        source = out.select(F.col("node").alias("src"), *[(F.col(c) / F.sqrt("deg")).alias(c) for c in columns])
        sent = lookup(e, source, "src", dim_rows=nodes)
        got = sent.groupBy(F.col("dst").alias("node")).agg(*[F.sum(F.col("w") * F.col(c)).alias(f"_{c}") for c in columns])
        out = out.join(got, "node", "left").select(
            "node", "deg",
            *[(F.col(c) / F.col("deg") + F.coalesce(f"_{c}", F.lit(0.0)) / F.sqrt("deg")).alias(c) for c in columns],
        )
        if hop + 1 < hops:
            out = durable(out)
    return out.select("node", *columns)
