"""Best items per query where a query only meets the items of its own group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortlist.plans.skew import lookup
from shortlist.plans.topk import topk_per_user
from shortlist.plans.vector_topk import BLOCK_ITEMS, SLOT_QUERIES, best_of_block


def grouped_vector_topk(
    queries: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None,
    block_items: int = BLOCK_ITEMS, slot_queries: int = SLOT_QUERIES,
) -> DataFrame:
    """Inner-product top-k of (user_idx, group, vec) over (group, item_idx, vec).

    A group's items are cut into blocks and its queries into slots of bounded size, so a group
    that holds a large share of either side becomes many tasks, each returning k rows per query.
    """
    sizes = items.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block_items).cast("int").alias("blocks"))
    crowd = queries.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / slot_queries).cast("int").alias("slots"))
    shape = sizes.join(crowd, "group")  # one row per group present on both sides
    to = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    block = F.pmod(F.xxhash64("item_idx"), F.col("blocks")).cast("int").alias("block")
    slot = F.pmod(F.xxhash64("user_idx"), F.col("slots")).cast("int").alias("slot")
    item_type = items.schema["item_idx"].dataType

    shaped = lookup(queries, shape, "group")
    left = shaped.select(
        F.col("user_idx").alias("qid"), "vec", F.lit(float("-inf")).alias("bound"), F.lit(None).cast(item_type).alias("item"), "group", to("blocks").alias("block"), slot
    )
    if seen is not None:
        # pairs are hashed by both keys; the group comes along from the query side
        marks = lookup(seen.select("user_idx", "item_idx"), queries.select("user_idx", "group"), "user_idx")
        marks = marks.join(items.select("group", "item_idx"), ["group", "item_idx"], "left_semi")
        marks = lookup(marks, shape, "group").select(
            F.col("user_idx").alias("qid"), F.lit(None).cast("array<double>").alias("vec"), F.lit(None).cast("double").alias("bound"), F.col("item_idx").alias("item"), "group", block, slot
        )
        left = left.unionByName(marks)
    right = lookup(items, shape, "group").select(
        F.col("item_idx").alias("item"), "vec", "group", block, to("slots").alias("slot")
    )
    schema = T.StructType([
        T.StructField("qid", queries.schema["user_idx"].dataType), T.StructField("item", item_type), T.StructField("score", T.DoubleType()),
    ])
    keys = ["group", "block", "slot"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(best_of_block(k, "dot", None), schema)
    ranked = topk_per_user(best, k, "qid", [F.col("score").desc(), F.col("item").desc()])
    return ranked.select(F.col("qid").alias("user_idx"), F.col("item").alias("item_idx"), "score", "rank")
