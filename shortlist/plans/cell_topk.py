"""Per-user top-k when the score depends on a user class and an item class only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shortlist.plans.ordering import global_row_number
from shortlist.plans.skew import lookup
from shortlist.plans.topk import drop_seen, ranked_prefix, topk_per_user


def cell_topk(users: DataFrame, items: DataFrame, scores: DataFrame, log: DataFrame | None, k: int) -> DataFrame:
    """``users`` (user_idx, ucell), ``items`` (item_idx, icell), ``scores`` (ucell, icell, relevance).

    Within a user class, item classes are ordered by score and items of a class by key, both
    descending. A user needs the first k + (own history size) places only, so the work is linear
    in the log, whatever the size of the catalogue.
    """
    sizes = items.groupBy("icell").agg(F.count(F.lit(1)).alias("n"))
    placed = global_row_number(items, [F.col("icell").asc(), F.col("item_idx").desc()], "_place")
    first = placed.groupBy("icell").agg(F.min("_place").alias("_first"))
    placed = lookup(placed, first, "icell").select("item_idx", "icell", (F.col("_place") - F.col("_first") + 1).alias("_in_cell"))

    if log is None:
        depths = users.withColumn("depth", F.lit(k).cast("long"))
    else:
        seen = log.select("user_idx", "item_idx").join(items.select("item_idx"), "item_idx", "left_semi")
        taken = seen.groupBy("user_idx").agg(F.count_distinct("item_idx").alias("h"))
        depths = users.join(taken, "user_idx", "left").select("user_idx", "ucell", (F.coalesce("h", F.lit(0)) + k).alias("depth"))
    deepest = depths.groupBy("ucell").agg(F.max("depth").alias("deepest"))

    order = Window.partitionBy("ucell").orderBy(F.col("relevance").desc(), F.col("icell").desc())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)  # one row per item class
    opened = (
        scores.join(sizes, "icell")
        .withColumn("_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(deepest, "ucell")
        .filter(F.col("_before") < F.col("deepest"))
    )
    ranked = placed.join(opened, "icell").withColumn("rank", F.col("_before") + F.col("_in_cell"))
    ranked = ranked.filter(F.col("rank") <= F.col("deepest")).select("ucell", "item_idx", "relevance", "rank")
    rows = ranked_prefix(depths, ranked, ["ucell"])
    if log is not None:
        rows = drop_seen(rows, log)
    return topk_per_user(rows.withColumnRenamed("rank", "_rank"), k, order=[F.col("_rank").asc()]).drop("_rank")
