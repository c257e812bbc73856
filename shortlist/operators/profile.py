"""Profiles of users and data sets: the tables behind an exploration report."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortlist.operators.metrics import bin_number
from shortlist.plans.skew import BROADCAST_ROWS, is_small, lookup, spread, spread_join

GOOD_LENGTH, GOOD_SHARE = 2.5, 30.0
FAIR_LENGTH, FAIR_SHARE = 2.0, 20.0


def per_key_counts(log: DataFrame, key: str) -> DataFrame:
    return log.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def log_statistics(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows, distinct users and items, and sequence lengths, optionally per group."""
    by = by or []
    lengths = log.groupBy(*by, "user_idx").agg(F.count(F.lit(1)).alias("n"))
    users = lengths.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_interactions"),
        F.count(F.lit(1)).alias("unique_users"),
        F.coalesce(F.avg("n"), F.lit(0.0)).alias("avg_interactions_per_user"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_interactions_per_user"),
        F.count(F.when(F.col("n") > 1, 1)).alias("users_with_multiple"),
    )
    pct = F.when(F.col("unique_users") > 0, F.col("users_with_multiple") / F.col("unique_users") * 100).otherwise(0.0)
    users = users.withColumn("pct_users_with_multiple", pct)
    items = log.groupBy(*by).agg(F.count_distinct("item_idx").alias("unique_items"))
    if by:
        return users.join(items, by)
    return users.withColumn("unique_items", items.scalar())


def sequence_lengths(log: DataFrame) -> DataFrame:
    return per_key_counts(log, "user_idx").groupBy(F.col("n").alias("length")).agg(F.count(F.lit(1)).alias("users"))


def share_pct(df: DataFrame, group: str) -> DataFrame:
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / counts.agg(F.sum("n")).scalar())


def coverage(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    n_users, n_items = users.agg(F.count(F.lit(1))).scalar(), items.agg(F.count(F.lit(1))).scalar()
    return log.agg(
        F.count(F.lit(1)).alias("interactions"),
        F.count_distinct("user_idx").alias("active_users"),
        F.count_distinct("item_idx").alias("active_items"),
    ).select(
        "interactions", "active_users", "active_items",
        (F.col("interactions") * 100.0 / (n_users * n_items)).alias("density_pct"),
        (F.col("active_users") * 100.0 / n_users).alias("user_coverage_pct"),
        (F.col("active_items") * 100.0 / n_items).alias("item_coverage_pct"),
    )


def interactions_distribution(log: DataFrame) -> DataFrame:
    """How many users and how many items have n interactions."""
    parts = [
        per_key_counts(log, key).groupBy("n").agg(F.count(F.lit(1)).alias("keys")).select(F.lit(side).alias("side"), "n", "keys")
        for side, key in (("user", "user_idx"), ("item", "item_idx"))
    ]
    return parts[0].unionByName(parts[1])


def relevance_distribution(log: DataFrame) -> DataFrame:
    return log.groupBy("relevance").agg(F.count(F.lit(1)).alias("n"))


def segment_category_counts(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    out = lookup(log.select("user_idx", "item_idx"), users.select("user_idx", "segment"), "user_idx")
    out = lookup(out, items.select("item_idx", "category"), "item_idx")
    return out.groupBy("segment", "category").agg(F.count(F.lit(1)).alias("n"))


def segment_category_pivot(log: DataFrame, users: DataFrame, items: DataFrame, categories: list[str]) -> DataFrame:
    counts = segment_category_counts(log, users, items)
    return counts.groupBy("segment").pivot("category", categories).agg(F.sum("n")).fillna(0)


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width counts between the column's least and greatest value, empty bins left out."""
    low, high = df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()
    keyed = df.select(*([by] if by else []), bin_number(F.col(column), low, high, bins).alias("bin"))
    return keyed.filter(F.col("bin").isNotNull()).groupBy(*([by] if by else []), "bin").agg(F.count(F.lit(1)).alias("n"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise Pearson correlation in one pass, long form with a <= b in the given order."""
    pairs = [(c, c) for c in columns] + list(combinations(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    named = row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{i}`").alias("corr")) for i, (a, b) in enumerate(pairs)
    ])).alias("r"))
    return named.select("r.a", "r.b", "r.corr")


def leaderboard(rows: DataFrame) -> DataFrame:
    """One row per model from (model, phase, metric, value, iter) rows, best test revenue first.

    ``phase`` is train or test.
    """
    metrics = rows.filter(F.col("metric") != "total_revenue")
    names = [r[0] for r in metrics.select("metric").distinct().orderBy("metric").collect()]
    phases = ["train", "test"]
    revenue = F.when(F.col("metric") == "total_revenue", F.col("value"))
    wide = rows.groupBy("model").agg(
        *[F.sum(F.when(F.col("phase") == p, revenue)).alias(f"{p}_total_revenue") for p in phases],
        *[F.avg(F.when(F.col("phase") == p, revenue)).alias(f"{p}_avg_revenue") for p in phases],
        *[
            F.avg(F.when((F.col("phase") == p) & (F.col("metric") == m), F.col("value"))).alias(f"{p}_{m}")
            for p in phases
            for m in names
        ],
    )
    # null for a model without train revenue
    change = (F.try_divide(F.col("test_avg_revenue"), F.col("train_avg_revenue")) - 1) * 100
    return wide.withColumn("change_pct", change).orderBy(F.col("test_total_revenue").desc(), "model")


def suitability(stats: DataFrame) -> DataFrame:
    """Label a configuration by its sequence lengths, and its score for picking the best one."""
    length, share = F.col("avg_interactions_per_user"), F.col("pct_users_with_multiple")
    label = (
        F.when((length >= GOOD_LENGTH) & (share >= GOOD_SHARE), "Good")
        .when((length >= FAIR_LENGTH) & (share >= FAIR_SHARE), "Moderate")
        .otherwise("Poor")
    )
    return stats.withColumns({"label": label, "score": length * share / 100})


def best_configuration(stats: DataFrame, name: str) -> DataFrame:
    scored = suitability(stats).filter(F.col("score") > 0)
    return scored.agg(F.max_by(name, F.struct("score", name)).alias("best"))


def category_preferences(log: DataFrame, items: DataFrame, key: str = "user_idx") -> DataFrame:
    joined = lookup(log.select(key) if key == "item_idx" else log.select(key, "item_idx"), items.select("item_idx", "category"), "item_idx")
    return joined.groupBy(key, "category").agg(F.count(F.lit(1)).alias("n"))


def user_profiles(log: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """Relevance-weighted mean item vector per user; zeros when the weights do not add up to more than 0.

    Sums are kept per dimension, so each task combines its rows before the shuffle.
    """
    rows = spread(log.select("user_idx", "item_idx", "relevance"))
    # vectors are wide, so fewer of them may be broadcast
    if is_small(vectors, BROADCAST_ROWS // dim):
        joined = rows.join(F.broadcast(vectors), "item_idx")
    else:
        joined = spread_join(rows, vectors, "item_idx")
    weight = F.col("relevance").cast("double")
    sums = joined.groupBy("user_idx").agg(
        F.count(F.lit(1)).alias("interactions"),
        F.sum(weight).alias("weight"),
        *[F.sum(weight * F.get("vec", F.lit(d))).alias(f"_{d}") for d in range(dim)],
    )
    profile = F.array(*[
        F.when(F.col("weight") > 0, F.col(f"_{d}") / F.col("weight")).otherwise(F.lit(0.0)) for d in range(dim)
    ])
    return sums.select("user_idx", "interactions", "weight", profile.alias("vec"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
