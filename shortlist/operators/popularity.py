"""Item statistics and the scores built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXPLORATION = 2.0
SMOOTHING = 1.0
NEUTRAL = 0.5


def label_violations(log: DataFrame) -> DataFrame:
    """Rows whose relevance is neither 0 nor 1; a null label is not one of them."""
    return log.filter(~F.col("relevance").isin(0, 1))


def check_labels(log: DataFrame) -> None:
    if not label_violations(log).isEmpty():
        raise ValueError("relevance must be 0 or 1")


def item_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("item_idx").agg(F.sum("relevance").alias("pos"), F.count("relevance").alias("total"))


def smoothed_popularity(counts: DataFrame, alpha: float = SMOOTHING) -> DataFrame:
    share = (F.col("pos") + alpha) / (F.col("total") + 2 * alpha)
    return counts.select("item_idx", share.alias("relevance"))


def log_size(counts: DataFrame) -> Column:
    """Rows of the log, from its per-item counts: the log is not read again."""
    return counts.agg(F.sum("total")).scalar()


def ucb_scores(counts: DataFrame, coef: float = EXPLORATION) -> DataFrame:
    """Success share plus a bonus that shrinks with the number of trials."""
    bonus = F.sqrt(F.log(coef * log_size(counts)) / F.col("total"))
    return counts.select("item_idx", "pos", "total", (F.col("pos") / F.col("total") + bonus).alias("relevance"))


def ucb_fill(counts: DataFrame, coef: float = EXPLORATION) -> Column:
    """Score of an item nobody has tried; 1 if there is no log at all."""
    return F.coalesce(1.0 + F.sqrt(F.log(coef * log_size(counts))), F.lit(1.0))


def catalog_scores(items: DataFrame, scores: DataFrame, fill: Column) -> DataFrame:
    """Scores for every item of the catalogue."""
    joined = items.join(scores.select("item_idx", "relevance"), "item_idx", "left")
    return joined.withColumn("relevance", F.coalesce("relevance", fill))


def score_share(scores: DataFrame, column: str = "relevance") -> DataFrame:
    return scores.withColumn("probability", F.col(column) / scores.agg(F.sum(column)).scalar())


def history_sizes(log: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct items per user, 0 for a user without history."""
    sizes = log.groupBy("user_idx").agg(F.count_distinct("item_idx").alias("items"))
    return users.select("user_idx").join(sizes, "user_idx", "left").fillna(0, ["items"])


def max_history(log: DataFrame, users: DataFrame) -> DataFrame:
    return history_sizes(log, users).agg(F.coalesce(F.max("items"), F.lit(0)).alias("max_items"))


def popularity_table(log: DataFrame, items: DataFrame, alpha: float = SMOOTHING) -> DataFrame:
    return catalog_scores(items.select("item_idx"), smoothed_popularity(item_counts(log), alpha), F.lit(NEUTRAL))


def ucb_table(log: DataFrame, items: DataFrame, coef: float = EXPLORATION) -> DataFrame:
    """Bonus scores of the whole catalogue."""
    counts = item_counts(log)
    return catalog_scores(items.select("item_idx"), ucb_scores(counts, coef), ucb_fill(counts, coef))
