"""Ordered user histories: contexts, next-item counts, padded sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortlist.plans.ordering import BLOCK, all_present, positions, previous
from shortlist.plans.skew import heavy_keys, lookup
from shortlist.session import durable


class Sequences:
    """Positions of a log computed once, and what is read off them."""

    def __init__(self, log: DataFrame, order: list[str], slice_by, user: str = "user_idx", item: str = "item_idx", heavy: list | None = None, block: int = BLOCK):
        self.user, self.item, self.block = user, item, block
        self.heavy = heavy_keys(log, user) if heavy is None else heavy
        self.rows = positions(log, user, order, slice_by, "pos", self.heavy, "length")

    def stored(self) -> "Sequences":
        """Keep only user, item and position, written once for several uses."""
        self.rows = durable(self.rows.select(self.user, self.item, "pos", "length"))
        return self

    def contexts(self, n: int) -> DataFrame:
        """Rows that have n earlier items, with ``prev_n .. prev_1`` (oldest first)."""
        out = previous(self.rows, self.user, "pos", self.item, n, self.heavy, self.block)
        return out.filter(all_present([f"prev_{j}" for j in range(1, n + 1)]))

    def ngrams(self, n: int) -> DataFrame:
        """context array, next item, count."""
        context = F.array(*[f"prev_{j}" for j in range(n, 0, -1)]).alias("context")
        return self.contexts(n).groupBy(context, F.col(self.item).alias("item_idx")).agg(F.count(F.lit(1)).alias("n"))

    def next_items(self, n: int) -> DataFrame:
        """Counts of items that follow some full context."""
        rows = self.rows.filter(F.col("pos") > n)
        return rows.groupBy(F.col(self.item).alias("item_idx")).agg(F.count(F.lit(1)).alias("n"))

    def last_contexts(self, n: int) -> DataFrame:
        """The last n items of each user who has that many, oldest first."""
        tail = self.rows.filter((F.col("length") >= n) & (F.col("pos") > F.col("length") - n))
        pairs = F.sort_array(F.collect_list(F.struct("pos", self.item)))  # n rows per user
        return tail.groupBy(self.user).agg(F.transform(pairs, lambda p: p[self.item]).alias("context"))

    def padded(self, length: int, pad: int = 0) -> DataFrame:
        """The last ``length`` items of each user, padded on the left, with the true length."""
        tail = self.rows.filter(F.col("pos") > F.col("length") - length)
        items = F.transform(F.sort_array(F.collect_list(F.struct("pos", self.item))), lambda p: p[self.item])
        out = tail.groupBy(self.user).agg(items.alias("items"), F.max("length").alias("length"))
        fill = F.array_repeat(F.lit(pad).cast("long"), F.lit(length) - F.size("items"))
        return out.select(self.user, F.concat(fill, "items").alias("sequence"), "length")


def category_scores(preferences: DataFrame, smoothing: float) -> DataFrame:
    """Smoothed share of each category in a user's history: at most one row per (user, category)."""
    totals = preferences.groupBy("user_idx").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    share = (F.col("n") + smoothing) / (F.col("total") + smoothing * F.col("kinds"))
    return lookup(preferences, totals, "user_idx").select("user_idx", "category", share.alias("score"))
