"""Recommenders compared on what users kept later: no simulated outcome takes part."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shortlist.operators.metrics import iteration_metrics
from shortlist.session import durable

#: a recommender: (log to fit on, users, items, k) -> lists (user_idx, item_idx, relevance, rank)
Recommender = Callable[[DataFrame, DataFrame, DataFrame, int], DataFrame]


@dataclass(frozen=True)
class Phase:
    """A model is fitted on the iterations up to ``fitted`` and judged on those after it, up to ``judged``."""

    name: str
    fitted: int
    judged: int | None = None

    def later(self, column: Column) -> Column:
        return column > self.fitted if self.judged is None else (column > self.fitted) & (column <= self.judged)


def lists_of(models: dict[str, Recommender], log: DataFrame, users: DataFrame, items: DataFrame, k: int, phases: list[Phase]) -> DataFrame:
    """(phase, model, user_idx, item_idx, relevance, rank): every model fitted for every phase."""
    parts = []
    for phase in phases:
        past = durable(log.filter(F.col("iter") <= phase.fitted))  # read by all models
        for name, recommend in models.items():
            rows = recommend(past, users, items, k).select("user_idx", "item_idx", "relevance", F.col("rank").cast("long").alias("rank"))
            parts.append(rows.select(F.lit(phase.name).alias("phase"), F.lit(name).alias("model"), "*"))
    return reduce(DataFrame.unionByName, parts)


def judged(lists: DataFrame, log: DataFrame, phases: list[Phase], by: tuple[str, ...] = ("iter",)) -> DataFrame:
    """``lists`` with response and revenue, for every iteration after the fit in which the user took anything.

    An item's response is 1 if the user kept it in that iteration, its revenue what was kept brought.
    With ``by`` empty all later iterations are judged as one. All models' lists meet the later part
    of the log in one join by user and item.
    """
    later = reduce(DataFrame.unionByName, [log.filter(p.later(F.col("iter"))).withColumn("phase", F.lit(p.name)) for p in phases])
    took = F.col("relevance") > 0
    kept = later.groupBy("phase", "user_idx", "item_idx", *by).agg(
        F.max(F.when(took, 1).otherwise(0)).cast("long").alias("response"), F.sum(F.when(took, F.col("revenue")).otherwise(0.0)).alias("revenue")
    )
    shown = lists.join(later.select("phase", "user_idx", *by).distinct(), ["phase", "user_idx"])
    out = shown.join(kept, ["phase", "user_idx", *by, "item_idx"], "left")
    return out.withColumns({"response": F.coalesce("response", F.lit(0).cast("long")), "revenue": F.coalesce("revenue", F.lit(0.0))})


def compare(models: dict[str, Recommender], log: DataFrame, users: DataFrame, items: DataFrame, k: int, at: int, phases: list[Phase]) -> DataFrame:
    """(model, phase, iter, metric, value): all metrics of all models in one pass over their judged lists."""
    rows = judged(lists_of(models, log, users, items, k, phases), log, phases)
    return iteration_metrics(durable(rows), at, ["model", "phase", "iter"])
