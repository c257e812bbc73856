"""The fit / predict contract, for code that plugs recommenders into a loop."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortlist.operators import models as md
from shortlist.operators import popularity as pop
from shortlist.operators import recommend as rec
from shortlist.operators.features import standard_scaled
from shortlist.plans.topk import prefix_topk
from shortlist.plans.vector_topk import vector_topk
from shortlist.session import durable
from shortlist.sources.fitted import load_fitted, save_fitted


class Recommender(Protocol):
    def fit(self, log: DataFrame, user_features: DataFrame | None = None, item_features: DataFrame | None = None) -> "Recommender": ...

    def predict(
        self, log: DataFrame | None, k: int, users: DataFrame, items: DataFrame,
        user_features: DataFrame | None = None, item_features: DataFrame | None = None, filter_seen_items: bool = True,
    ) -> DataFrame: ...


class _Scored:
    """Models that are a score per item, with a fill value for unknown items."""

    scores: DataFrame | None = None
    fill: float = pop.NEUTRAL

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        if self.scores is None:
            raise RuntimeError("fit first")
        table = pop.catalog_scores(items.select("item_idx"), self.scores, F.lit(self.fill))
        return prefix_topk(users, table, log if filter_seen_items else None, k)

    def score_pairs(self, pairs: DataFrame) -> DataFrame:
        if self.scores is None:
            raise RuntimeError("fit first")
        out = rec.lookup(pairs, self.scores, "item_idx", "left")
        return out.withColumn("relevance", F.coalesce("relevance", F.lit(self.fill)))

    def save(self, spark: SparkSession, path: str) -> None:
        if self.scores is None:
            raise RuntimeError("fit first")
        save_fitted(spark, path, {"scores": self.scores}, {"fill": self.fill})

    def load(self, spark: SparkSession, path: str):
        tables, params = load_fitted(spark, path)
        self.scores, self.fill = tables["scores"], params["fill"]
        return self


class Popularity(_Scored):
    def __init__(self, alpha: float = pop.SMOOTHING):
        self.alpha = alpha

    def fit(self, log, user_features=None, item_features=None):
        self.scores = durable(pop.smoothed_popularity(pop.item_counts(log), self.alpha))
        return self


class UpperConfidence(_Scored):
    """Labels must be 0 or 1; unseen items get the cold score."""

    def __init__(self, coef: float = pop.EXPLORATION):
        self.coef = coef

    def fit(self, log, user_features=None, item_features=None):
        pop.check_labels(log)
        counts = durable(pop.item_counts(log))
        self.scores = durable(pop.ucb_scores(counts, self.coef).select("item_idx", "relevance"))
        self.fill = counts.sparkSession.range(1).select(pop.ucb_fill(counts, self.coef)).first()[0]
        return self


class _Stored:
    """Models that are a few tables and plain parameters."""

    tables: dict[str, DataFrame] | None = None
    params: dict = {}

    def _fitted(self) -> dict[str, DataFrame]:
        if self.tables is None:
            raise RuntimeError("fit first")
        return self.tables

    def save(self, spark: SparkSession, path: str) -> None:
        save_fitted(spark, path, self._fitted(), self.params)

    def load(self, spark: SparkSession, path: str):
        self.tables, self.params = load_fitted(spark, path)
        return self


class Logistic(_Stored):
    """Elastic-net logistic regression on the factored features; the whole grid by default. Users and
    items that were not there at the fit are not scored."""

    def __init__(self, cs=md.LOGISTIC_C, l1s=md.LOGISTIC_L1, folds: int = 5, seed: int = 0):
        self.cs, self.l1s, self.folds, self.seed = cs, l1s, folds, seed

    def fit(self, log, user_features=None, item_features=None):
        features = md.factored_features(log, user_features, item_features)
        model = md.search_logistic(features.rows(log), ["user_idx", "item_idx"], self.cs, self.l1s, self.folds, self.seed)
        u, v = features.vectors(model.coefficients.toArray(), model.intercept)
        self.tables = {"users": durable(u), "items": durable(v)}
        return self

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        u = self._fitted()["users"].join(users.select("user_idx"), "user_idx", "left_semi")
        v = self.tables["items"].join(items.select("item_idx"), "item_idx", "left_semi")
        best = vector_topk(u, v, k, "dot", log.select("user_idx", "item_idx") if filter_seen_items and log is not None else None)
        return best.select("user_idx", "item_idx", (1.0 / (1.0 + F.exp(-F.col("score")))).alias("relevance"), "rank")


class Neighbours(_Stored):
    """Mean label of the nearest past interactions, over numeric columns of users and items that are
    scaled at the fit. Users and items that were not there then are not scored."""

    def __init__(self, user_columns=("income",), item_columns=("price", "size"), n: int = 5, whole: bool = True):
        self.user_columns, self.item_columns, self.params = list(user_columns), list(item_columns), {"n": n, "whole": whole}

    def fit(self, log, user_features=None, item_features=None):
        u = standard_scaled(user_features.select("user_idx", *self.user_columns), self.user_columns)
        i = standard_scaled(item_features.select("item_idx", *self.item_columns), self.item_columns)
        u = durable(u.select("user_idx", F.array(*self.user_columns).alias("vec")))
        i = durable(i.select("item_idx", F.array(*self.item_columns).alias("vec")))
        past = log.groupBy("user_idx", "item_idx").agg(F.max("relevance").alias("label"))
        points = past.join(u.withColumnRenamed("vec", "_u"), "user_idx").join(i.withColumnRenamed("vec", "_i"), "item_idx")
        train = points.select(F.concat_ws(":", "user_idx", "item_idx").alias("row_id"), F.concat("_u", "_i").alias("vec"), "label")
        self.tables = {"users": u, "items": i, "train": durable(train)}
        return self

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        u = self._fitted()["users"].join(users.select("user_idx"), "user_idx", "left_semi")
        i = self.tables["items"].join(items.select("item_idx"), "item_idx", "left_semi")
        return rec.knn_catalogue(u, i, self.tables["train"], log if filter_seen_items else None, k, self.params["n"], whole=self.params["whole"])


class Random:
    def __init__(self, seed: int = 0):
        self.seed = seed

    def fit(self, log, user_features=None, item_features=None):
        return self

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        return rec.random_topk(log if filter_seen_items else None, users, items, k, self.seed)


class Hybrid:
    """Weighted sum of other recommenders, each asked for 2k items."""

    def __init__(self, parts: list[Recommender], weights: list[float] | None = None):
        self.parts, self.weights = parts, weights

    def fit(self, log, user_features=None, item_features=None):
        for part in self.parts:
            part.fit(log, user_features, item_features)
        return self

    def predict(self, log, k, users, items, user_features=None, item_features=None, filter_seen_items=True):
        if not self.parts:
            return rec.neutral(users, items, log if filter_seen_items else None, k)
        lists = [p.predict(log, 2 * k, users, items, user_features, item_features, filter_seen_items) for p in self.parts]
        return rec.hybrid(lists, items, k, self.weights)
