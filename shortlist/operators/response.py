"""Response columns: functions on a DataFrame, and thin ML transformers around them."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortlist.functions import vectors
from shortlist.functions.randomness import normal, uniform
from shortlist.plans.skew import is_small, lookup
from shortlist.session import durable

ROW_KEY = ["user_idx", "item_idx"]
NOISE_MEAN, NOISE_STD = 0.1, 0.05


def with_features(recs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Left joins of the user and item features onto (user, item, relevance[, rank])."""
    keep = [c for c in ("user_idx", "item_idx", "relevance", "rank") if c in recs.columns]
    rows = durable(recs.select(*keep))  # heavy keys and the items listed are told from it
    listed = items if is_small(items) else durable(items.join(rows.select("item_idx").distinct(), "item_idx", "left_semi"))
    out = lookup(rows, users, "user_idx", "left", heavy_in=rows)
    return lookup(out, listed, "item_idx", "left", heavy_in=rows)


def constant(df: DataFrame, value: float = 0.0, output: str = "response") -> DataFrame:
    return df.withColumn(output, F.lit(float(value)))


def bernoulli(df: DataFrame, probability: str, output: str = "response", seed: int = 0, key=ROW_KEY) -> DataFrame:
    """1 with the given probability; a null probability gives 0."""
    drawn = uniform(f"{seed}/{output}", *key) <= F.col(probability)
    return df.withColumn(output, F.when(drawn, 1).otherwise(0))


def noise(
    df: DataFrame, mean: float = NOISE_MEAN, std: float = NOISE_STD, clip: bool = True,
    output: str = "noise", seed: int = 0, key=ROW_KEY,
) -> DataFrame:
    value = normal(f"{seed}/{output}", *key, mean=mean, std=std)
    return df.withColumn(output, F.greatest(value, F.lit(0.0)) if clip else value)


def weighted(df: DataFrame, columns: list[str], weights: list[float], output: str = "response") -> DataFrame:
    if len(columns) != len(weights):
        raise ValueError("as many weights as columns are needed")
    terms = [F.col(c) * w for c, w in zip(columns, weights)]
    return df.withColumn(output, reduce(lambda a, b: a + b, terms))


def angular(df: DataFrame, columns: list[str], output: str = "response") -> DataFrame:
    if len(columns) != 2:
        raise ValueError("exactly two vector columns are needed")
    return df.withColumn(output, vectors.angular(*columns))


def revenue(df: DataFrame, response: str = "response", price: str = "price", output: str = "revenue") -> DataFrame:
    return df.withColumn(output, F.col(response) * F.col(price))


def responses(recs: DataFrame, users: DataFrame, items: DataFrame, seed: int = 0, use_relevance: bool = False) -> DataFrame:
    """Features, purchase probability, purchase, revenue.

    The probability is clipped noise, or with ``use_relevance`` the relevance plus that noise.
    """
    df = noise(with_features(recs, users, items), output="__noisy_relevance", seed=seed)
    if use_relevance:
        df = weighted(df, ["relevance", "__noisy_relevance"], [1.0, 1.0], "__noisy_relevance")
    return revenue(bernoulli(df, "__noisy_relevance", "response", seed))


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer with an output column and a seed."""

    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    def __init__(self, **params):
        super().__init__()
        self._setDefault(outputCol="response", seed=0)
        self._set(**params)

    def value(self, name: str):
        return self.getOrDefault(self.getParam(name))


class BernoulliStage(_Stage):
    inputCol = Param(Params._dummy(), "inputCol", "probability column", TypeConverters.toString)

    def _transform(self, df: DataFrame) -> DataFrame:
        return bernoulli(df, self.value("inputCol"), self.value("outputCol"), self.value("seed"))


class NoiseStage(_Stage):
    mean = Param(Params._dummy(), "mean", "mean", TypeConverters.toFloat)
    std = Param(Params._dummy(), "std", "standard deviation", TypeConverters.toFloat)
    clip = Param(Params._dummy(), "clip", "negative values become 0", TypeConverters.toBoolean)

    def __init__(self, **params):
        super().__init__()
        self._setDefault(mean=NOISE_MEAN, std=NOISE_STD, clip=True)
        self._set(**params)

    def _transform(self, df: DataFrame) -> DataFrame:
        return noise(df, self.value("mean"), self.value("std"), self.value("clip"), self.value("outputCol"), self.value("seed"))


class ConstantStage(_Stage):
    constant = Param(Params._dummy(), "constant", "value", TypeConverters.toFloat)

    def __init__(self, **params):
        super().__init__()
        self._setDefault(constant=0.0)
        self._set(**params)

    def _transform(self, df: DataFrame) -> DataFrame:
        return constant(df, self.value("constant"), self.value("outputCol"))


class AngularStage(_Stage):
    inputCols = Param(Params._dummy(), "inputCols", "two vector columns", TypeConverters.toListString)

    def _transform(self, df: DataFrame) -> DataFrame:
        return angular(df, self.value("inputCols"), self.value("outputCol"))


class WeightedStage(_Stage):
    inputCols = Param(Params._dummy(), "inputCols", "columns to add", TypeConverters.toListString)
    weights = Param(Params._dummy(), "weights", "one weight per column", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        return weighted(df, self.value("inputCols"), self.value("weights"), self.value("outputCol"))


class RevenueStage(_Stage):
    inputCol = Param(Params._dummy(), "inputCol", "response column", TypeConverters.toString)
    priceCol = Param(Params._dummy(), "priceCol", "price column", TypeConverters.toString)

    def _transform(self, df: DataFrame) -> DataFrame:
        return revenue(df, self.value("inputCol"), self.value("priceCol"), self.value("outputCol"))


class VectorElement(_Stage):
    """Element ``index`` of a vector column, as a double."""

    inputCol = Param(Params._dummy(), "inputCol", "vector column", TypeConverters.toString)
    index = Param(Params._dummy(), "index", "0-based position", TypeConverters.toInt)

    def _transform(self, df: DataFrame) -> DataFrame:
        source = self.value("inputCol")
        arr = vector_to_array(source) if isinstance(df.schema[source].dataType, VectorUDT) else F.col(source)
        return df.withColumn(self.value("outputCol"), F.get(arr, F.lit(self.value("index"))).cast("double"))


def response_model(seed: int = 0) -> PipelineModel:
    return PipelineModel([
        NoiseStage(outputCol="__noisy_relevance", seed=seed),
        BernoulliStage(inputCol="__noisy_relevance", outputCol="response", seed=seed),
        RevenueStage(inputCol="response", priceCol="price", outputCol="revenue"),
    ])
