"""Samples, splits and synthetic tables that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shortlist.functions.randomness import gamma_int, normal, uniform
from shortlist.functions.vectors import dot
from shortlist.plans.ordering import global_row_number
from shortlist.plans.skew import is_small, lookup

SAMPLE_LIMIT = 200_000


def seeds(seed: int | None) -> Iterator[int | None]:
    """A new seed per call; no seed stays no seed."""
    if seed is None:
        while True:
            yield None
    rng = np.random.default_rng(seed)
    while True:
        yield int(rng.integers(0, 2**31 - 1))


def fraction(df: DataFrame, frac: float, seed, key: list[str]) -> DataFrame:
    """Keep each row with probability ``frac``, decided by its key."""
    return df.filter(uniform(seed, *key) < frac)


def exactly(df: DataFrame, n: int, seed, key: list[str]) -> DataFrame:
    """Exactly n rows without replacement: the n smallest key hashes."""
    order = [uniform(seed, *key), *[F.col(c) for c in key]]
    if n <= SAMPLE_LIMIT:
        return df.orderBy(*order).limit(n)
    # a large limit would pull its rows through one task; a distributed rank does not
    return global_row_number(df, order, "_place").filter(F.col("_place") <= n).drop("_place")


def generate(df: DataFrame, n: int, seed, key: list[str]) -> DataFrame:
    """Like :func:`exactly`; asking for more rows than there are is an error."""
    if df.count() < n:
        raise ValueError(f"{n} rows wanted, but the source has fewer")
    return exactly(df, n, seed, key)


def capped(df: DataFrame, cap: int, seed, key: list[str]) -> DataFrame:
    """The table itself, or a sample of ``cap`` rows if it has more."""
    return df if is_small(df, cap) else exactly(df, cap, seed, key)


class Composite:
    """Several sources of the same columns, drawn from in fixed proportions."""

    def __init__(self, sources: list[DataFrame], key: list[str], weights: list[float] | None = None):
        self.sources, self.key = sources, key
        self.sizes = [s.count() for s in sources]
        total = sum(self.sizes)
        if weights is not None and len(weights) != len(sources):
            raise ValueError("one weight per source is needed")
        self.weights = weights or ([s / total for s in self.sizes] if total else [0.0] * len(sources))

    def generate(self, n: int, seed) -> "Composite":
        """Draw ``round(n * weight)`` rows of each source (half to even)."""
        parts = [generate(s, round(n * w), f"{seed}/{i}", self.key) for i, (s, w) in enumerate(zip(self.sources, self.weights))]
        return Composite(parts, self.key, self.weights)

    def sample(self, frac: float, seed) -> DataFrame:
        """Per source a Bernoulli sample of expected size ``int(total * frac * weight)``."""
        wanted = [int(sum(self.sizes) * frac * w) for w in self.weights]
        for i, (n, size) in enumerate(zip(wanted, self.sizes)):
            if n > size:
                raise ValueError(f"source {i} has {size} rows, {n} are needed")
        parts = [
            fraction(s, n / size if size else 0.0, f"{seed}/{i}", self.key)
            for i, (s, n, size) in enumerate(zip(self.sources, wanted, self.sizes))
        ]
        return reduce(lambda a, b: a.unionByName(b), parts)


def holdout(df: DataFrame, share: float, seed, key: list[str], output: str = "is_test") -> DataFrame:
    return df.withColumn(output, uniform(seed, *key) < share)


def stratified_folds(df: DataFrame, label: str, n: int, seed, key: list[str], output: str = "fold") -> DataFrame:
    """Fold number per row, with labels spread evenly: the running count within each label, modulo n.

    Rows are put in one global order by (label, hash), so a label with most of the rows is still
    numbered by all tasks.
    """
    # a sort works its expressions out at every comparison, so the hash is a column
    order = [F.col(label), F.col("_draw"), *[F.col(c) for c in key]]
    numbered = global_row_number(df.withColumn("_draw", uniform(seed, *key)), order, "_place").drop("_draw")
    first = numbered.groupBy(label).agg(F.min("_place").alias("_first"))
    return (
        lookup(numbered, first, label)
        .withColumn(output, ((F.col("_place") - F.col("_first")) % n).cast("int"))
        .drop("_place", "_first")
    )


def head_tail(df: DataFrame, share: float, order: list[Column], output: str = "is_train") -> DataFrame:
    """The first ``share`` of the rows in the given order are the training part."""
    numbered = global_row_number(df, order, "_place")
    cut = F.floor(df.agg(F.count(F.lit(1))).scalar() * share)
    return numbered.withColumn(output, F.col("_place") <= cut).drop("_place")


# --- synthetic tables -----------------------------------------------------------------------


def _mixture(spark: SparkSession, n: int, key: str, group: str, prefix: str, dims: int, mix: list[tuple[str, float, float]], seed) -> DataFrame:
    """``mix`` holds (group, share, mean); the last group takes the remainder."""
    sizes = [int(share * n) for _, share, _ in mix[:-1]]
    sizes.append(n - sum(sizes))
    name, mean, upto = None, None, 0
    for (g, _, m), size in zip(mix, sizes):
        upto += size
        inside = F.col("id") < upto
        name = F.when(inside, g) if name is None else name.when(inside, g)
        mean = F.when(inside, m) if mean is None else mean.when(inside, m)
    rows = spark.range(n).select(F.col("id").alias(key), name.alias(group), mean.alias("_mean"))
    attrs = {f"{prefix}{d}": F.col("_mean") + normal(f"{seed}/{prefix}{d}", key) for d in range(dims)}
    return rows.withColumns(attrs).drop("_mean")


def synthetic_users(spark: SparkSession, n: int, dims: int, mix: list[tuple[str, float, float]], seed) -> DataFrame:
    return _mixture(spark, n, "user_idx", "segment", "user_attr_", dims, mix, seed)


def synthetic_items(spark: SparkSession, n: int, dims: int, mix: list[tuple[str, float, float]], seed, shape: int = 5, scale: float = 10.0) -> DataFrame:
    out = _mixture(spark, n, "item_idx", "category", "item_attr_", dims, mix, seed)
    return out.withColumn("price", gamma_int(f"{seed}/price", "item_idx", shape=shape, scale=scale))


def synthetic_history(users: DataFrame, items: DataFrame, density: float, seed, n_users: int, n_items: int) -> DataFrame:
    """``int(density * users * items)`` uniform pairs without repeats; relevance 1 if the attributes agree.

    Keys are 0..n-1, as made by the two functions above.
    """
    n = int(density * n_users * n_items)
    pairs = users.sparkSession.range(n).select(
        F.floor(uniform(f"{seed}/user", "id") * n_users).alias("user_idx"),
        F.floor(uniform(f"{seed}/item", "id") * n_items).alias("item_idx"),
    ).dropDuplicates(["user_idx", "item_idx"])
    u_attrs = sorted(c for c in users.columns if c.startswith("user_attr_"))
    i_attrs = sorted(c for c in items.columns if c.startswith("item_attr_"))
    out = pairs.join(users.select("user_idx", F.array(*u_attrs).alias("u")), "user_idx")
    out = out.join(items.select("item_idx", F.array(*i_attrs).alias("i")), "item_idx")
    return out.select("user_idx", "item_idx", F.when(dot("u", "i") > 0, 1).otherwise(0).cast("long").alias("relevance"))
