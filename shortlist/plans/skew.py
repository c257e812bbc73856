"""Joins and checks that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 1 / 200  # at most 200 keys can hold this share, so the list is bounded
SPREAD = 32
BROADCAST_ROWS = 200_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``max_rows`` rows. A stored table answers from its footers."""
    return df.count() <= max_rows


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a table that arrives in fewer files than there are cores.

    A large table has many files and is left alone.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if len(df.inputFiles()) < tasks else df


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> list:
    """Keys holding more than ``share`` of the rows: at most ``1 / share`` values."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()  # the same shuffle again, so ``df`` is read once
    rows = counts.filter(F.col("n") > total * share).select(key).collect()
    return [r[0] for r in rows if r[0] is not None]


def lookup(
    fact: DataFrame, dim: DataFrame, key: str | list[str], how: str = "inner", dim_rows: DataFrame | None = None,
    heavy_in: DataFrame | None = None,
) -> DataFrame:
    """Join a large table to a table with one row per key.

    ``dim_rows`` is a cheap table with at least as many rows as ``dim`` (its base table), used to
    check the size. A small ``dim`` is broadcast, so the fact rows never move. A large one is
    shuffled, and the fact rows of heavy keys are spread over ``SPREAD`` copies of their
    dimension row. ``heavy_in`` is a table that is cheaper to read than ``fact`` and has the same
    keys, from which the heavy ones are told; else ``fact`` is worked out once for that alone.
    """
    if is_small(dim if dim_rows is None else dim_rows):
        return fact.join(F.broadcast(dim), key, how)
    heavy = None if heavy_in is None else heavy_keys(heavy_in, key if isinstance(key, str) else key[0])
    return spread_join(fact, dim, key, how, heavy)


def spread_join(
    fact: DataFrame, dim: DataFrame, key: str | list[str], how: str = "inner", heavy: list | None = None
) -> DataFrame:
    """Shuffle join with the heavy keys split by a hash of the whole fact row.

    With several key columns, the first one decides which rows are heavy. The join is asked for by
    name: the planner's sizes come from compressed files and do not grow with ``explode``, so left to
    itself it may broadcast either side, however many rows it has.
    """
    keys = [key] if isinstance(key, str) else list(key)
    heavy = heavy_keys(fact, keys[0]) if heavy is None else heavy
    if not heavy:
        return fact.join(dim.hint("merge"), keys, how)
    is_heavy = F.coalesce(F.col(keys[0]).isin(heavy), F.lit(False))
    row_hash = F.pmod(F.xxhash64(*fact.columns), F.lit(SPREAD)).cast("int")
    copies = F.when(is_heavy, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    left = fact.withColumn("_salt", F.when(is_heavy, row_hash).otherwise(F.lit(0)))
    right = dim.withColumn("_salt", F.explode(copies))
    return left.join(right.hint("merge"), [*keys, "_salt"], how).drop("_salt")
