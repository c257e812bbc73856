"""Positions and running totals that never put an unbounded group into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shortlist.plans.skew import heavy_keys, is_small
from shortlist.session import durable

ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits
BLOCK = 65_536
ONE_TASK_ROWS = 1_000_000  # narrow rows that a single task may sort


def _sorted_parts(df: DataFrame, order: list[Column]) -> DataFrame:
    """Range-sorted rows with their partition and the row number inside it, frozen on storage."""
    rows = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    rows = rows.withColumn("_part", F.shiftright("_id", ROW_BITS)).withColumn(
        "_row", F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    )
    return durable(rows.drop("_id"))


def _before(parts: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Totals of all earlier partitions: one row per partition, so a plain window is bounded."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_part").agg(*[F.sum(e).alias(f"_{n}") for n, e in sums.items()])
    return totals.select(
        "_part", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums]
    )


def global_row_number(df: DataFrame, order: list[Column], name: str = "rank", small: int = ONE_TASK_ROWS) -> DataFrame:
    """1-based position of each row in the total order ``order``."""
    if is_small(df, small):
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    parts = _sorted_parts(df, order)
    before = _before(parts, {"n": F.lit(1)})
    return (
        parts.join(F.broadcast(before), "_part")
        .withColumn(name, F.col("_before_n") + F.col("_row") + 1)
        .drop("_part", "_row", "_before_n")
    )


def running_totals(df: DataFrame, key: str, sums: list[str], small: int = ONE_TASK_ROWS) -> DataFrame:
    """Add ``cum_<c>``: the inclusive running sum of each column, by ascending unique ``key``."""
    if is_small(df, small):
        upto = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select("*", *[F.sum(c).over(upto).alias(f"cum_{c}") for c in sums])
    parts = _sorted_parts(df, [F.col(key)])
    before = _before(parts, {c: F.col(c) for c in sums})
    upto = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = parts.join(F.broadcast(before), "_part").select(
        "*", *[(F.col(f"_before_{c}") + F.sum(c).over(upto)).alias(f"cum_{c}") for c in sums]
    )
    return out.drop("_part", "_row", *[f"_before_{c}" for c in sums])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their counts: copies of a hot value merge before the shuffle."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def exact_percentiles(df: DataFrame, column: str, points: list[float], small: int = ONE_TASK_ROWS) -> DataFrame:
    """Linear-interpolated percentiles, one row per point: (point, value)."""
    cum = running_totals(value_counts(df, column), "value", ["n"], small)
    wanted = df.sparkSession.createDataFrame([(float(p),) for p in points], "point double")
    place = F.col("point") * (df.agg(F.count(column)).scalar() - 1)
    wanted = wanted.select("point", place.alias("place")).select(
        "point",
        F.floor("place").alias("low"),
        F.ceil("place").alias("high"),
        (F.col("place") - F.floor("place")).alias("part"),
    )
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1  # 0-based places held by the value
    hit = lambda place: (F.col(place) >= first) & (F.col(place) <= last)
    found = cum.join(F.broadcast(wanted), hit("low") | hit("high"))  # one row per point: a handful
    ends = found.groupBy("point", "part").agg(
        F.max(F.when(hit("low"), F.col("value"))).alias("low_value"),
        F.max(F.when(hit("high"), F.col("value"))).alias("high_value"),
    )
    return ends.select(
        "point", (F.col("low_value") + (F.col("high_value") - F.col("low_value")) * F.col("part")).alias("value")
    )


def positions(
    log: DataFrame,
    user: str,
    order: list[str],
    slice_by: Column,
    name: str = "pos",
    heavy: list | None = None,
    length: str | None = None,
) -> DataFrame:
    """1-based position of each row in its user's sequence, and optionally the sequence length.

    ``slice_by`` grows with ``order`` (for example the day of the timestamp). A heavy user's rows
    are numbered inside each slice and shifted by the sizes of the earlier slices, so no task
    holds that user's whole history.
    """
    heavy = heavy_keys(log, user) if heavy is None else heavy
    if not heavy:
        by_user = Window.partitionBy(user)
        out = log.withColumn(name, F.row_number().over(by_user.orderBy(*order)).cast("long"))
        return out.withColumn(length, F.count(F.lit(1)).over(by_user)) if length else out
    sliced = log.withColumn("_slice", F.when(F.col(user).isin(heavy), slice_by.cast("string")).otherwise(F.lit("")))
    local = F.row_number().over(Window.partitionBy(user, "_slice").orderBy(*order)).cast("long")
    sizes = sliced.groupBy(user, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(user).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        user,
        "_slice",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"),
        F.sum("_size").over(Window.partitionBy(user)).alias("_length"),
    )
    out = sliced.withColumn("_local", local).join(shifts, [user, "_slice"])
    out = out.withColumn(name, F.col("_shift") + F.col("_local"))
    if length:
        out = out.withColumn(length, F.col("_length"))
    return out.drop("_slice", "_local", "_shift", "_length")


def previous(
    rows: DataFrame, user: str, pos: str, column: str, n: int, heavy: list, block: int = BLOCK
) -> DataFrame:
    """Add ``prev_1 .. prev_n``: the values 1..n places earlier in the user's sequence.

    A heavy user's sequence is cut into blocks of ``block`` rows; the last n rows of a block are
    also sent to the next one, where they serve as context only.
    """
    own = F.floor((F.col(pos) - 1) / block)
    is_heavy = F.col(user).isin(heavy) if heavy else F.lit(False)
    near_end = ((F.col(pos) - 1) % block) >= block - n
    spans = F.when(~is_heavy, F.array(F.lit(0).cast("long"))).when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    cut = rows.withColumn("_block", F.explode(spans)) if heavy else rows.withColumn("_block", F.lit(0).cast("long"))
    w = Window.partitionBy(user, "_block").orderBy(pos)
    out = cut.select("*", *[F.lag(column, j).over(w).alias(f"prev_{j}") for j in range(1, n + 1)])
    return (out.filter(~is_heavy | (F.col("_block") == own)) if heavy else out).drop("_block")


def all_present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
