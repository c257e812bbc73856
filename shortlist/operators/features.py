"""Feature tables: statistics, binning, encoding, alignment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortlist.plans.ordering import ONE_TASK_ROWS, exact_percentiles, global_row_number
from shortlist.plans.skew import lookup, spread
from shortlist.session import durable

LEVELS = ["very_low", "low", "medium", "high", "very_high"]
LEVEL_POINTS = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]


# --- projections ----------------------------------------------------------------------------


def prefixed(df: DataFrame, prefix: str, key: str) -> DataFrame:
    return df.select(key, *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c != key])


def starting_with(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def binarized(df: DataFrame, column: str = "relevance") -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) > 0, 1).otherwise(0))


def truncated_log(recs: DataFrame) -> DataFrame:
    """Keys with the relevance cut to a whole number."""
    return recs.select("user_idx", "item_idx", F.col("relevance").cast("long").alias("relevance"))


def first_of_duplicates(df: DataFrame) -> DataFrame:
    """Keep the first column of each name."""
    seen: set[str] = set()
    numbered = [f"{c}__{i}" for i, c in enumerate(df.columns)]
    keep = []
    for tmp, name in zip(numbered, df.columns):
        if name not in seen:
            seen.add(name)
            keep.append(F.col(f"`{tmp}`").alias(name))
    return df.toDF(*numbered).select(*keep)


def columns_by_type(df: DataFrame, leave_out: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """Names of the (text, numeric) columns."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return [c for c in text if c not in leave_out], [c for c in numeric if c not in leave_out]


def to_number(column: Column | str) -> Column:
    """Double; anything that is not a finite number becomes 0."""
    value = (F.col(column) if isinstance(column, str) else column).try_cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return F.when(finite, value).otherwise(F.lit(0.0))


def aligned(df: DataFrame, text: list[str], numeric: list[str], fill_text: str = "missing") -> DataFrame:
    """Exactly the expected feature columns; missing ones are filled."""
    have = set(df.columns)
    return df.select(
        *[(F.coalesce(F.col(c).cast("string"), F.lit(fill_text)) if c in have else F.lit(fill_text)).alias(c) for c in text],
        *[(to_number(c) if c in have else F.lit(0.0)).alias(c) for c in numeric],
    )


# --- statistics -----------------------------------------------------------------------------


def _stats(log: DataFrame, key: str, count: str, prefix: str) -> DataFrame:
    return log.groupBy(key).agg(
        F.count(F.lit(1)).alias(count),
        F.avg("relevance").alias(f"{prefix}_avg_relevance"),
        F.stddev("relevance").alias(f"{prefix}_relevance_std"),
        F.max("relevance").alias(f"{prefix}_max_relevance"),
    )


def user_stats(log: DataFrame) -> DataFrame:
    return _stats(log, "user_idx", "user_interaction_count", "user")


def item_stats(log: DataFrame) -> DataFrame:
    return _stats(log, "item_idx", "item_popularity", "item")


def category_stats(log: DataFrame, items: DataFrame) -> DataFrame:
    """Per category, from per-item sums: the log shrinks before it meets the items."""
    per_item = log.groupBy("item_idx").agg(F.sum("relevance").alias("pos"), F.count(F.lit(1)).alias("n"))
    joined = per_item.join(items.select("item_idx", "category"), "item_idx")
    return joined.groupBy("category").agg(
        (F.sum("pos") / F.sum("n")).alias("category_avg_relevance"), F.sum("n").alias("category_popularity")
    )


def user_features(log: DataFrame, users: DataFrame) -> DataFrame:
    return prefixed(users.join(user_stats(log), "user_idx", "left"), "u_", "user_idx")


def item_features(log: DataFrame, items: DataFrame) -> DataFrame:
    out = items.join(item_stats(log), "item_idx", "left")
    out = lookup(out, category_stats(log, items), "category", "left")
    return prefixed(out.select("item_idx", *[c for c in out.columns if c != "item_idx"]), "i_", "item_idx")


def joined_features(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Log rows with the user's and the item's features and history statistics."""
    rows = durable(log.select("user_idx", "item_idx", "relevance"))  # read by the joins and by every statistic
    out = lookup(spread(rows), user_features(rows, users), "user_idx", dim_rows=users, heavy_in=rows)
    return lookup(out, item_features(rows, items), "item_idx", dim_rows=items, heavy_in=rows)


# --- group means as joins: a window would hold a hot user's rows in one task -----------------


def price_features(df: DataFrame, users: DataFrame | None = None, user: str = "user_idx") -> DataFrame:
    """Category mean price, the user's mean price and the difference to it."""
    per_user = df.groupBy(user).agg(F.avg("i_price").alias("user_avg_price"))
    per_category = df.groupBy("i_category").agg(F.avg("i_price").alias("avg_category_price"))
    out = lookup(lookup(df, per_category, "i_category"), per_user, user, dim_rows=users)
    return out.withColumn("price_vs_user_mean", F.col("i_price") - F.col("user_avg_price"))


def segment_category_features(df: DataFrame, users: DataFrame | None = None, items: DataFrame | None = None) -> DataFrame:
    """Preference of the user and of the segment for the item's category, and diversity counts."""
    pairs = df.groupBy("user_idx", "i_category").agg(
        F.avg("relevance").alias("category_preference_score"), F.count("relevance").alias("category_exploration_score")
    )
    pairs = durable(pairs)  # sized, joined, and counted for the diversity
    strength = df.groupBy("u_segment", "i_category").agg(F.avg("relevance").alias("segment_category_strength"))
    diversity = pairs.groupBy("user_idx").agg(F.count(F.lit(1)).alias("category_diversity"))
    segments = df.groupBy("item_idx").agg(F.count_distinct("u_segment").alias("item_segments"))
    # the pairs bring the diversity along, so the wide rows are not shuffled for it
    pairs = lookup(pairs, diversity, "user_idx", dim_rows=users, heavy_in=pairs)
    out = lookup(df, pairs, ["user_idx", "i_category"], heavy_in=df)
    out = lookup(out, strength, ["u_segment", "i_category"], heavy_in=df)
    return lookup(out, segments, "item_idx", dim_rows=items, heavy_in=df)


# --- binning --------------------------------------------------------------------------------


def quantile_edges(df: DataFrame, column: str, points: list[float] = LEVEL_POINTS, small: int = ONE_TASK_ROWS) -> list[float]:
    rows = exact_percentiles(df, column, points, small).collect()  # one row per point
    return [v for _, v in sorted((r["point"], r["value"]) for r in rows)]


def level(column: str, edges: list[float], labels: list[str] = LEVELS) -> Column:
    """Quantile bin: right-closed, the lowest value belongs to the first bin.

    Edges that are not strictly increasing cannot be bins: every row is 'medium'.
    """
    if any(b <= a for a, b in zip(edges, edges[1:])) or len(edges) != len(labels) + 1:
        return F.lit("medium")
    out = F.when(F.col(column).isNull() | (F.col(column) < edges[0]) | (F.col(column) > edges[-1]), F.lit(None).cast("string"))
    for edge, name in zip(edges[1:], labels):
        out = out.when(F.col(column) <= edge, name)
    return out


def quantile_level(df: DataFrame, column: str, output: str, over: DataFrame | None = None) -> DataFrame:
    return df.withColumn(output, level(column, quantile_edges(df if over is None else over, column)))


# --- the whole feature table ----------------------------------------------------------------


def interaction_features(df: DataFrame, users: DataFrame | None = None, items: DataFrame | None = None) -> DataFrame:
    """All features of a joined log (see :func:`joined_features`)."""
    known = df.select("u_segment") if users is None else users.select("segment")
    segments = sorted(r[0] for r in known.distinct().collect() if r[0] is not None)  # they become columns
    df = durable(df)  # the joins below it are done once, not once per statistic
    price, income = F.col("i_price"), F.col("u_income")
    sensitivity = F.try_divide(price, income + 1)  # null where the divisor is 0
    means = df.groupBy("u_segment").agg(F.avg(sensitivity).alias("segment_price_sensitivity"))
    # what follows from a row's own columns is added when the rows no longer move
    out = lookup(segment_category_features(df, users, items), means, "u_segment", "left", heavy_in=df).withColumns({
        "price_sensitivity": sensitivity,
        "price_affordability": F.try_divide(income, price + 1),
        "price_income_interaction": price * income,
    }).withColumn("price_elasticity", F.col("price_sensitivity") * F.col("price_affordability"))
    edges = {
        "price_range": quantile_edges(df, "i_price"),
        "user_activity_level": quantile_edges(df, "u_user_interaction_count"),
        "item_popularity_level": quantile_edges(df, "i_item_popularity"),
    }
    return out.withColumns({
        "price_range": level("i_price", edges["price_range"]),
        "user_activity_level": level("u_user_interaction_count", edges["user_activity_level"]),
        "item_popularity_level": level("i_item_popularity", edges["item_popularity_level"]),
        "user_engagement_score": F.col("u_user_interaction_count") * F.col("u_user_avg_relevance"),
        "user_exploration_score": F.try_divide(F.col("u_user_interaction_count"), F.col("category_diversity")),
        "item_engagement_score": F.col("i_item_popularity") * F.col("i_item_avg_relevance"),
        "item_diversity_score": F.try_divide(F.col("i_item_popularity"), F.col("item_segments")),
        **{
            f"segment_{s}_price_match": F.when(F.col("u_segment") == s, F.col("price_affordability")).otherwise(0.0)
            for s in segments
        },
        **{
            f"{c}_{name}": F.pow(F.col(c), F.lit(power))
            for c in ("u_income", "i_price", "u_user_avg_relevance", "i_item_avg_relevance")
            for name, power in (("squared", 2.0), ("cubed", 3.0))
        },
    }).withColumn("price_category_match", F.concat_ws("_", "price_range", "i_category")).drop("item_segments")


# --- encoding -------------------------------------------------------------------------------


def impute_values(df: DataFrame, text: list[str], numeric: list[str]) -> DataFrame:
    """Most frequent value per text column (ties: the smallest) and mean per numeric column."""
    parts = [
        df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "value").limit(1).select(F.lit(c).alias("column"), "value")
        for c in text
    ]
    if numeric:
        means = df.agg(*[F.avg(c).alias(c) for c in numeric]).unpivot([], numeric, "column", "mean")
        parts.append(means.select("column", F.round("mean", 6).cast("string").alias("value")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def one_hot(df: DataFrame, column: str, values: list[str], prefix: str | None = None) -> DataFrame:
    """0/1 column per known value; an unknown value gives all zeros."""
    prefix = prefix or column
    return df.withColumns({f"{prefix}_{v}": F.when(F.col(column) == v, 1.0).otherwise(0.0) for v in values})


def standard_scaled(df: DataFrame, columns: list[str], over: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    base = df if over is None else over
    out = {}
    for c in columns:
        std = base.agg(F.stddev_pop(c)).scalar()
        out[c] = (F.col(c) - base.agg(F.avg(c)).scalar()) / F.when(std > 0, std).otherwise(1.0)
    return df.withColumns(out)


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their alphabetical number from 0; one row per distinct value."""
    distinct = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return global_row_number(distinct, [F.col(column).asc()], "code").withColumn("code", F.col("code") - 1)


def label_encoded(df: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Unseen values get 0."""
    return lookup(df, codes, column, "left").fillna(0, ["code"])


def first_by_group(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def price_score(probability: Column, price: Column) -> Column:
    """Composite of a purchase probability and a price."""
    return (
        (F.sin(probability) + 1) * F.exp(probability - 1) * F.log1p(price) * F.cos(price / 100)
        * (1 + F.tan(probability * F.pi() / 4))
    )
