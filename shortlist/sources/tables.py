"""Canonical users, items and interaction tables, and the schemas of derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAST_TRAIN_YEAR = 1998


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_idx"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("income")
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_idx"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("size"),
        F.col("p_brand").alias("brand"),
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: who took what, when, and whether it was kept."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )
    return lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("user_idx"),
        F.col("l_partkey").alias("item_idx"),
        kept("l_returnflag").alias("relevance"),
        F.year("o_orderdate").alias("iter"),
        F.col("o_orderdate").alias("ts"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("revenue"),
    )


def kept(flag: str):
    return F.when(F.col(flag) == "R", F.lit(0)).otherwise(F.lit(1)).cast("long")


def item_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the log that item statistics need: no join to the orders."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("item_idx"), kept("l_returnflag").alias("relevance")
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("item_idx"), F.col("embedding").cast("array<double>").alias("vec")
    )


SEQUENCE_ORDER = ["ts", "l_orderkey", "l_linenumber", "item_idx"]


def day(ts: str = "ts"):
    """Slice of time used to split the sequence of a very active user."""
    return F.date_trunc("day", F.col(ts))


def rating_schema(
    user: str = "user_idx",
    item: str = "item_idx",
    timestamp: str | None = "timestamp",
    rating: str | None = "relevance",
    wide_ids: bool = False,
) -> T.StructType:
    """Schema of a rating-like table; the time and rating columns are optional."""
    key = T.LongType() if wide_ids else T.IntegerType()
    fields = [T.StructField(user, key), T.StructField(item, key)]
    if timestamp:
        fields.append(T.StructField(timestamp, T.TimestampType()))
    if rating:
        fields.append(T.StructField(rating, T.DoubleType()))
    return T.StructType(fields)


RECOMMENDATIONS = rating_schema(timestamp=None, wide_ids=True)


def empty(spark: SparkSession, schema: T.StructType = RECOMMENDATIONS) -> DataFrame:
    return spark.createDataFrame([], schema)


def from_pandas(spark: SparkSession, frame, schema: T.StructType | None = None) -> DataFrame:
    """Local pandas table to DataFrame; anything else, or an empty table, is an error."""
    import pandas as pd

    if not isinstance(frame, pd.DataFrame):
        raise ValueError(f"expected a pandas DataFrame, got {type(frame).__name__}")
    if frame.empty:
        raise ValueError("the table is empty")
    return spark.createDataFrame(frame, schema=schema)


def labelled_ids(spark: SparkSession, n: int, label: str, key: str = "user_idx", partitions: int | None = None) -> DataFrame:
    return spark.range(0, n, 1, partitions).select(F.concat(F.lit(f"{label}_"), F.col("id").cast("string")).alias(key))


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_dataset(path: str, users: DataFrame | None = None, items: DataFrame | None = None, log: DataFrame | None = None) -> None:
    """Write whichever of the three tables exist."""
    for name, df in (("users", users), ("items", items), ("history", log)):
        if df is not None:
            write_table(df, f"{path}/{name}.parquet")


def load_dataset(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}.parquet") for name in ("users", "items", "history")}
