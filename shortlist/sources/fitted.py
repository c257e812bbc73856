"""Fitted statistics on storage: tables as Parquet, scalar parameters as a one-row table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def save_fitted(spark: SparkSession, path: str, tables: dict[str, DataFrame], params: dict) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    row = [(json.dumps(params), sorted(tables))]
    spark.createDataFrame(row, "params string, tables array<string>").coalesce(1).write.mode("overwrite").parquet(f"{path}/_params")


def load_fitted(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], dict]:
    row = spark.read.parquet(f"{path}/_params").first()
    return {name: spark.read.parquet(f"{path}/{name}") for name in row["tables"]}, json.loads(row["params"])
