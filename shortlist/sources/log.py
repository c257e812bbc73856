"""Interaction log stored as one Parquet directory, partitioned by iteration label."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortlist.session import hadoop_path

ITERATION = "__iter"


class IterationLog:
    """Append-only log. The first write pins the columns; labels cannot be reused.

    Labels and columns are read from the directory itself, so every object on the same path sees
    the same log.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self.hidden: set[str] = set()

    def _folders(self) -> dict[str, str]:
        """Label -> folder of everything that was ever written."""
        path, fs = hadoop_path(self.spark, self.path)
        if not fs.exists(path):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        return {unquote(n[len(ITERATION) + 1 :]): f"{self.path}/{n}" for n in names if n.startswith(f"{ITERATION}=")}

    @property
    def labels(self) -> set[str]:
        return set(self._folders()) - self.hidden

    @property
    def schema(self) -> T.StructType | None:
        """Columns of the log; after ``clear`` the next write pins them anew."""
        folders = self._folders()
        visible = sorted(set(folders) - self.hidden)
        return self.spark.read.parquet(folders[visible[0]]).schema if visible else None

    def append(self, df: DataFrame, label: str) -> None:
        """Add ``df`` under a new label, whole or not at all.

        The rows are written to a folder that readers skip and moved into place by one rename, which
        fails if the label has come into being meanwhile: of two writers one wins, and the other, or
        a write that breaks off, leaves nothing behind. An empty table adds no label.
        """
        label = str(label)
        if label in self._folders():
            raise ValueError(f"iteration {label!r} is already in the log")
        self.check(df)
        staging = f"{self.path}/_staging-{uuid.uuid4().hex}"
        path, fs = hadoop_path(self.spark, staging)
        try:
            df.withColumn(ITERATION, F.lit(label)).write.partitionBy(ITERATION).parquet(staging)
            for name in [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]:
                self._move(f"{staging}/{name}", f"{self.path}/{name}", label)
        finally:
            fs.delete(path, True)

    def _move(self, source: str, target: str, label: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        (old, _), (new, _) = hadoop_path(self.spark, source), hadoop_path(self.spark, target)
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), conf).rename(old, new, options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise ValueError(f"iteration {label!r} is already in the log") from None
            raise

    def check(self, df: DataFrame) -> None:
        """Same names and types as the first write, in any order; nullability does not count."""
        schema = self.schema
        if schema is None:
            return
        have = {(f.name, f.dataType) for f in df.schema.fields}
        want = {(f.name, f.dataType) for f in schema.fields}
        if have != want:
            show = lambda fields: sorted(f"{n}: {t.simpleString()}" for n, t in fields)
            raise ValueError(f"columns differ: unexpected {show(have - want)}, missing {show(want - have)}")

    def read(self, *labels: str) -> DataFrame:
        """The whole log, or some iterations: the filter prunes directories."""
        schema = self.schema
        if schema is None:
            raise ValueError("the log is empty")
        stored = T.StructType(schema.fields + [T.StructField(ITERATION, T.StringType())])
        df = self.spark.read.schema(stored).parquet(self.path)
        if self.hidden:
            df = df.filter(~F.col(ITERATION).isin(sorted(self.hidden)))
        return df.filter(F.col(ITERATION).isin([str(x) for x in labels])) if labels else df

    def clear(self) -> None:
        """Forget what was written so far. The files stay, and their labels stay used."""
        self.hidden = set(self._folders())


def user_log(log: DataFrame, users: DataFrame) -> DataFrame:
    return log.join(users.select("user_idx").distinct(), "user_idx", "left_semi")
