"""The fitted imputer, stored and read again, and the whole-or-nothing append of the log."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from shortlist.operators.impute import Fill, FillModel
from shortlist.sources.log import IterationLog


def test_fill_learns_fills_and_is_stored(spark, tmp_path):
    schema = "id int, a string, b string, c string, x double, y int, z double"
    rows = [(1, "u", "q", None, 1.0, 4, None), (2, "v", None, None, float("nan"), None, None), (3, None, "p", None, 4.0, 7, None), (4, "v", "q", None, None, 1, None),
            (5, "u", "p", None, 1.0, None, None)]
    df = spark.createDataFrame(rows, schema)
    model = Fill(textCols=["a", "b", "c"], numericCols=["x", "y", "z"]).fit(df)
    model.write().overwrite().save(str(tmp_path / "fill"))
    for m in (model, FillModel.load(str(tmp_path / "fill"))):
        got = [tuple(r) for r in m.transform(df).orderBy("id").collect()]
        assert got == [(1, "u", "q", None, 1.0, 4.0, None), (2, "v", "p", None, 2.0, 4.0, None), (3, "u", "p", None, 4.0, 7.0, None),
                       (4, "v", "q", None, 2.0, 1.0, None), (5, "u", "p", None, 1.0, 4.0, None)]
    other = spark.createDataFrame([(9, None, None, "k", None, None, 0.5)], schema)
    assert tuple(model.transform(other).first()) == (9, "u", "p", "k", 2.0, 4.0, 0.5)
    assert Fill(textCols=["a"]).fit(df.limit(0)).transform(df).count() == 5


def frame(spark, n):
    return spark.range(n).select(F.col("id").alias("user_idx"), F.lit(1).alias("relevance"))


def test_a_failed_append_leaves_no_label(spark, tmp_path):
    log = IterationLog(spark, str(tmp_path / "log"))
    log.append(frame(spark, 5), "one")
    broken = frame(spark, 100).withColumn("relevance", F.when(F.col("user_idx") == 77, F.raise_error("broken")).otherwise(F.lit(1)).cast("int"))
    with pytest.raises(Exception, match="broken"):
        log.append(broken, "two")
    assert log.labels == {"one"} and log.read().count() == 5
    log.append(frame(spark, 3), "two")
    assert log.read("two").count() == 3 and [n for n in os.listdir(tmp_path / "log") if n.startswith("_staging")] == []


def test_of_two_writers_one_wins(spark, tmp_path):
    path = str(tmp_path / "log")
    IterationLog(spark, path).append(frame(spark, 2), "base")
    start, errors = threading.Barrier(2), []

    def write(n):
        log = IterationLog(spark, path)
        folders, first = log._folders, []

        def both_look_before_either_writes():
            found = folders()
            if not first:
                first.append(1)
                start.wait(30)
            return found

        log._folders = both_look_before_either_writes
        try:
            log.append(frame(spark, n), "a b/c=1")
        except ValueError as error:
            errors.append(str(error))

    writers = [threading.Thread(target=write, args=(n,)) for n in (10, 20)]
    for w in writers:
        w.start()
    for w in writers:
        w.join(60)
    log = IterationLog(spark, path)
    assert len(errors) == 1 and "already" in errors[0]
    assert log.labels == {"base", "a b/c=1"} and log.read("a b/c=1").count() in (10, 20)
    with pytest.raises(ValueError, match="already"):
        log.append(frame(spark, 1), "a b/c=1")
