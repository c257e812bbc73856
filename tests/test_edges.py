"""Inputs that used to end the job, and promises that must hold for every user and every reopened log."""

import subprocess
import sys
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shortlist.operators import features as feat
from shortlist.operators import metrics as met
from shortlist.operators import profile as prof
from shortlist.plans.draws import sequential_draws
from shortlist.session import durable, hadoop_path, release
from shortlist.sources.log import IterationLog


def test_one_class_and_constant_labels(spark):
    one = spark.createDataFrame([(0.2, 1.0), (0.7, 1.0)], "p double, y double")
    assert met.area_under_roc(one, "p", "y").first()[0] is None
    none = one.withColumn("y", F.lit(0.0))
    assert met.area_under_pr(none, "p", "y").first()[0] is None
    row = met.regression_metrics(one, "p", "y").first()
    assert row["r2"] is None and abs(row["mae"] - 0.55) < 1e-12


def test_no_train_revenue(spark):
    rows = [("a", "train", "total_revenue", 0.0, 1), ("a", "test", "total_revenue", 5.0, 2), ("a", "test", "mrr", 0.5, 2)]
    out = prof.leaderboard(spark.createDataFrame(rows, "model string, phase string, metric string, value double, iter int")).first()
    assert out["change_pct"] is None and out["test_total_revenue"] == 5.0


def test_income_of_minus_one(spark):
    schema = "u_segment string, i_category string, u_income double, i_price double, relevance double, u_user_interaction_count long, " \
             "i_item_popularity long, u_user_avg_relevance double, i_item_avg_relevance double, user_idx long, item_idx long"
    rows = [("s", "c", -1.0, 10.0, 1.0, 2, 3, 0.5, 0.5, 1, 1), ("s", "c", 4.0, 10.0, 0.0, 2, 3, 0.5, 0.5, 2, 1)]
    out = {r["user_idx"]: r for r in feat.interaction_features(spark.createDataFrame(rows, schema)).collect()}
    assert out[1]["price_sensitivity"] is None and out[2]["price_sensitivity"] == 2.0
    assert out[1]["segment_price_sensitivity"] == 2.0


def test_a_reopened_log_knows_its_labels(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(1, 2, 1)], "user_idx long, item_idx long, relevance long")
    IterationLog(spark, path).append(rows, "a b/c")
    again = IterationLog(spark, path)
    assert again.labels == {"a b/c"} and again.read().count() == 1
    with pytest.raises(ValueError, match="already"):
        again.append(rows, "a b/c")
    with pytest.raises(ValueError, match="differ"):
        again.append(rows.withColumn("x", F.lit(1)), "d")
    again.clear()
    with pytest.raises(ValueError, match="empty"):
        again.read()
    with pytest.raises(ValueError, match="already"):
        again.append(rows, "a b/c")
    again.append(rows.withColumn("item_idx", F.lit(9).cast("long")), "e")
    assert [r["item_idx"] for r in again.read().collect()] == [9]


def _lists(draws):
    out = defaultdict(list)
    for r in sorted(draws.collect(), key=lambda r: r["place"]):
        out[r["user_idx"]].append(r["item_idx"])
    return out


def test_asking_for_more_extends_the_list(spark):
    items = spark.range(40).select(F.col("id").alias("item_idx"))
    ask = lambda n: _lists(sequential_draws(spark.createDataFrame([(u, n) for u in range(15)], "user_idx long, wanted long"), items, 4))
    some, more, every = ask(20), ask(21), ask(40)
    assert all(more[u][:20] == some[u] and every[u][:21] == more[u] and sorted(every[u]) == list(range(40)) for u in range(15))


def test_items_without_weight(spark):
    items = spark.createDataFrame([(i, float(i < 5)) for i in range(40)] + [(40, None)], "item_idx long, w double")
    users = spark.createDataFrame([(1, 10), (2, 3)], "user_idx long, wanted long")
    seen = spark.createDataFrame([(1, 0), (1, 30)], "user_idx long, item_idx long")
    got = _lists(sequential_draws(users, items, 4, "w", without=seen))
    assert sorted(got[1]) == [1, 2, 3, 4] and len(got[2]) == 3 and set(got[2]) <= set(range(5))


def test_written_tables_can_be_released(spark):
    table = durable(spark.range(3))
    path, fs = hadoop_path(spark, table._durable_path)
    assert fs.exists(path) and table.count() == 3
    release(table)
    assert not fs.exists(path)


def test_workers_find_the_package_from_another_folder(tmp_path):
    """The Python tasks of a session started elsewhere must import the package, and no table is left."""
    code = f"""
import sys
sys.path.insert(0, {str(__import__('pathlib').Path(__file__).resolve().parents[1])!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2')
         .config('spark.checkpoint.dir', {str(tmp_path / 'shared')!r}).getOrCreate())
import __spark_entry__ as entry
print('ROWS', entry.queries()['rec_graph_revenue'](spark, '/root/testdata/sf0.001').count())
spark.stop()
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert "ROWS 1500" in out.stdout, out.stderr[-2000:]
    left = [p for p in (tmp_path / "shared").rglob("*.parquet")]
    assert left == []
