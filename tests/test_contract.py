"""The fit / predict contract and the storage of fitted statistics."""

import pytest
from pyspark.sql import functions as F

from shortlist.operators import recommend as rec
from shortlist.operators.contract import Hybrid, Popularity, Random, UpperConfidence


@pytest.fixture(scope="module")
def data(spark):
    log = spark.createDataFrame([(u, (u * 3 + j) % 12, (u + j) % 2) for u in range(8) for j in range(4)], "user_idx long, item_idx long, relevance long")
    return log, spark.range(9).withColumnRenamed("id", "user_idx"), spark.range(14).select(F.col("id").alias("item_idx"), F.lit(1.0).alias("price"))


def rows(df):
    return sorted(tuple(r) for r in df.select("user_idx", "item_idx", "relevance", "rank").collect())


def test_models_equal_functions_and_survive_storage(spark, data, tmp_path):
    log, users, items = data
    model = UpperConfidence().fit(log)
    assert rows(model.predict(log, 3, users, items)) == rows(rec.ucb(log, users, items, 3))
    model.save(spark, str(tmp_path / "ucb"))
    again = UpperConfidence().load(spark, str(tmp_path / "ucb"))
    assert rows(again.predict(log, 3, users, items)) == rows(model.predict(log, 3, users, items))
    assert again.score_pairs(spark.createDataFrame([(1, 13)], "user_idx long, item_idx long")).first()["relevance"] == model.fill
    assert rows(Popularity().fit(log).predict(log, 3, users, items)) == rows(rec.popularity(log, users, items, 3))


def test_errors_and_hybrids(spark, data):
    log, users, items = data
    with pytest.raises(RuntimeError):
        Popularity().predict(log, 3, users, items)
    with pytest.raises(ValueError):
        UpperConfidence().fit(log.withColumn("relevance", F.lit(2)))
    both = Hybrid([Popularity(), Random(3)], [2.0, 1.0]).fit(log).predict(log, 3, users, items)
    assert both.groupBy("user_idx").count().filter("count = 3").count() == 9
    assert both.join(log, ["user_idx", "item_idx"]).isEmpty()
    assert {r["relevance"] for r in Hybrid([]).fit(log).predict(log, 2, users, items).collect()} == {0.5}
    free = Random(1).fit(log).predict(None, 14, users, items, filter_seen_items=False)
    assert free.count() == 9 * 14


def test_trained_models_are_stored_and_read_again(spark, tmp_path):
    """Fit, predict, save, and predict the same from a new object that only knows the path."""
    from shortlist.operators.contract import Logistic, Neighbours

    users = spark.createDataFrame([(u, "ab"[u % 2], float(u * 7 % 50)) for u in range(12)], "user_idx long, segment string, income double")
    items = spark.createDataFrame([(i, "xy"[i % 2], 1.0 + i, i % 5) for i in range(10)], "item_idx long, category string, price double, size int")
    log = spark.createDataFrame([(u, (u * 3 + j) % 10, int((u + j) % 3 > 0)) for u in range(12) for j in range(5)], "user_idx long, item_idx long, relevance long")
    for name, model, blank in (("logistic", Logistic(cs=(1.0,), l1s=(0.5,)), Logistic()), ("neighbours", Neighbours(n=3, whole=False), Neighbours())):
        with pytest.raises(RuntimeError):
            model.predict(log, 3, users, items)
        model.fit(log, users, items)
        want = sorted(map(tuple, model.predict(log, 3, users.where("user_idx < 8"), items).collect()))
        seen = {(r.user_idx, r.item_idx) for r in log.collect()}
        assert len(want) == 24 and not {r[:2] for r in want} & seen
        model.save(spark, str(tmp_path / name))
        again = blank.load(spark, str(tmp_path / name))
        assert sorted(map(tuple, again.predict(log, 3, users.where("user_idx < 8"), items).collect())) == want
        assert again.predict(log, 3, users, items, filter_seen_items=False).count() == 36
