"""Comparison of recommenders on later outcomes, by hand."""

import math

from shortlist.operators import evaluation as ev

LOG = "user_idx long, item_idx long, relevance long, iter int, revenue double"


def tables(spark):
    log = spark.createDataFrame(
        [
            (1, 10, 1, 1, 5.0), (1, 11, 0, 1, 2.0), (2, 12, 1, 1, 3.0),
            (1, 12, 1, 2, 7.0), (1, 12, 1, 2, 1.0), (1, 13, 0, 2, 9.0), (2, 10, 1, 2, 4.0),
            (1, 13, 1, 3, 6.0), (3, 10, 1, 3, 8.0),
        ], LOG,
    )
    return log, spark.createDataFrame([(1,), (2,), (3,)], "user_idx long"), spark.createDataFrame([(i,) for i in range(10, 14)], "item_idx long")


def fixed(*items):
    def recommend(log, users, _items, k):
        rows = [(u.user_idx, i, float(9 - p), p + 1) for u in users.collect() for p, i in enumerate(items[:k])]
        return users.sparkSession.createDataFrame(rows, "user_idx long, item_idx long, relevance double, rank int")

    return recommend


def test_lists_meet_what_was_kept_in_each_later_iteration(spark):
    log, users, items = tables(spark)
    phases = [ev.Phase("early", 1, 2), ev.Phase("late", 2)]
    lists = ev.lists_of({"a": fixed(12, 13)}, log, users, items, 2, phases)
    rows = {(r.phase, r.iter, r.user_idx, r.item_idx): (r.response, r.revenue) for r in ev.judged(lists, log, phases).collect()}
    assert rows == {
        ("early", 2, 1, 12): (1, 8.0), ("early", 2, 1, 13): (0, 0.0), ("early", 2, 2, 12): (0, 0.0), ("early", 2, 2, 13): (0, 0.0),
        ("late", 3, 1, 12): (0, 0.0), ("late", 3, 1, 13): (1, 6.0), ("late", 3, 3, 12): (0, 0.0), ("late", 3, 3, 13): (0, 0.0),
    }
    once = ev.judged(ev.lists_of({"a": fixed(12, 13)}, log, users, items, 2, phases[:1]), log, [ev.Phase("early", 1)], ())
    assert {(r.user_idx, r.item_idx): r.response for r in once.collect()} == {
        (1, 12): 1, (1, 13): 1, (2, 12): 0, (2, 13): 0, (3, 12): 0, (3, 13): 0,
    }


def test_models_are_fitted_on_the_past_only_and_compared(spark):
    log, users, items = tables(spark)
    seen = []

    def watching(past, *rest):
        seen.append(max(r.iter for r in past.select("iter").distinct().collect()))
        return fixed(10, 12)(past, *rest)

    out = ev.compare({"a": watching, "b": fixed(12, 10)}, log, users, items, 2, 2, [ev.Phase("test", 1)])
    assert seen == [1]
    got = {(r.model, r.iter, r.metric): r.value for r in out.collect()}
    assert got["a", 2, "precision_at_k"] == got["b", 2, "precision_at_k"] == 0.5
    assert (got["a", 2, "mrr"], got["b", 2, "mrr"]) == (0.75, 0.75)  # users 1 and 2 keep different items
    assert (got["a", 3, "mrr"], got["b", 3, "mrr"]) == (0.5, 0.25)
    assert got["a", 2, "total_revenue"] == 12.0 and math.isclose(got["a", 2, "discounted_revenue"], 4.0 + 8.0 / math.log2(3))
    assert got["a", 3, "hit_rate"] == 0.5 and got["b", 3, "ndcg_at_k"] == 1 / math.log2(3)
