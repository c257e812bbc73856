import numpy as np
import pytest
from pyspark.sql import functions as F

from shortlist.operators import features as feat
from shortlist.operators import logistic_grid, models as md
from shortlist.operators import recommend as rec
from shortlist.operators import sampling as smp
from shortlist.session import durable


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(4)
    users = spark.createDataFrame([(u, "AB"[u % 2], float(rng.normal() * 50)) for u in range(12)], "user_idx long, segment string, income double")
    items = spark.createDataFrame([(i, "XYZ"[i % 3], float(i * 7 % 11 + 1)) for i in range(9)], "item_idx long, category string, price double")
    rows = [(int(rng.integers(12)), int(rng.integers(9)), int(rng.integers(2))) for _ in range(150)]
    return spark.createDataFrame(rows, "user_idx long, item_idx long, relevance long"), users, items


def test_short_vectors_give_the_margin_of_the_features(spark, tables):
    """products that share a user or an item value are one place of the vectors."""
    log, users, items = tables
    features = md.factored_features(log, users, items)
    weights = np.random.default_rng(2).normal(size=len(features.names))
    u, v = features.vectors(weights, 0.25)
    assert len(u.first()["vec"]) == len(v.first()["vec"]) < features.spans[-1][1] / 2
    got = {(a.user_idx, b.item_idx): float(np.dot(a.vec, b.vec)) for a in u.collect() for b in v.collect()}
    for r in features.rows(log).collect():
        want = float(r.features.toArray() @ weights + 0.25)
        assert np.isclose(got[r.user_idx, r.item_idx], want, rtol=1e-12, atol=1e-9 * np.abs(r.features.toArray() * weights).sum())


@pytest.mark.parametrize("twice", [False, True])
def test_folds_of_narrow_rows_are_those_of_wide_rows(spark, tables, twice):
    """rows get their folds before their features, and stored rows are not stored again."""
    log, users, items = tables
    log = log.unionByName(spark.createDataFrame([(77, 1, 1), (3, 77, 0), (None, 2, 1)], log.schema))  # not in the tables
    users = users.unionByName(users.limit(2)) if twice else users
    key = ["user_idx", "item_idx"]
    features = md.factored_features(log, users, items)
    rows = durable(features.rows(md.folded(features, log, 5, key, 7)))
    assert ("fold" in rows.columns) is not twice
    wide = smp.stratified_folds(features.rows(log), "label", 5, 7, key)
    folds = rows if not twice else md._folds(rows, 5, key, 7)
    assert sorted(map(str, folds.select(*key, "label", "fold").collect())) == sorted(map(str, wide.select(*key, "label", "fold").collect()))
    if twice:
        return
    assert not hasattr(logistic_grid._Rows(rows, 5).table, "_durable_path")
    a = md.search_logistic(rows, key, (1.0,), (0.5,), 5, 7)
    b = md.search_logistic(features.rows(log), key, (1.0,), (0.5,), 5, 7)
    assert np.allclose(a.coefficients.toArray(), b.coefficients.toArray(), atol=1e-7)


def test_content_reads_the_log_once(spark):
    """profiles, seen pairs and cold users come from the rows that matter, stored once."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    log = spark.createDataFrame([(u, i, 1) for u in range(4) for i in range(u, 6)], "user_idx long, item_idx long, relevance long")
    users = spark.createDataFrame([(0,), (1,), (9,)], "user_idx long")
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "item_idx long, vec array<double>")
    out = rec.content(log.mapInArrow(counted, log.schema), users, vectors, 2, 3, threshold=-1.0)
    got = {(r.user_idx, r.item_idx) for r in out.collect()}
    assert read.value == log.count()
    assert {i for u, i in got if u == 1} == {0} and not {i for u, i in got if u == 0} and sum(u == 9 for u, _ in got) == 3


def test_wide_rows_are_not_shuffled_for_the_diversity(spark, tables, monkeypatch):
    """F8: large tables take two joins of the wide rows by user or item, not three; the columns that follow from a row come last."""
    log, users, items = tables
    joined = durable(feat.joined_features(log, users, items))
    want = feat.interaction_features(joined, users, items).collect()
    wide = []

    def large(fact, dim, key, how="inner", dim_rows=None, heavy_in=None):
        if "i_price" in fact.columns and dim_rows is not None or key == ["user_idx", "i_category"]:
            wide.append((str(key), "price_sensitivity" in fact.columns))
        return fact.join(dim, key, how)

    monkeypatch.setattr(feat, "lookup", large)
    got = feat.interaction_features(joined, users, items)
    assert wide == [("['user_idx', 'i_category']", False), ("item_idx", False)]
    columns = sorted(got.columns)
    plain = lambda rows: sorted(str([round(r[c], 9) if isinstance(r[c], float) else r[c] for c in columns]) for r in rows)
    assert plain(got.collect()) == plain(want)
    kinds = {r.user_idx: r.n for r in joined.groupBy("user_idx").agg(F.count_distinct("i_category").alias("n")).collect()}
    assert all(r["category_diversity"] == kinds[r["user_idx"]] for r in want)
