"""Small hand-made tables: edge cases, error paths, and models against brute force."""

import math
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortlist.functions.randomness import normal, uniform
from shortlist.operators import features as feat
from shortlist.operators import graph, metrics as mt, models as md, popularity as pop, profile as prof
from shortlist.operators import recommend as rec, response as rs, sampling as smp
from shortlist.operators.sequences import Sequences
from shortlist.sources import tables as tb
from shortlist.sources.log import IterationLog, user_log
from shortlist.streaming.item_stats import item_stats_stream, read_log

LOG = [(1, 10, 1), (1, 11, 0), (1, 12, 1), (2, 10, 1), (2, 13, 0), (2, 10, 1)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def small(spark):
    """Users 1..3, items 10..14; user 3 has no history, item 14 was never taken."""
    log = spark.createDataFrame(LOG, "user_idx long, item_idx long, relevance long")
    users = spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0), (3, "a", 30.0)], "user_idx long, segment string, income double")
    items = spark.createDataFrame(
        [(10, "x", 5.0), (11, "y", 6.0), (12, "x", 7.0), (13, "y", 8.0), (14, "x", 9.0)], "item_idx long, category string, price double"
    )
    return log, users, items


# --- sources --------------------------------------------------------------------------------


def test_log_rules(spark, small, tmp_path):
    log = IterationLog(spark, str(tmp_path / "log"))
    with pytest.raises(ValueError):
        log.read()
    first = small[0]
    log.append(first, "start")
    with pytest.raises(ValueError, match="already"):
        log.append(first, "start")
    with pytest.raises(ValueError, match="unexpected"):
        log.append(first.withColumn("extra", F.lit(1)), "0")
    with pytest.raises(ValueError, match="relevance: int"):
        log.append(first.withColumn("relevance", F.col("relevance").cast("int")), "0")
    strict = spark.createDataFrame(first.collect(), T.StructType([T.StructField(f.name, f.dataType, False) for f in first.schema]))
    log.append(strict.select("relevance", "item_idx", "user_idx"), 0)
    assert log.read().count() == 12 and log.read("0").count() == 6
    assert "PartitionFilters: [isnotnull" in log.read("0")._jdf.queryExecution().toString()
    log.clear()
    log.append(first.withColumn("extra", F.lit(1)), "start2")


def test_small_sources(spark, small, tmp_path):
    with pytest.raises(ValueError):
        tb.from_pandas(spark, [1, 2])
    with pytest.raises(ValueError):
        tb.from_pandas(spark, pd.DataFrame({"a": []}))
    assert rows(tb.from_pandas(spark, pd.DataFrame({"a": [1, 2]}))) == [(1,), (2,)]
    assert tb.empty(spark).columns == ["user_idx", "item_idx", "relevance"] and tb.empty(spark).isEmpty()
    assert tb.rating_schema("u", "i", rating=None).names == ["u", "i", "timestamp"]
    assert rows(tb.labelled_ids(spark, 3, "s", partitions=2)) == [("s_0",), ("s_1",), ("s_2",)]
    tb.save_dataset(str(tmp_path), *[small[i] for i in (1, 2, 0)])
    assert rows(tb.load_dataset(spark, str(tmp_path))["history"]) == rows(small[0])


def test_user_log(small):
    log, users, _ = small
    assert {r["user_idx"] for r in user_log(log, users.filter("user_idx <> 1")).collect()} == {2}


# --- popularity -----------------------------------------------------------------------------


def test_label_check(spark):
    ok = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "item_idx long, relevance long")
    pop.check_labels(ok)
    with pytest.raises(ValueError):
        pop.check_labels(ok.unionByName(spark.createDataFrame([(1, 2)], ok.schema)))


def test_ucb_scores_and_fill(small):
    log, users, items = small
    n = len(LOG)
    got = dict(rows(pop.ucb_table(log, items)))
    assert math.isclose(got[10], 3 / 3 + math.sqrt(math.log(2 * n) / 3))
    assert math.isclose(got[14], 1 + math.sqrt(math.log(2 * n)))
    pairs = items.select(F.lit(3).alias("user_idx"), "item_idx")
    assert math.isclose({r["item_idx"]: r["relevance"] for r in rec.scored_pairs(pairs, log).collect()}[14], got[14])


def test_empty_log(small):
    log, users, items = small
    none = log.filter("false")
    assert {r["relevance"] for r in pop.popularity_table(none, items).collect()} == {0.5}
    assert [r["item_idx"] for r in rec.ucb(none, users, items, 2).filter("user_idx = 3").orderBy("rank").collect()] == [14, 13]


def test_lists_of_short_catalogues(small):
    log, users, items = small
    got = defaultdict(list)
    for r in rec.popularity(log, users, items, 4).orderBy("rank").collect():
        got[r["user_idx"]].append(r["item_idx"])
    assert len(got[1]) == 2 and len(got[2]) == 3 and len(got[3]) == 4  # fewer unseen items than asked for
    raw = rec.ucb_raw(log, users, items, 1)
    assert {u: raw.filter(F.col("user_idx") == u).count() for u in (1, 2, 3)} == {1: 4, 2: 3, 3: 1}
    assert rows(pop.max_history(log, users)) == [(3,)]


def test_random_lists(small):
    log, users, items = small
    got = rec.random_topk(log, users, items, 3, 5)
    for u in (1, 2, 3):
        mine = got.filter(F.col("user_idx") == u).orderBy("rank").collect()
        seen = {i for v, i, _ in LOG if v == u}
        assert len(mine) == min(3, 5 - len(seen)) and not seen & {r["item_idx"] for r in mine}
        assert [r["relevance"] for r in mine] == sorted((r["relevance"] for r in mine), reverse=True)
    assert rows(got) == rows(rec.random_topk(log.repartition(7), users.repartition(3), items.repartition(2), 3, 5))


def test_sampled_lists(small):
    log, users, items = small
    got = rec.ucb_sampled(log, users, items, 2, 1).collect()
    n = defaultdict(int)
    for r in got:
        n[r["user_idx"]] += 1
    assert n == {1: 5, 2: 4, 3: 2}
    share = {r["item_idx"]: r["probability"] for r in pop.score_share(pop.ucb_table(log, items)).collect()}
    assert all(math.isclose(r["relevance"], share[r["item_idx"]], abs_tol=1e-11) for r in got)


def test_hybrid_counts_missing_scores_as_zero(spark, small):
    a = spark.createDataFrame([(1, 10, 0.8)], "user_idx long, item_idx long, relevance double")
    b = spark.createDataFrame([(1, 11, 0.6), (1, 10, 0.2)], "user_idx long, item_idx long, relevance double")
    got = rec.hybrid([a, b], small[2], 2, [1.0, 3.0]).orderBy("rank").collect()
    assert [(r["item_idx"], round(r["relevance"], 9), r["price"]) for r in got] == [(11, 0.45, 6.0), (10, 0.35, 5.0)]


def test_neutral_lists(small):
    got = rec.neutral(small[1], small[2], small[0], 2).filter("user_idx = 3").orderBy("rank").collect()
    assert [(r["item_idx"], r["relevance"]) for r in got] == [(14, 0.5), (13, 0.5)]


# --- content --------------------------------------------------------------------------------


def test_content_profiles_and_cold_users(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [-1.0, 0.0])], "item_idx long, vec array<double>")
    log = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (2, 2, 0)], "user_idx long, item_idx long, relevance long")
    users = spark.range(1, 4).withColumnRenamed("id", "user_idx")
    profile = {r["user_idx"]: r["vec"] for r in prof.user_profiles(log, vectors, 2).collect()}
    assert profile == {1: [1.0, 0.0], 2: [0.0, 0.0]}
    got = defaultdict(list)
    for r in rec.content(log, users, vectors, 2, 3, seed=1).orderBy("rank").collect():
        got[r["user_idx"]].append((r["item_idx"], round(r["relevance"], 6)))
    assert got[1] == [(3, round(1 / math.sqrt(2), 6)), (2, 0.0)]  # the opposite vector is below the threshold
    assert got[2] == [(4, 0.0), (3, 0.0)]  # zero profile: similarity 0 with all
    assert len(got[3]) == 3  # no profile: random items


# --- responses and metrics ------------------------------------------------------------------


def test_responses(spark, small):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 1.0), (1, 3, 0.0)], "user_idx long, item_idx long, p double")
    assert [r["response"] for r in rs.bernoulli(df, "p").orderBy("item_idx").collect()][:2] == [0, 1]
    free = rs.noise(df, 0.0, 1.0, clip=False, seed=3).collect()
    kept = rs.noise(df, 0.0, 1.0, clip=True, seed=3).collect()
    assert all(b["noise"] == max(a["noise"], 0.0) for a, b in zip(free, kept))
    with pytest.raises(ValueError):
        rs.angular(df, ["p"])
    with pytest.raises(ValueError):
        rs.weighted(df, ["p"], [1.0, 2.0])
    # two stages with one seed do not repeat each other
    both = rs.noise(rs.noise(df, output="a", seed=3), output="b", seed=3).collect()
    assert all(r["a"] != r["b"] for r in both)
    vector = spark.createDataFrame([(Vectors.dense([1.0, 2.5]),)], ["v"])
    assert rs.VectorElement(inputCol="v", index=1, outputCol="e").transform(vector).first()["e"] == 2.5


def test_response_stage_round_trip(spark, tmp_path):
    stage = rs.NoiseStage(mean=0.5, std=0.1, outputCol="n", seed=4)
    stage.save(str(tmp_path / "stage"))
    again = rs.NoiseStage.load(str(tmp_path / "stage"))
    df = spark.createDataFrame([(1, 1), (2, 1)], "user_idx long, item_idx long")
    assert rows(stage.transform(df)) == rows(again.transform(df))


def test_ranking_metrics(spark):
    lists = {1: [1, 0, 0], 2: [0, 0, 0], 3: [0, 1]}
    data = [(u, 10 + i, 1.0 / (i + 1), i + 1, r, r * 10.0) for u, rs_ in lists.items() for i, r in enumerate(rs_)]
    df = spark.createDataFrame(data, "user_idx long, item_idx long, relevance double, rank int, response int, revenue double")
    value = lambda d: d.first()[0]
    assert math.isclose(value(mt.precision_at_k(df, 2)), (0.5 + 0 + 0.5) / 3)
    assert math.isclose(value(mt.ndcg_at_k(df, 2)), (1 + 1 / math.log2(3)) / 2)
    assert math.isclose(value(mt.mrr(df)), (1 + 0 + 0.5) / 3)
    assert math.isclose(value(mt.hit_rate(df, 2)), 2 / 3)
    assert math.isclose(value(mt.discounted_revenue(df, 2)), 10 + 10 / math.log2(3))
    late = spark.createDataFrame([(1, i, 0.0, i, int(i == 4), 0.0) for i in range(1, 5)], df.schema)
    assert value(mt.hit_rate(late, 2)) == 0 and value(mt.mrr(late)) == 0.25
    assert mt.ensure_rank(df.drop("rank")).filter("user_idx = 1").orderBy("item_idx").collect()[0]["rank"] == 1
    long = {r["metric"]: r["value"] for r in mt.iteration_metrics(df.withColumn("it", F.lit(0)), 2, ["it"]).collect()}
    assert math.isclose(long["ndcg_at_k"], value(mt.ndcg_at_k(df, 2))) and math.isclose(long["mrr"], 0.5)


def test_metrics_match_spark_ml(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator

    rng = np.random.default_rng(0)
    data = [(float(np.round(rng.random(), 1)), float(rng.integers(0, 2))) for _ in range(200)]
    df = spark.createDataFrame(data, "prediction double, label double")
    mine = {r["metric"]: r["value"] for r in mt.evaluate(df, list(mt.REGRESSION) + list(mt.MULTICLASS) + ["areaUnderROC", "areaUnderPR"]).collect()}
    for name in mt.REGRESSION:
        assert math.isclose(mine[name], RegressionEvaluator(metricName=name).evaluate(df), abs_tol=1e-12), name
    crisp = df.withColumn("prediction", F.when(F.col("prediction") >= 0.5, 1.0).otherwise(0.0))
    for name in mt.MULTICLASS:
        assert math.isclose(mine[name], MulticlassClassificationEvaluator(metricName=name).evaluate(crisp), abs_tol=1e-12), name
    for name in ("areaUnderROC", "areaUnderPR"):
        want = BinaryClassificationEvaluator(rawPredictionCol="prediction", metricName=name, numBins=0).evaluate(df)
        assert math.isclose(mine[name], want, abs_tol=1e-9), name
    with pytest.raises(ValueError):
        mt.evaluate(df, ["nothing"])


def test_large_paths_of_distribution_metrics(spark):
    a = spark.createDataFrame([(float(v),) for v in (1, 1, 2, 5, 9)], "a double")
    b = spark.createDataFrame([(float(v),) for v in (1, 3, 4, 9)], "b double")
    assert math.isclose(mt.ks_statistic(a, b, small=1).first()[0], mt.ks_statistic(a, b).first()[0])
    assert math.isclose(mt.ks_statistic(a, b).first()[0], 0.35)


def test_kl_against_numpy(spark):
    rng = np.random.default_rng(2)
    p, y = np.round(rng.normal(size=80), 3), np.round(rng.normal(size=50), 3)
    obs, edges = np.histogram(y)
    exp = np.histogram(p, bins=edges)[0]
    o, e = obs + 1e-5, exp + 1e-5
    want = 1 / (1 + (o * np.log(o / e) - o + e).sum())
    got = mt.kl_normalized(*[spark.createDataFrame([(float(v),) for v in x], "v double") for x in (p, y)]).first()[0]
    assert math.isclose(got, want, rel_tol=1e-9)


# --- features -------------------------------------------------------------------------------


def test_scalars(spark):
    df = spark.createDataFrame([(1, 2, 0.7), (1, 3, 1.9), (1, 4, -0.7)], "user_idx long, item_idx long, relevance double")
    assert [r["relevance"] for r in feat.truncated_log(df).orderBy("item_idx").collect()] == [0, 1, 0]
    assert [r["relevance"] for r in feat.binarized(df).orderBy("item_idx").collect()] == [1, 1, 0]
    text = spark.createDataFrame([("1.5",), ("x",), ("NaN",), ("Infinity",), (None,)], "s string")
    assert [r[0] for r in text.select(feat.to_number("s")).collect()] == [1.5, 0.0, 0.0, 0.0, 0.0]
    twice = df.select("item_idx", "relevance", "item_idx")
    assert feat.first_of_duplicates(twice).columns == ["item_idx", "relevance"]
    assert feat.columns_by_type(df.withColumn("c", F.lit("x")), ("user_idx",)) == (["c"], ["item_idx", "relevance"])
    assert feat.starting_with(df, "i") == ["item_idx"]


def test_levels(spark):
    same = spark.createDataFrame([(4.0,)] * 3, "v double")
    assert {r["l"] for r in feat.quantile_level(same, "v", "l").collect()} == {"medium"}
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    got = [r["l"] for r in feat.quantile_level(df, "v", "l").orderBy("v").collect()]
    assert got == ["very_low"] * 3 + ["low"] * 2 + ["medium"] * 2 + ["high"] * 2 + ["very_high"] * 2


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 9.9, 10.0)], "v double")
    assert rows(prof.histogram(df, "v", 10)) == [(0, 1), (1, 1), (9, 2)]


def test_one_row_group_has_no_deviation(small):
    stats = {r["item_idx"]: r["item_relevance_std"] for r in feat.item_stats(small[0]).collect()}
    assert stats[11] is None and stats[10] == 0.0


def test_encoding(spark, small):
    items = small[2]
    codes = feat.label_codes(items, "category")
    unseen = spark.createDataFrame([("z",), ("y",)], "category string")
    assert rows(feat.label_encoded(unseen, "category", codes)) == [("y", 1), ("z", 0)]
    constant = feat.standard_scaled(items.withColumn("c", F.lit(3.0)), ["c", "price"])
    assert {r["c"] for r in constant.collect()} == {0.0}
    assert rows(feat.impute_values(items, ["category"], ["price"])) == [("category", "x"), ("price", "7.0")]


# --- sampling -------------------------------------------------------------------------------


def test_seeds_and_sampling(spark):
    a, b = smp.seeds(5), smp.seeds(5)
    first = [next(a) for _ in range(3)]
    assert first == [next(b) for _ in range(3)] and len(set(first)) == 3 and next(smp.seeds(None)) is None
    df = spark.range(100)
    with pytest.raises(ValueError):
        smp.generate(df, 101, 1, ["id"])
    assert smp.generate(df, 7, 1, ["id"]).count() == 7
    assert rows(smp.exactly(df.repartition(9), 7, 1, ["id"])) == rows(smp.exactly(df, 7, 1, ["id"]))
    assert smp.capped(df, 100, 1, ["id"]).count() == 100 and smp.capped(df, 40, 1, ["id"]).count() == 40


def test_composite(spark):
    a, b, none = spark.range(10), spark.range(100, 130), spark.range(0)
    c = smp.Composite([a, b, none], ["id"])
    assert c.weights == [0.25, 0.75, 0.0]
    assert [p.count() for p in c.generate(10, 1).sources] == [2, 8, 0]  # 2.5 and 7.5 to even
    assert c.sample(1.0, 1).count() == 40
    with pytest.raises(ValueError):
        smp.Composite([a, b], ["id"], [0.9, 0.1]).sample(0.5, 1)


def test_folds_are_balanced(spark):
    df = spark.range(103).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    counts = smp.stratified_folds(df, "label", 5, 1, ["id"]).groupBy("label", "fold").count().collect()
    for label in (0, 1):
        n = [r["count"] for r in counts if r["label"] == label]
        assert max(n) - min(n) <= 1 and len(n) == 5


def test_random_columns(spark):
    r = spark.range(20000).select(uniform(1, "id").alias("u"), normal(1, "id").alias("n")).agg(
        F.avg("u"), F.min("u"), F.max("u"), F.avg("n"), F.stddev("n")
    ).first()
    assert abs(r[0] - 0.5) < 0.01 and r[1] >= 0 and r[2] < 1 and abs(r[3]) < 0.03 and abs(r[4] - 1) < 0.03


# --- sequences, graph -----------------------------------------------------------------------


def test_ngrams_skip_short_sequences(spark):
    log = spark.createDataFrame([(1, t, i) for t, i in enumerate([5, 6, 7, 6, 7, 8])] + [(2, 0, 5), (2, 1, 6)], "user_idx long, t long, item_idx long")
    seq = Sequences(log, ["t"], F.col("t"), heavy=[1], block=2)
    got = {(tuple(r["context"]), r["item_idx"]): r["n"] for r in seq.ngrams(2).collect()}
    assert got == {((5, 6), 7): 1, ((6, 7), 6): 1, ((7, 6), 7): 1, ((6, 7), 8): 1}
    assert {r["user_idx"]: r["context"] for r in seq.last_contexts(2).collect()} == {1: [7, 8], 2: [5, 6]}
    assert {r["user_idx"]: (r["sequence"], r["length"]) for r in seq.padded(4).collect()} == {1: ([7, 6, 7, 8], 6), 2: ([0, 0, 5, 6], 2)}


def test_graph_hop(spark):
    nodes = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0)], "node long, f double")
    e = spark.createDataFrame([(0, 2, 1.0), (1, 2, 3.0)], "src long, dst long, w double")
    got = dict(rows(graph.propagate(nodes, e, ["f"], 1)))
    assert math.isclose(got[2], 3.0 / 5 + (1 * 1.0 + 3 * 2.0) / math.sqrt(5)) and got[0] == 1.0
    # one more hop equals a product with the normalized adjacency matrix
    both = graph.reversed_too(e)
    a = np.array([[0, 0, 1.0], [0, 0, 3.0], [1.0, 3.0, 0]])
    deg = 1 + a.sum(axis=0)
    m = np.diag(1 / deg) + a / np.sqrt(np.outer(deg, deg))
    want = m.T @ m.T @ np.array([1.0, 2.0, 3.0])
    got = dict(rows(graph.propagate(nodes, both, ["f"], 2)))
    assert np.allclose([got[i] for i in range(3)], want)


# --- neighbours and models ------------------------------------------------------------------


def test_knn_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x, y = np.round(rng.normal(size=(80, 3)), 2), rng.integers(0, 2, 80)
    q = np.round(rng.normal(size=(24, 3)), 2)
    train = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i])) for i in range(80)], "row_id long, vec array<double>, label long")
    pairs = [(i // 6, i % 6, [float(v) for v in q[i]]) for i in range(24)]
    cand = spark.createDataFrame(pairs, "user_idx long, item_idx long, vec array<double>")
    log = spark.createDataFrame([(0, 0), (1, 3)], "user_idx long, item_idx long")
    got = rec.knn(cand, train, log, 3, 5, whole=False, cell_items=10, block_items=4, slot_queries=5)
    want = []
    for u in range(4):
        scored = []
        for p, (v, i, vec) in enumerate(pairs):
            if v == u and (u, i) not in {(0, 0), (1, 3)}:
                d = np.sqrt(((x - np.array(vec)) ** 2).sum(axis=1))
                near = sorted(range(80), key=lambda j: (round(d[j], 9), -j))[:5]
                w = 1 / (np.round(d[near], 9) + 1e-10)
                scored.append((round(float((w * y[near]).sum() / w.sum()), 6), i))
        want += [(u, i) for _, i in sorted(scored, reverse=True)[:3]]
    assert [(r["user_idx"], r["item_idx"]) for r in got.orderBy("user_idx", "rank").collect()] == want


def _all_pairs(x, y, users, items, seen, k, n, whole):
    out = []
    for u, uv in users:
        scored = []
        for i, iv in items:
            if (u, i) not in seen:
                d = np.round(np.sqrt(((x - np.array([*uv, *iv])) ** 2).sum(axis=1)), 9)
                near = sorted(range(len(x)), key=lambda j: (d[j], -j))[:n]
                w = 1 / (d[near] + 1e-10)
                p = float((w * y[near]).sum() / w.sum())
                scored.append((float(np.rint(p)) if whole else round(p, 6), i))
        out += [(u, i, s) for s, i in sorted(scored, reverse=True)[:k]]
    return out


@pytest.mark.parametrize(("whole", "share"), [(True, 0.6), (True, 0.1), (False, 0.7), (True, 0.0)])
def test_knn_over_the_whole_catalogue(spark, whole, share):
    """Also where hardly any pair gets the largest score, so that all items must be looked at."""
    rng = np.random.default_rng(5)
    x, y = np.round(rng.normal(size=(90, 3)), 2), (rng.random(90) < share).astype(int)
    users = [(u, [float(v)]) for u, v in enumerate(np.round(rng.normal(size=5), 1))] + [(5, [0.3]), (6, [0.3])]
    items = [(i, [float(v) for v in row]) for i, row in enumerate(np.round(rng.normal(size=(40, 2)), 1))]
    seen = {(0, i) for i in range(30, 40)} | {(1, i) for i in range(38)} | {(4, 39), (4, 7)}
    train = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i])) for i in range(90)], "row_id long, vec array<double>, label long")
    got = rec.knn_catalogue(
        spark.createDataFrame(users, "user_idx long, vec array<double>"), spark.createDataFrame(items, "item_idx long, vec array<double>"), train,
        spark.createDataFrame(sorted(seen), "user_idx long, item_idx long"), 4, 3, whole=whole, first=5, cell_items=20,
    )
    rows = [(r.user_idx, r.item_idx, r.relevance) for r in got.orderBy("user_idx", "rank").collect()]
    assert rows == _all_pairs(x, y, users, items, seen, 4, 3, whole)


def test_knn_rounds_share_the_cells_of_the_training_rows(spark, monkeypatch):
    built = []
    first = rec.Cells.__init__
    monkeypatch.setattr(rec.Cells, "__init__", lambda self, *args: built.append(1) or first(self, *args))
    users = spark.createDataFrame([(1, [0.5]), (2, [0.1])], "user_idx long, vec array<double>")
    items = spark.createDataFrame([(i, [i / 10]) for i in range(12)], "item_idx long, vec array<double>")
    train = spark.createDataFrame([(i, [i / 9, i / 9], int(i == 0)) for i in range(9)], "row_id long, vec array<double>, label long")
    assert rec.knn_catalogue(users, items, train, None, 3, 2, first=2).count() == 6
    assert len(built) == 1  # three rounds


def test_choose_neighbours_searches_once(spark, monkeypatch):
    monkeypatch.setattr("shortlist.plans.skew.is_small", lambda df: False)  # as with many rows
    found = spark.sparkContext.accumulator(0)

    def counted(*args, **blocks):
        near = rec.neighbours(*args, **blocks)

        def count(batches):
            for batch in batches:
                found.add(batch.num_rows)
                yield batch

        return near.mapInArrow(count, near.schema)

    monkeypatch.setattr(md, "neighbours", counted)
    train = spark.createDataFrame([(i, [i / 7, i % 5 / 5], i % 2) for i in range(60)], "row_id long, vec array<double>, label int")
    assert md.choose_neighbours(train, ns=(3, 5), folds=3).count() == 2
    assert found.value == 60 * 5


def test_knn_without_training_rows_or_items(spark):
    users = spark.createDataFrame([(1, [0.5])], "user_idx long, vec array<double>")
    items = spark.createDataFrame([(1, [0.5])], "item_idx long, vec array<double>")
    train = spark.createDataFrame([(1, [0.5, 0.5], 1)], "row_id long, vec array<double>, label long")
    assert rec.knn_catalogue(users, items, train.limit(0), None, 3, 2).count() == 0
    assert rec.knn_catalogue(users, items.limit(0), train, None, 3, 2).count() == 0
    assert [tuple(r) for r in rec.knn_catalogue(users, items, train, None, 3, 2).collect()] == [(1, 1, 1.0, 1)]


@pytest.fixture(scope="module")
def learnt(spark):
    """Users of segment a keep cheap items, others keep dear ones."""
    rng = np.random.default_rng(4)
    users = spark.createDataFrame([(u, "ab"[u % 2], float(rng.integers(0, 50))) for u in range(30)], "user_idx long, segment string, income double")
    items = spark.createDataFrame([(i, "xy"[i % 2], 1.0 + i, i % 5) for i in range(24)], "item_idx long, category string, price double, size int")
    log = []
    for u in range(30):
        for i in rng.choice(24, 12, replace=False):
            log.append((u, int(i), int((i % 2 == u % 2) != (rng.random() < 0.1))))
    return spark.createDataFrame(log, "user_idx long, item_idx long, relevance long"), users, items, {(u, i) for u, i, _ in log}


def test_logistic_lists_equal_scoring_every_pair(spark, learnt):
    log, users, items, seen = learnt
    features = md.factored_features(log, users, items)
    trained = features.rows(log)
    model = md.search_logistic(trained, ["user_idx", "item_idx"], cs=(1.0, 10.0), l1s=(0.5,), folds=3)
    got = md.rec_logistic(features, model, log, users, 4)
    every = users.select("user_idx").join(items.select("item_idx")).withColumn("relevance", F.lit(0))
    weights = F.array(*[F.lit(float(c)) for c in model.coefficients])
    margin = F.aggregate(F.zip_with(md.vector_to_array("features"), weights, lambda x, c: x * c), F.lit(float(model.intercept)), lambda a, b: a + b)
    scored = features.rows(every).select("user_idx", "item_idx", (1 / (1 + F.exp(-margin))).alias("p"))
    best = defaultdict(list)
    for r in scored.collect():
        if (r["user_idx"], r["item_idx"]) not in seen:
            best[r["user_idx"]].append(r["p"])
    for u, rs_ in pd.DataFrame([r.asDict() for r in got.collect()]).groupby("user_idx"):
        assert np.allclose(rs_.sort_values("rank")["relevance"], sorted(best[u], reverse=True)[:4], atol=1e-7)
        assert not {(u, i) for i in rs_["item_idx"]} & seen


@pytest.mark.parametrize("kind", ["tree", "boosted"])
def test_tree_lists_equal_scoring_every_pair(spark, learnt, kind):
    log, users, items, seen = learnt
    features = md.binned_features(log, users, items, bins=4)
    trained = features.rows(log)
    model = md.fit_tree(trained) if kind == "tree" else md.fit_boosted(trained, ["user_idx", "item_idx"], trees=(3, 5), depths=(2,), folds=2)
    got = md.rec_trees(features, model, log, users, 4)
    every = users.select("user_idx").join(items.select("item_idx")).withColumn("relevance", F.lit(0))
    weights = F.array(*[F.lit(float(c)) for c in model.coefficients])
    margin = F.aggregate(F.zip_with(md.vector_to_array("features"), weights, lambda x, c: x * c), F.lit(float(model.intercept)), lambda a, b: a + b)
    scored = features.rows(every).select("user_idx", "item_idx", (1 / (1 + F.exp(-margin))).alias("p"))
    best = defaultdict(list)
    for r in scored.collect():
        if (r["user_idx"], r["item_idx"]) not in seen:
            best[r["user_idx"]].append(round(r["p"], 9))
    for u, rs_ in pd.DataFrame([r.asDict() for r in got.collect()]).groupby("user_idx"):
        assert np.allclose(rs_.sort_values("rank")["relevance"], sorted(best[u], reverse=True)[:4], atol=1e-8)


def test_margin_lists(spark, learnt):
    log, users, items, _ = learnt
    got = md.rec_margin_price(log, users, items, 5)
    assert got.groupBy("user_idx").count().filter("count = 5").count() == 30


def test_selection_and_importance(spark, learnt):
    log, users, items, _ = learnt
    features = md.factored_features(log, users, items)
    trained = md.durable(features.rows(log))
    kept, importance = md.select_two_stage(trained, features.names, trees=5)
    assert len(kept) >= len(features.names) / 2 and math.isclose(importance.sum(), 1.0)
    assert md.sliced(trained, features.names, kept).first()["features"].size == len(kept)
    assert len(md.select_by_l1(trained, features.names)) >= len(features.names) / 2
    model, scores = md.search_revenue_logistic(trained, ["user_idx", "item_idx"], cs=(0.1, 1.0), folds=2)
    assert scores.count() == 2 and scores.agg(F.max('score')).first()[0] < 1
    table = md.importance_table(spark, features.names, model.coefficients.toArray()).collect()
    assert [r["importance"] for r in table] == sorted((r["importance"] for r in table), reverse=True)


def test_choose_neighbours_and_embedding(spark):
    rng = np.random.default_rng(5)
    data = [(i, [float(v) for v in rng.normal(size=2)]) for i in range(60)]
    train = spark.createDataFrame([(i, v, int(v[0] > 0)) for i, v in data], "row_id long, vec array<double>, label int")
    table = md.choose_neighbours(train, ns=(3, 5), folds=3).collect()
    assert {r["n"] for r in table} == {3, 5} and table[0]["rmse"] <= table[1]["rmse"] < 0.5
    out = md.embedded(train, "row_id", "vec", 1)
    assert out.columns == ["row_id", "vec", "embedding"] and len(out.first()["embedding"]) == 1


def test_detection(spark):
    real = spark.range(300).select("id", normal(1, "id").alias("v"))
    same = spark.range(300).select("id", normal(2, "id").alias("v"))
    far = same.withColumn("v", F.col("v") + 20)
    score = lambda fake: md.detection_score(real, fake, ["v"], ["id"]).first()["score"]
    assert score(far) < 0.05 < 0.5 < score(same)


# --- streaming ------------------------------------------------------------------------------


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    schema = "item_idx long, relevance long"
    parts = [spark.createDataFrame([(i % (5 + p), (i + p) % 2) for i in range(40)], schema) for p in range(3)]
    folder, work = str(tmp_path / "in"), str(tmp_path / "work")
    for p in parts[:2]:
        p.write.mode("append").parquet(folder)
    stream = lambda: read_log(spark, folder, parts[0].schema, files_per_batch=1)
    assert rows(item_stats_stream(stream(), work)) == rows(pop.item_counts(parts[0].unionByName(parts[1])))
    parts[2].write.mode("append").parquet(folder)
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert rows(item_stats_stream(stream(), work)) == rows(pop.item_counts(every))


def test_rows_of_tree_models_are_dealt_by_their_number(spark):
    rows = spark.range(3000, numPartitions=2).withColumnRenamed("id", "user_idx")
    few, many = md.dealt(rows, 1000), md.dealt(rows, 100)
    sizes = [len(p) for p in many.rdd.glom().collect()]
    assert few.rdd.getNumPartitions() == 2 and len(sizes) == 30 and max(sizes) <= 150 and sum(sizes) == 3000


def test_feature_joins_take_heavy_keys_from_stored_rows(spark, monkeypatch):
    """A chain of joins is not worked out again for every join's heavy keys."""
    from shortlist.plans import skew

    asked = []
    monkeypatch.setattr(skew, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(skew, "is_small", lambda df, *a: False)
    told = skew.heavy_keys
    monkeypatch.setattr(skew, "heavy_keys", lambda df, *a: asked.append(df) or told(df, *a))
    rows = [(u, (u * 7 + t) % 6, (u + t) % 2, "ab"[u % 2], "xyz"[(u * 7 + t) % 3]) for u in range(9) for t in range(8)]
    df = md.durable(spark.createDataFrame(rows, "user_idx long, item_idx long, relevance long, u_segment string, i_category string"))
    got = feat.segment_category_features(df)
    assert asked and all("Join" not in a._jdf.queryExecution().executedPlan().toString() for a in asked)
    log = spark.createDataFrame([r[:3] for r in rows], "user_idx long, item_idx long, relevance long")
    users = spark.createDataFrame([(u, "ab"[u % 2]) for u in range(9)], "user_idx long, segment string")
    items = spark.createDataFrame([(i, "xyz"[i % 3]) for i in range(6)], "item_idx long, category string")
    asked.clear()
    joined = feat.joined_features(log, users, items)
    graph.edges(log, users, items)
    wide = [a for a in asked if {"user_idx", "item_idx"} <= set(a.columns)]
    assert wide and all("Join" not in a._jdf.queryExecution().executedPlan().toString() for a in wide)
    assert got.count() == len(rows) and joined.count() == len(rows)
    of = defaultdict(set)
    for u, i, *_ in rows:
        of[i].add("ab"[u % 2])
    assert all(r.item_segments == len(of[r.item_idx]) for r in got.collect())
