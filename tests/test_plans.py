"""Plans for skew, order and top-k against brute force, with the large-data paths forced."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shortlist.functions import vectors as vec
from shortlist.operators import recommend
from shortlist.plans import ordering, skew
from shortlist.plans.cell_topk import cell_topk
from shortlist.plans.dominance import contenders, undominated
from shortlist.plans.draws import sequential_draws
from shortlist.plans.grouped_topk import grouped_vector_topk
from shortlist.plans.topk import dealt_users, prefix_rows, prefix_topk, topk_per_user
from shortlist.plans.vector_topk import Cells, vector_topk


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def hot_log():
    """User 0 holds more than a third of the rows; item 0 is taken by everyone."""
    rng = random.Random(1)
    out = [(0, rng.randrange(40), t, rng.randrange(2)) for t in range(400)]
    for u in range(1, 40):
        out += [(u, 0, 0, 1)] + [(u, rng.randrange(40), t, rng.randrange(2)) for t in range(1, rng.randrange(3, 30))]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def log(spark, hot_log):
    return spark.createDataFrame(hot_log, "user_idx long, item_idx long, t long, relevance long").repartition(5)


def brute_topk(scores, seen, k):
    """scores: {user: {item: score}}"""
    out = []
    for u, s in scores.items():
        free = sorted(((v, i) for i, v in s.items() if (u, i) not in seen), reverse=True)[:k]
        out += [(u, i, v, r) for r, (v, i) in enumerate(free, 1)]
    return sorted(out)


def test_heavy_keys_are_found_and_bounded(log, hot_log):
    n = Counter(r[0] for r in hot_log)
    assert sorted(skew.heavy_keys(log, "user_idx", 0.05)) == sorted(u for u, c in n.items() if c > 0.05 * len(hot_log))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_join(spark, log, how):
    dim = spark.range(0, 30).select(F.col("id").alias("user_idx"), (F.col("id") * 2).alias("x"))
    got = skew.spread_join(log, dim, "user_idx", how)
    assert rows(got) == rows(log.join(dim, "user_idx", how).select(got.columns))


def test_spread_join_keeps_copies(spark):
    copies = spark.createDataFrame([(1, 7)] * 50 + [(2, 7)], "k long, v long")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k long, x string")
    assert skew.spread_join(copies, dim, "k").groupBy("x").count().orderBy("x").collect()[0]["count"] == 50


@pytest.mark.parametrize("small", [10**6, 3])
def test_global_row_number(spark, log, small):
    df = log.distinct().select("user_idx", "item_idx", "t")
    order = [F.col("t").desc(), F.col("user_idx"), F.col("item_idx")]
    got = {r["rank"]: (r["t"], r["user_idx"], r["item_idx"]) for r in ordering.global_row_number(df, order, small=small).collect()}
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: (-r[2], r[0], r[1]))
    assert [got[i + 1] for i in range(len(want))] == [(t, u, i) for u, i, t in want]


@pytest.mark.parametrize("small", [10**6, 2])
def test_running_totals(spark, log, small):
    counts = log.groupBy(F.col("t").alias("v")).agg(F.count("t").alias("n"))
    got = {r["v"]: r["cum_n"] for r in ordering.running_totals(counts, "v", ["n"], small).collect()}
    total, want = 0, {}
    for v, n in sorted((r["v"], r["n"]) for r in counts.collect()):
        total += n
        want[v] = total
    assert got == want


@pytest.mark.parametrize("small", [10**6, 2])
def test_percentiles(spark, small):
    values = [3.0, 1.0, 1.0, 8.5, 2.0, 2.0, 2.0, 9.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    points = [0.0, 0.2, 0.35, 0.5, 0.8, 1.0]
    got = dict(rows(ordering.exact_percentiles(df, "v", points, small)))
    want = np.percentile([v for v in values if v is not None], [p * 100 for p in points])
    assert np.allclose([got[p] for p in points], want)


def test_positions_and_lags_of_a_hot_user(log, hot_log):
    order = ["t", "item_idx", "relevance"]
    got = ordering.positions(log, "user_idx", order, F.lpad((F.col("t") / 50).cast("int").cast("string"), 6, "0"), "pos", [0], "length")
    for block in (7, 65_536):
        lagged = ordering.previous(got, "user_idx", "pos", "item_idx", 3, [0], block)
        by_user = defaultdict(list)
        for u, i, t, r in hot_log:
            by_user[u].append((t, i, r))
        want = []
        for u, s in by_user.items():
            items = [i for _, i, _ in sorted(s)]
            for p, i in enumerate(items):
                want.append((u, p + 1, i, *[items[p - j] if p >= j else None for j in (1, 2, 3)], len(items)))
        have = [tuple(r) for r in lagged.select("user_idx", "pos", "item_idx", "prev_1", "prev_2", "prev_3", "length").collect()]
        key = lambda r: r[:2]
        assert sorted(have, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("depth,k", [(4, 3), (10, 3), (64, 3), (8, 60), (100, 100)])
def test_prefix_topk(spark, log, hot_log, depth, k):
    """Small depths send users through the unbounded path; user 0 has seen nearly everything."""
    items = spark.range(50).select(F.col("id").alias("item_idx"), (F.col("id") % 7 / 10).alias("relevance"))
    users = spark.range(45).select(F.col("id").alias("user_idx"))
    got = prefix_topk(users, items, log, k, depth)
    seen = {(r[0], r[1]) for r in hot_log}
    scores = {u: {i: round(i % 7 / 10, 9) for i in range(50)} for u in range(45)}
    assert rows(got.select("user_idx", "item_idx", "relevance", "rank")) == brute_topk(scores, seen, k)


def test_prefix_topk_does_not_depend_on_partitioning(spark, log):
    items = spark.range(50).select(F.col("id").alias("item_idx"), F.lit(0.5).alias("relevance"))
    users = spark.range(45).select(F.col("id").alias("user_idx"))
    assert rows(prefix_topk(users, items, log.repartition(1), 3)) == rows(prefix_topk(users, items, log.repartition(13), 3))


def test_deep_blocks(spark, log, hot_log, monkeypatch):
    from shortlist.plans import topk

    items = spark.range(50).select(F.col("id").alias("item_idx"), (F.col("id") % 5 / 10).alias("relevance"))
    users = spark.range(45).select(F.col("id").alias("user_idx"))
    got = topk._deep_topk(users, items, log, 4, block=6)
    scores = {u: {i: round(i % 5 / 10, 9) for i in range(50)} for u in range(45)}
    assert rows(got.select("user_idx", "item_idx", "relevance", "rank")) == brute_topk(scores, {(r[0], r[1]) for r in hot_log}, 4)


def test_prefix_rows(spark):
    items = spark.range(300).select(F.col("id").alias("item_idx"), (F.col("id") % 9 / 10).alias("relevance"))
    depths = spark.createDataFrame([(1, 3), (2, 0), (3, 300), (4, 65)], "user_idx long, depth long")
    got = Counter(r["user_idx"] for r in prefix_rows(depths, items).collect())
    assert got == {1: 3, 3: 300, 4: 65}


def test_topk_limits_groups_before_the_shuffle(spark, log):
    plan = topk_per_user(log.withColumnRenamed("t", "x"), 2)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def _vectors(spark, n, dim, seed, key, hot=False):
    rng = np.random.default_rng(seed)
    data = np.round(rng.normal(size=(n, dim)), 3)
    if hot:
        data[: n // 3] = data[0]  # a third of the rows are copies
    return data, spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], f"{key} long, vec array<double>")


@pytest.mark.parametrize("metric", ["dot", "euclidean", "manhattan"])
@pytest.mark.parametrize("cell,block,slot", [(4096, 4096, 2048), (16, 8, 10), (30, 7, 1000)])
def test_vector_topk_is_exact(spark, log, hot_log, metric, cell, block, slot):
    x, items = _vectors(spark, 90, 3, 1, "item_idx", hot=True)
    q, queries = _vectors(spark, 45, 3, 2, "user_idx")
    seen = {(r[0], r[1]) for r in hot_log}
    got = vector_topk(queries, items, 5, metric, log.select("user_idx", "item_idx"), cell_items=cell, block_items=block, slot_queries=slot)
    fn = {
        "dot": lambda a, b: float(a @ b), "euclidean": lambda a, b: -float(np.sqrt(((a - b) ** 2).sum())),
        "manhattan": lambda a, b: -float(np.abs(a - b).sum()),
    }[metric]
    scores = {u: {i: round(fn(q[u], x[i]), 9) for i in range(90)} for u in range(45)}
    want = brute_topk(scores, seen, 5)
    have = rows(got.select("user_idx", "item_idx", "score", "rank"))
    assert [(u, i, r) for u, i, _, r in have] == [(u, i, r) for u, i, _, r in want]
    assert np.allclose([h[2] for h in have], [w[2] for w in want], atol=2e-9)


def test_vector_topk_threshold_and_many_wanted(spark):
    x, items = _vectors(spark, 60, 3, 3, "item_idx")
    q, queries = _vectors(spark, 10, 3, 4, "user_idx")
    got = vector_topk(queries, items, 100, "dot", None, 0.5, cell_items=10, block_items=5, slot_queries=4)
    want = {(u, i) for u in range(10) for i in range(60) if round(float(q[u] @ x[i]), 9) >= 0.5}
    assert {(r["user_idx"], r["item_idx"]) for r in got.collect()} == want


@pytest.mark.parametrize("metric", ["dot", "euclidean"])
def test_cells_are_ruled_out_by_what_counts_for_the_score(spark, metric):
    """Items spread widest where the queries have next to nothing; the lists are those of scoring all."""
    n = 400
    rng = np.random.default_rng(8)
    wide = rng.uniform(0, 1000, n) if metric == "dot" else rng.uniform(0, 1, n)
    x = np.round(np.stack([wide, rng.uniform(0, 1, n), rng.uniform(0, 1, n)], axis=1), 3)
    q = np.round(np.stack([np.full(40, 1e-6) if metric == "dot" else rng.uniform(0, 1, 40), rng.uniform(0.2, 1, 40), rng.uniform(0.2, 1, 40)], axis=1), 6)
    items = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "item_idx long, vec array<double>")
    queries = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(q)], "user_idx long, vec array<double>")
    cells = Cells(items, "item_idx", "vec", metric, 10, 10, queries)
    looked_at = cells.visit(queries.select(F.col("user_idx").alias("qid"), "vec", F.lit(3).cast("long").alias("need")), None)
    assert len(cells.centers) == 40
    assert looked_at.agg(F.avg(F.size("cells"))).first()[0] < 12
    score = lambda a, b: float(a @ b) if metric == "dot" else -float(np.sqrt(((a - b) ** 2).sum()))
    scores = {u: {i: round(score(q[u], x[i]), 9) for i in range(n)} for u in range(40)}
    got = rows(vector_topk(queries, items, 3, metric, cell_items=10, block_items=10).select("user_idx", "item_idx", "score", "rank"))
    assert [(u, i, r) for u, i, _, r in got] == [(u, i, r) for u, i, _, r in brute_topk(scores, set(), 3)]


def test_grouped_vector_topk(spark):
    x, items = _vectors(spark, 60, 2, 5, "item_idx")
    q, queries = _vectors(spark, 30, 2, 6, "user_idx")
    items = items.withColumn("group", F.when(F.col("item_idx") < 40, 0).otherwise(F.col("item_idx") % 3))
    queries = queries.withColumn("group", F.when(F.col("user_idx") < 20, 0).otherwise(F.col("user_idx") % 4))
    seen = spark.createDataFrame([(u, i) for u in range(30) for i in range(u % 5)], "user_idx long, item_idx long")
    got = grouped_vector_topk(queries, items, 4, seen, block_items=7, slot_queries=6)
    g_item = {i: 0 if i < 40 else i % 3 for i in range(60)}
    g_user = {u: 0 if u < 20 else u % 4 for u in range(30)}
    scores = {u: {i: round(float(q[u] @ x[i]), 9) for i in range(60) if g_item[i] == g_user[u]} for u in range(30)}
    want = brute_topk(scores, {(u, i) for u in range(30) for i in range(u % 5)}, 4)
    assert [(u, i, r) for u, i, _, r in rows(got.select("user_idx", "item_idx", "score", "rank"))] == [(u, i, r) for u, i, _, r in want]


def test_cell_topk(spark, log, hot_log):
    users = spark.range(45).select(F.col("id").alias("user_idx"), (F.col("id") % 3).alias("ucell"))
    items = spark.range(50).select(F.col("id").alias("item_idx"), (F.col("id") % 6).alias("icell"))
    pairs = [(u, i, ((u + 1) * (i + 2) % 7) / 10) for u in range(3) for i in range(6)]
    scores = spark.createDataFrame(pairs, "ucell long, icell long, relevance double")
    table = {(u, i): s for u, i, s in pairs}
    seen = {(r[0], r[1]) for r in hot_log}
    want = []
    for u in range(45):
        free = sorted(((table[u % 3, i % 6], i % 6, i) for i in range(50) if (u, i) not in seen), reverse=True)[:4]
        want += [(u, i, s, r) for r, (s, _, i) in enumerate(free, 1)]
    got = cell_topk(users, items, scores, log, 4).select("user_idx", "item_idx", "relevance", "rank")
    assert rows(got) == sorted(want)


def test_dominance_keeps_every_possible_winner(spark):
    rng = np.random.default_rng(0)
    data = [(i, float(a), float(b)) for i, (a, b) in enumerate(np.round(rng.normal(size=(400, 2)), 2))]
    kept = {r["i"] for r in undominated(spark.createDataFrame(data, "i long, x double, y double"), "x", "y", 3, bins=16).collect()}
    for i, a, b in data:
        if sum(a2 > a and b2 > b for _, a2, b2 in data) < 3:
            assert i in kept
    assert len(kept) < 400


def test_contenders_hold_all_lists_and_do_not_grow_with_the_items(spark):
    rng = np.random.default_rng(1)
    points = np.round(rng.normal(size=(300, 2)), 1)
    score = lambda q, a, b: round((1 / (1 + np.exp(-(q + a)))) * b, 9)
    sizes = []
    for copies in (1, 30):  # equal points with other keys
        data = [(i, float(a), float(abs(b)) + 0.1) for i, (a, b) in enumerate(np.tile(points, (copies, 1)))]
        kept = [tuple(r) for r in contenders(spark.createDataFrame(data, "i long, x double, y double"), "x", "y", 3, "i", bins=8).collect()]
        best = lambda rows, q: sorted(((score(q, a, b), i) for i, a, b in rows), reverse=True)[:3]
        for q in (-3.0, -0.5, 0.0, 2.0):
            assert best(kept, q) == best(data, q)
        sizes.append(len(kept))
    assert sizes[1] <= 2 * sizes[0]


def test_sequential_draws(spark, log, hot_log):
    items = spark.range(60).select(F.col("id").alias("item_idx"), (F.col("id") % 4 + 1.0).alias("w"))
    users = spark.createDataFrame([(u, 1 + u % 5, 0) for u in range(40)] + [(40, 60, 0), (41, 45, 0)], "user_idx long, wanted long, taken long")
    got = sequential_draws(users, items, 3, "w", first_factor=0.1).collect()
    per_user = defaultdict(list)
    for r in got:
        per_user[r["user_idx"]].append((r["place"], r["item_idx"]))
    for u, n, _ in (tuple(r) for r in users.collect()):
        places, drawn = zip(*sorted(per_user[u]))
        assert places == tuple(range(1, n + 1)) and len(set(drawn)) == n


def test_draws_follow_weights(spark):
    items = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 5.0), *[(i, 1.0) for i in range(3, 6)]], "item_idx long, w double")
    users = spark.range(6000).select(F.col("id").alias("user_idx"), F.lit(1).alias("wanted"))
    n = Counter(r["item_idx"] for r in sequential_draws(users, items, 5, "w").collect())
    assert abs(n[2] / 6000 - 5 / 11) < 0.03 and abs(n[1] / 6000 - 2 / 11) < 0.03


def test_draws_skip_pairs(spark):
    items = spark.range(30).select(F.col("id").alias("item_idx"))
    pairs = spark.range(25).select(F.lit(7).cast("long").alias("user_idx"), F.col("id").alias("item_idx"))
    users = spark.createDataFrame([(7, 5, 25), (8, 3, 0)], "user_idx long, wanted long, taken long")
    got = sequential_draws(users, items, 1, without=pairs).collect()
    assert {r["item_idx"] for r in got if r["user_idx"] == 7} == set(range(25, 30))


def test_normalized_and_similarities(spark):
    df = spark.createDataFrame([([3.0, 4.0], [3.0, 4.0], [-3.0, -4.0], [0.0, 0.0])], "a array<double>, b array<double>, c array<double>, z array<double>")
    r = df.select(
        vec.normalized("a").alias("n"), vec.normalized("z").alias("nz"), vec.cosine("a", "z").alias("cz"), vec.angular("a", "z").alias("az"),
        F.round(vec.cosine("a", "b"), 9).alias("ab"), F.round(vec.angular("a", "b"), 6).alias("aab"),
        F.round(vec.cosine("a", "c"), 9).alias("ac"), F.round(vec.angular("a", "c"), 6).alias("aac"),
    ).first()
    assert r["n"] == [0.6, 0.8] and r["nz"] == [0.0, 0.0] and r["cz"] == 0.0 and r["az"] == 0.0
    assert (r["ab"], r["aab"], r["ac"], r["aac"]) == (1.0, 1.0, -1.0, 0.0)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("heavy", [[], [0]])
def test_spread_join_broadcasts_neither_side(spark, log, heavy):
    dim = spark.range(0, 30).withColumnRenamed("id", "user_idx")
    few = spark.range(1).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(99).cast("long"))).alias("user_idx"))  # grows unseen by the planner
    for fact in (log, few):
        assert "BroadcastHashJoin" not in plan_of(skew.spread_join(fact, dim, "user_idx", heavy=heavy))


def test_heavy_keys_read_their_table_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    source = spark.range(100).select((F.col("id") % 3).alias("k")).mapInArrow(count, "k long")
    assert sorted(skew.heavy_keys(source, "k", 0.1)) == [0, 1, 2]
    assert read.value == 100


def test_draws_meet_a_large_catalogue_without_counting_the_stream(spark, monkeypatch):
    from shortlist.plans import draws

    monkeypatch.setattr(draws, "is_small", lambda df: False)
    monkeypatch.setattr(skew, "heavy_keys", lambda *a, **k: pytest.fail("the stream was counted"))
    users = spark.createDataFrame([(1, 3), (2, 9)], "user_idx long, wanted long")
    stream = draws._stream(users.select("user_idx", F.lit(1).cast("long").alias("_from"), F.lit(40).cast("long").alias("_upto")), 20, 5)
    catalogue = spark.range(20).select((F.col("id") * 7).alias("item_idx"), F.col("id").alias("_number"), F.lit(1.0).alias("_weight"))
    got = draws._met(stream, catalogue)
    assert "BroadcastHashJoin" not in plan_of(got)
    assert rows(got.select("user_idx", "draw", "item_idx")) == rows(stream.join(catalogue, "_number").select("user_idx", "draw", "item_idx"))


def test_scores_of_random_lists_are_not_broadcast(spark, log):
    from shortlist.operators.recommend import random_topk

    users = log.select("user_idx").distinct()
    items = spark.range(60).withColumnRenamed("id", "item_idx")
    joins = [line for line in plan_of(random_topk(log, users, items, 5, 3)).splitlines() if "Join [" in line and "rank#" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_lists_of_many_users_are_dealt_over_many_tasks(spark, monkeypatch):
    users = spark.range(4_000).select(F.col("id").alias("user_idx")).coalesce(1)
    items = spark.range(30).select(F.col("id").alias("item_idx"), (F.col("id") % 7).cast("double").alias("relevance"))
    monkeypatch.setattr(recommend, "LISTED_PER_TASK", 2_000)
    assert dealt_users(users, 100).rdd.getNumPartitions() == 40
    lists = prefix_topk(users, items, None, 3)
    assert max(r[0] for r in lists.groupBy(F.spark_partition_id()).count().select("count").collect()) < 12_000 / 4
    got = recommend.hybrid([lists, lists], items.select("item_idx"), 3)
    sizes = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 12_000 and max(sizes) <= 2 * 2_000
    want = sorted([(i % 7, i) for i in range(30)], reverse=True)[:3]
    assert {(r.item_idx, r.relevance, r["rank"]) for r in got.collect()} == {(i, float(s), n) for n, (s, i) in enumerate(want, 1)}
