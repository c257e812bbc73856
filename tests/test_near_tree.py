import numpy as np
import pytest
from pyspark.sql import functions as F

from shortlist.operators import models as md
from shortlist.operators import recommend as rec
from shortlist.session import CLEANUP, durable


def _nearest(x, ids, q, n, metric):
    diff = np.abs(x - q)
    d = np.round(diff.sum(axis=1) if metric == "manhattan" else np.sqrt((diff * diff).sum(axis=1)), 9)
    return sorted(((d[j], ids[j]) for j in range(len(x))), key=lambda p: (p[0], [-ord(c) for c in p[1]]))[:n]


@pytest.mark.parametrize(("metric", "dims", "n"), [("euclidean", 3, 5), ("manhattan", 2, 24), ("euclidean", 1, 3)])
def test_neighbours_in_many_regions(spark, metric, dims, n):
    """Regions grow in number with the rows, have equal and crowded points, and lists cross their borders."""
    rng = np.random.default_rng(dims)
    x, q = np.round(rng.normal(size=(1500, dims)), 1), np.round(rng.normal(size=(60, dims)), 1)
    x[:200] = x[0]
    ids = [f"{i:04d}" for i in range(1500)]
    train = durable(spark.createDataFrame([(i, [float(c) for c in v], 1) for i, v in zip(ids, x)] + [("none", [None] * dims, 1)], "row_id string, vec array<double>, label int"))
    queries = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(q)] + [(98, None), (99, [None] * dims)], "qid int, vec array<double>")
    cells = rec.neighbour_cells(train, metric, cell_items=1)
    assert (cells.tree.child < 0).sum() > 8
    for unique in (True, False):
        got = {}
        for r in rec.neighbours(queries, train, n, metric, cells, ("label",), unique).orderBy("qid", "rank").collect():
            assert r.label == 1
            got.setdefault(r.qid, []).append((r.distance, r.row_id))
        assert got == {i: _nearest(x, ids, q[i], n, metric) for i in range(60)}


def test_more_regions_than_there_were_cells(spark):
    rows = spark.range(12_000).select(F.col("id").alias("row_id"), F.array(F.col("id") / 7, (F.col("id") % 101).cast("double")).alias("vec"))
    tree = rec.neighbour_cells(durable(rows), cell_items=5).tree
    tree._cut(np.random.default_rng(1).normal(size=(40_000, 2)), 3_000)
    assert (tree.child < 0).sum() == 3_000


def test_rows_that_come_twice_weigh_in_means_as_in_a_join(spark):
    train = spark.createDataFrame([("a", [0.0, 0.0], 1), ("a", [0.0, 0.0], 1), ("b", [1.0, 0.0], 0), ("c", [5.0, 0.0], 1)], "row_id string, vec array<double>, label int")
    pairs = spark.createDataFrame([(1, 1, [0.5, 0.0])], "user_idx long, item_idx long, vec array<double>")
    got = rec.knn_scores(pairs, train, 3, whole=False).first()["relevance"]  # a twice, each joined to both rows
    assert got == round(4 / 5, 6)


def test_choose_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(8)
    x, y = np.round(rng.normal(size=(70, 3)), 1), rng.integers(0, 2, 70)
    ids = [f"{i:02d}" for i in range(70)]
    train = spark.createDataFrame([(i, [float(c) for c in v], int(l)) for i, v, l in zip(ids, x, y)], "row_id string, vec array<double>, label int")
    fold = {r.row_id: r.f for r in train.select("row_id", F.floor(md.uniform(0, "row_id") * 3).alias("f")).collect()}
    got = {r.n: r.rmse for r in md.choose_neighbours(train, ns=(2, 4), folds=3, cell_items=4).collect()}
    for n in (2, 4):
        err = []
        for i in range(70):
            other = [j for j in range(70) if fold[ids[j]] != fold[ids[i]]]
            near = _nearest(x[other], [ids[j] for j in other], x[i], n, "euclidean")
            w = np.array([1 / (d + 1e-10) for d, _ in near])
            err.append(y[i] - (w * [y[int(j)] for _, j in near]).sum() / w.sum())
        assert np.isclose(got[n], np.sqrt(np.mean(np.square(err))))


def test_shuffle_files_go_with_a_stored_table(spark):
    """The setting holds for the write alone: other queries may be run again and keep theirs."""
    before, tracker = spark.conf.get(CLEANUP), spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: sum(f.getName().startswith("shuffle_") for f in _listed(tracker.getAllFiles()))
    was = files()
    table = durable(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert files() <= was and spark.conf.get(CLEANUP) == before
    assert table.count() == 7


def _listed(seq):
    return [seq.apply(i) for i in range(seq.size())]
