"""Exact highest inner products: blocks of vectors in the order of their bounds, skipped below the k-th."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shortlist.session import durable

BLOCK = 256  # vectors in a block
SHARD_BLOCKS = 16  # blocks that one task holds at a time
QUERY_BATCH = 256
WHOLE = 2.0**63  # scaled components from here on have no 64-bit number


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, vector) with each component as floor(scale * x); rows whose vector is null or empty, or holds a
    null, infinite or undefined component, and rows without vec_id are left out. Components that leave
    the 64-bit numbers when scaled become the nearest of them."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & finite)
    return rows.select("vec_id", F.transform("x", _whole(scale)).alias("vector")).distinct()


def _whole(scale: int):
    least, most = F.lit(-(1 << 63)).cast("long"), F.lit((1 << 63) - 1).cast("long")

    def number(v: Column) -> Column:
        y = v * scale
        return F.when(y >= WHOLE, most).when(y < -WHOLE, least).otherwise(F.floor(y))

    return number


def _blob(rows: np.ndarray) -> bytes:
    """Integers of four bytes each if all fit, else of eight."""
    small = np.iinfo(np.int32)
    fits = rows.min(initial=0) >= small.min and rows.max(initial=0) <= small.max
    return rows.astype(np.int32 if fits else np.int64).tobytes()


def _unblob(blob: bytes, n: int, dims: int) -> np.ndarray:
    return np.frombuffer(blob, np.int32 if len(blob) == 4 * n * dims else np.int64).reshape(n, dims).astype(np.int64)


def _products(a: np.ndarray, b: np.ndarray, wide: bool) -> np.ndarray:
    """a @ b.T in whole numbers; with ``wide``, those that leave the 64-bit numbers become the nearest of them."""
    if not wide:
        return a @ b.T
    least, most = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max
    return np.clip(a.astype(object) @ b.T.astype(object), least, most).astype(np.int64)


def _pack(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive rows as (number, ids, matrix) of at most ``size`` rows of one length."""
    ids, rows, number = [], [], 0
    for batch in batches:
        for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()):
            if rows and (len(rows) == size or len(rows[0]) != len(v)):
                yield number, np.array(ids), np.array(rows, np.int64)
                ids, rows, number = [], [], number + 1
            ids.append(i)
            rows.append(v)
    if rows:
        yield number, np.array(ids), np.array(rows, np.int64)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, ids, rows in _pack(batches, BLOCK * SHARD_BLOCKS):
        yield pa.record_batch(
            [pa.array([number]), pa.array([rows.shape[1]]), pa.array([ids.tobytes()]), pa.array([_blob(rows)])],
            names=["number", "dims", "ids", "vectors"],
        )


def _query_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, ids, rows in _pack(batches, QUERY_BATCH):
        yield pa.record_batch(
            [pa.array([number]), pa.array([rows.shape[1]]), pa.array([ids.tobytes()]), pa.array([_blob(rows)])],
            names=["batch", "dims", "query_ids", "queries"],
        )


def search_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query_id, vec_id, score) of each query's ``k`` best vectors in one shard, without its own.

    A block's bound for a query is the sum over the components of the larger product with the
    block's least and greatest value. Blocks are scored from the highest bound on, until a bound is
    below the k-th score that the query has.
    """
    edges = np.arange(0, len(vectors), BLOCK)
    high = np.maximum.reduceat(vectors, edges, axis=0)
    low = np.minimum.reduceat(vectors, edges, axis=0)
    reach = [max(abs(int(x.min(initial=0))), int(x.max(initial=0))) for x in (vectors, queries)]
    wide = reach[0] * reach[1] * vectors.shape[1] >= 1 << 62
    # one product of twice the length, so that a bound beyond 64 bits stays above the scores it bounds
    bounds = _products(np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)]), np.hstack([high, low]), wide)
    order = np.argsort(-bounds, axis=1, kind="stable")
    best_score = np.full((len(queries), k), np.iinfo(np.int64).min)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    fvectors, fqueries = vectors.astype(np.float64), queries.astype(np.float64)
    # products of integers below 2**26 over few hundred components are exact in doubles
    exact = max(reach) < 1 << 20 and vectors.shape[1] < 8192
    for turn in range(len(edges)):
        block_of = order[:, turn]
        alive = np.flatnonzero(np.take_along_axis(bounds, block_of[:, None], 1)[:, 0] >= best_score[:, -1])
        if len(alive) == 0:
            break
        for block in np.unique(block_of[alive]):
            rows = alive[block_of[alive] == block]
            at = slice(edges[block], min(edges[block] + BLOCK, len(vectors)))
            if exact:
                scores = (fqueries[rows] @ fvectors[at].T).astype(np.int64)
            else:
                scores = _products(queries[rows], vectors[at], wide)
            others = np.broadcast_to(ids[at], scores.shape)
            scores = np.where(others == query_ids[rows][:, None], np.iinfo(np.int64).min, scores)
            all_scores = np.concatenate([best_score[rows], scores], axis=1)
            all_ids = np.concatenate([best_id[rows], np.where(others == query_ids[rows][:, None], np.iinfo(np.int64).max, others)], axis=1)
            top = np.lexsort((all_ids, -all_scores.astype(np.float64)), axis=1)[:, :k] if exact else _order(all_scores, all_ids, k)
            best_score[rows] = np.take_along_axis(all_scores, top, 1)
            best_id[rows] = np.take_along_axis(all_ids, top, 1)
    found = best_id != np.iinfo(np.int64).max
    who = np.broadcast_to(query_ids[:, None], best_id.shape)
    return who[found], best_id[found], best_score[found]


def _order(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    by_id = np.argsort(ids, axis=1, kind="stable")
    by_score = np.argsort(~np.take_along_axis(scores, by_id, 1), axis=1, kind="stable")  # ~x is -x - 1, also for the least number
    return np.take_along_axis(by_id, by_score, 1)[:, :k]


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                ids, vectors, query_ids, queries = (batch.column(c)[row].as_py() for c in ("ids", "vectors", "query_ids", "queries"))
                dims = batch.column("dims")[row].as_py()
                q, v, s = search_shard(
                    np.frombuffer(ids, np.int64), _unblob(vectors, len(ids) // 8, dims),
                    np.frombuffer(query_ids, np.int64), _unblob(queries, len(query_ids) // 8, dims), k)
                yield pa.record_batch([pa.array(q), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])

    return search


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` its ``k`` highest inner products
    with the rows of ``vectors``, both (vec_id, vector of integers), ties to the smaller vec_id.

    A vector with the query's own vec_id is no candidate, nor is one of another length. Fewer than
    ``k`` candidates give fewer rows; empty tables give none. Equal rows count once. Products that
    leave the 64-bit numbers count as the nearest of them.

    Vectors are sorted by their largest component and range-partitioned into shards of at most
    4 096, which keeps similar ones in a block; every batch of queries meets every shard, and
    inside it only blocks whose bound reaches the query's k-th score are scored. What leaves a task
    is at most k rows for each query and shard.
    """
    spark = vectors.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lead = F.array_position("vector", F.array_max("vector"))
    ordered = vectors.repartitionByRange(n, lead, F.col("vec_id")).sortWithinPartitions(lead, "vec_id").select("vec_id", "vector")
    packed = "number long, dims long, ids binary, vectors binary"
    shards = durable(ordered.mapInArrow(_shards, packed).withColumn("shard", F.monotonically_increasing_id()))
    spread = queries.repartition(n, "vec_id").select("vec_id", "vector")
    batches = spread.mapInArrow(_query_batches, "batch long, dims long, query_ids binary, queries binary")
    # shards are numbered densely by their ids alone: one row for 4 096 vectors
    places = durable(shards.select("shard").withColumn("place", F.row_number().over(Window.orderBy("shard"))))
    n_places = max(places.count(), 1)
    pairs = (
        batches.withColumn("place", F.explode(F.sequence(F.lit(1), F.lit(n_places)))).join(places, "place")
        .join(shards.select("shard", "dims", "ids", "vectors"), ["shard", "dims"])
    )
    found = pairs.select("dims", "ids", "vectors", "query_ids", "queries").mapInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
