"""Text quality: random-indexing word vectors, pooled per document, and a small calibrated network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortlist.llm import words
from shortlist.session import durable, release

BUCKETS = 1 << 15  # words are told apart by so many values of a hash
DIMS = 32
NONZERO = 4  # entries of +1 or -1 in a word's index vector
REACH = 2  # neighbours on each side that count as context
SAMPLE = 40_000  # labelled rows that the network is fitted on, at most
HIDDEN = 24
EPOCHS = 30
FOLDS = 5
N_FEATURES = 2 * DIMS + 4

# a token is a run of letters and digits, or a run of other visible characters
KINDS = np.zeros(256, np.uint8)
KINDS[words.WORD] = 1
KINDS[~words.WORD & words.NOT_SPACE] = 2


def _tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token, and where each text's tokens begin."""
    kinds = KINDS[raw]
    change = np.ones(len(raw) + 1, bool)
    change[1:-1] = kinds[1:] != kinds[:-1]
    change[offsets] = True
    edges = np.flatnonzero(change)
    inside = kinds[edges[:-1]] > 0
    starts, ends = edges[:-1][inside], edges[1:][inside]
    return words.word_hashes(raw, starts, ends, words.SAME), np.searchsorted(starts, offsets)


def _index_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and sign of the entries of each token's index vector."""
    draws = [words.mix(hashes + np.uint64(k + 1)) for k in range(NONZERO)]
    dims = np.stack([(d & np.uint64(DIMS - 1)).astype(np.int64) for d in draws], 1)
    signs = np.stack([((d >> np.uint64(40)) & np.uint64(1)).astype(np.int32) * 2 - 1 for d in draws], 1)
    return dims, signs


def _count_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(BUCKETS * DIMS, np.int32)
    for batch in batches:
        for _, _, raw, offsets in words.chunks(batch.column("text")):
            hashes, bounds = _tokens(raw, offsets)
            text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            rows = (hashes & np.uint64(BUCKETS - 1)).astype(np.int64) * DIMS
            dims, signs = _index_places(hashes)
            for step in range(1, REACH + 1):
                near = np.flatnonzero(text[step:] == text[:-step])
                for here, there in ((near, near + step), (near + step, near)):
                    np.add.at(table, (rows[here][:, None] + dims[there]).ravel(), signs[there].ravel())
    table = table.reshape(BUCKETS, DIMS)
    used = np.flatnonzero(table.any(axis=1))
    yield pa.record_batch([pa.array(used), *[pa.array(table[used, d]) for d in range(DIMS)]], names=["bucket", *[f"c{d}" for d in range(DIMS)]])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """(BUCKETS, DIMS) unit vectors: the summed index vectors of all neighbours of a word in ``docs``,
    without their common direction.

    Every text counts. A task sends at most BUCKETS rows of DIMS numbers, and the driver gets the
    same number of sums, whatever the input.
    """
    columns = [f"c{d}" for d in range(DIMS)]
    counted = docs.select(F.col("text").cast("string")).mapInArrow(
        _count_contexts, "bucket long, " + ", ".join(f"{c} int" for c in columns))
    sums = counted.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
    out = np.zeros((BUCKETS, DIMS), np.float32)
    if len(sums):
        vectors = sums[columns].to_numpy(np.float64)
        # what all contexts have in common tells no words apart
        common = vectors.sum(axis=0)
        common /= max(np.sqrt(common @ common), 1)
        vectors -= (vectors @ common)[:, None] * common
        norm = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
        out[sums["bucket"].to_numpy()] = vectors / np.where(norm > 0, norm, 1)
    return out


def pool(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """A row per text: mean and spread of its words' vectors, length of the mean, size, bytes per
    token, likeness of neighbours. Texts without tokens get zeros."""
    out = np.zeros((len(column), N_FEATURES), np.float32)
    for first, last, raw, offsets in words.chunks(column):
        hashes, bounds = _tokens(raw, offsets)
        counts = np.diff(bounds)
        full = np.flatnonzero(counts)
        if len(full) == 0:
            continue
        own = vectors[(hashes & np.uint64(BUCKETS - 1)).astype(np.int64)]
        n = counts[full][:, None]
        mean = np.add.reduceat(own, bounds[:-1][full], axis=0) / n
        square = np.add.reduceat(own * own, bounds[:-1][full], axis=0) / n
        # cosine of each vector with the one before it in the text; 0 at a text's first word
        alike = np.zeros(len(own), np.float32)
        alike[1:] = (own[1:] * own[:-1]).sum(axis=1)
        alike[bounds[:-1][full]] = 0
        part = out[first:last]
        part[full, :DIMS] = mean
        part[full, DIMS : 2 * DIMS] = np.sqrt(np.maximum(square - mean * mean, 0))
        part[full, 2 * DIMS] = np.sqrt((mean * mean).sum(axis=1))
        part[full, 2 * DIMS + 1] = np.log1p(counts[full])
        part[full, 2 * DIMS + 2] = np.diff(offsets)[full] / n[:, 0]
        part[full, 2 * DIMS + 3] = np.add.reduceat(alike, bounds[:-1][full]) / n[:, 0]
    return out


@dataclass
class Network:
    """Two layers on standardised features; ``temperature`` divides the output before the sigmoid."""

    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.center) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, check: np.ndarray, seed: int = 5) -> Network:
    """Fit on the rows where ``check`` is false; the rest sets the temperature by log loss. Without
    rows the result is 0.5 everywhere; with one label it is that label's smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    flat = float(np.log(share / (1 - share)))
    fit = ~check if (~check).any() else np.ones(len(y), bool)
    center = x[fit].mean(axis=0) if len(x) else np.zeros(N_FEATURES)
    scale = x[fit].std(axis=0) + 1e-6 if len(x) else np.ones(N_FEATURES)
    if len(np.unique(y[fit])) < 2:
        return Network(center, scale, np.zeros((N_FEATURES, 1)), np.zeros(1), np.zeros(1), flat)
    rng = np.random.default_rng(seed)
    z, t = (x[fit] - center) / scale, y[fit].astype(np.float64)
    params = [rng.normal(0, N_FEATURES**-0.5, (N_FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.array(flat)]
    first, second, step, decay = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0, 1e-4
    for epoch in range(EPOCHS):
        rate = 5e-3 * (1 - epoch / EPOCHS) + 1e-4
        for rows in np.array_split(rng.permutation(len(z)), max(1, len(z) // 256)):
            a, b = z[rows], t[rows]
            pre = a @ params[0] + params[1]
            hidden = np.maximum(pre, 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -30, 30))) - b) / len(b)
            back = error[:, None] * params[2] * (pre > 0)
            grads = [a.T @ back + decay * params[0], back.sum(axis=0), hidden.T @ error + decay * params[2], error.sum()]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] = params[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(center, scale, params[0], params[1], params[2], float(params[3]))
    if check.any() and len(np.unique(y[check])) == 2:
        raw, known = net.logits(x[check]), y[check]
        tried = np.geomspace(0.25, 8, 41)
        loss = [np.logaddexp(0, np.where(known == 1, -raw, raw) / temp).mean() for temp in tried]
        net.temperature = float(tried[int(np.argmin(loss))])
    return net


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo FOLDS; null without doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


@dataclass
class Model:
    vectors: np.ndarray
    network: Network


def _pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = pool(batch.column("text"), held.value)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * N_FEATURES), pa.array(flat.ravel()))
            yield pa.record_batch([batch.column("doc_id"), lists], names=["doc_id", "features"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        features, "doc_id long, features array<float>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Model, DataFrame]:
    """The model, and (doc_id, features) of every row of ``docs``.

    Word vectors come from all texts. The network learns from at most ``sample`` labelled documents
    whose fold is not 0, chosen by a hash of the doc_id; fold 1 sets the temperature. Labels other
    than 0 and 1, and rows without doc_id, teach nothing.
    """
    vectors = word_vectors(docs)
    pooled = durable(_pooled(docs, vectors))
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("quality").cast("int").alias("quality")).where(fold(F.col("doc_id")) != 0)
    rows = (
        pooled.join(known, "doc_id").dropDuplicates(["doc_id"])
        .select("features", "quality", (fold(F.col("doc_id")) == 1).alias("check"), F.xxhash64("doc_id").alias("h"), "doc_id")
        .orderBy("h", "doc_id").limit(sample).toPandas()
    )
    x = np.stack(rows["features"].to_list()).astype(np.float64) if len(rows) else np.zeros((0, N_FEATURES))
    network = fit_network(x, rows["quality"].to_numpy(np.int64), rows["check"].to_numpy(bool))
    return Model(vectors, network), pooled


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text, ...).

    score is the probability of label 1 in ``labels`` (doc_id, quality), between 0 and 1, for every
    text, null and empty ones too (their features are zeros). predicted is 1 if it is at least
    ``threshold``. held_out says that the document's fold is 0; such labels are never learned from,
    and a row without doc_id is not held out. Only the text is an input of a score. Repeated rows
    get a row each. Without usable labels every score is 0.5.
    """
    model, pooled = fit(docs, labels, sample)
    network = docs.sparkSession.sparkContext.broadcast(model.network)

    @F.pandas_udf(T.DoubleType())
    def score(features: pd.Series) -> pd.Series:
        return pd.Series(network.value.probability(np.stack(features.to_list()).astype(np.float64)) if len(features) else [])

    scored = pooled.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), score("features").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns."""
    model, pooled = fit(docs, labels, sample)
    release(pooled)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pool(batch.column("text").cast(pa.string()), held.value.vectors).astype(np.float64)
            yield batch.filter(pa.array(held.value.network.probability(x) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
