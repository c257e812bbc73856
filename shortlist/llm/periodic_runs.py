"""Periodic runs of words: seeds on diagonals of equal k-grams, extended once for each lag and place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortlist.llm.rows import pack, unpack

MIN_WORDS = 6
MIN_PERIODS = 4
WORD = r"[^\x20\x09-\x0D]+"

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
_RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


def _least_overlap(low: int, high: int, min_words: int, min_periods: int) -> int:
    """The fewest places over which a run agrees with itself shifted by its period, for the periods
    from ``low`` to before ``high``."""
    turn = min_words // min_periods
    periods = {min(max(q, low), high - 1) for q in (low, turn, turn + 1, high - 1)}
    return min(max(min_words, min_periods * q) - q for q in periods)


def _seeds(keys: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int]]:
    """(place, lag) of k-grams that occur next at a lag from ``low`` to before ``high``, by lag and
    place; of neighbouring places with one lag only the first."""
    order = np.argsort(keys, kind="stable")
    by_key, lags = keys[order], np.diff(order)
    hit = (by_key[1:] == by_key[:-1]) & (lags >= low) & (lags < high)
    places, lags = order[:-1][hit], lags[hit]
    by_lag = np.lexsort((places, lags))
    places, lags = places[by_lag], lags[by_lag]
    head = np.ones(len(places), bool)
    head[1:] = (np.diff(lags) != 0) | (np.diff(places) != 1)
    yield from zip(places[head].tolist(), lags[head].tolist())


def _agreement(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries of two arrays of one length agree, looked at in growing blocks."""
    at, step = 0, 16
    while at < len(a):
        differs = np.flatnonzero(a[at : at + step] != b[at : at + step])
        if len(differs):
            return at + int(differs[0])
        at, step = at + step, 2 * step
    return len(a)


def find_runs(ids: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all stretches of a sequence of numbers that have at least
    ``min_words`` entries and ``min_periods`` periods and that no neighbour extends, by start and period.

    Lags are taken in classes from 2^j to before 2^(j+1). A run of period q agrees with itself
    shifted by q over length - q places; the least such number of a class is its k, so both ends of
    every run's diagonal hold equal k-grams. With three periods or more, k is no shorter than any
    lag of the class. Then the next place of a k-gram inside a run is exactly one period on, and one
    pair for each place is enough; a longer period that is no smallest one is never paired. k-grams
    have exact numbers, made by doubling. A table of the furthest place covered on each lag keeps a
    diagonal from being extended twice. A class costs one sort; it ends where no longer stretch repeats.
    """
    if min_periods < 3:
        raise ValueError("fewer than three periods are not supported")
    n = len(ids)
    found: list[tuple[int, int, int]] = []
    names, size = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    low = 1
    while max(min_words, min_periods * low) <= n:
        high = 2 * low
        k = _least_overlap(low, high, min_words, min_periods)
        while 2 * size <= k:
            pairs, names = np.unique(names[:-size] * n + names[size:], return_inverse=True)
            size *= 2
            if len(pairs) == len(names):
                return sorted(found)
        more = k - size
        keys = names[:-more] * n + names[more:] if more else names
        covered: dict[int, int] = {}
        for place, lag in _seeds(keys, low, high):
            if place < covered.get(lag, 0):
                continue
            left = place - _agreement(ids[:place][::-1], ids[lag : lag + place][::-1])
            covered[lag] = place + _agreement(ids[place : n - lag], ids[place + lag :])
            length = covered[lag] - left + lag
            if length >= max(min_words, min_periods * lag):
                found.append((left, length, lag))
        low = high
    return sorted(found)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words)


def _scan(min_words: int, min_periods: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, texts = [], [], []
            for value in batch.column("text").cast(pa.large_binary()):
                # bytes.split cuts at the six characters of ASCII white space and nowhere else
                words = (value.as_py() or b"").split()
                numbers: dict[bytes, int] = {}
                ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
                own = find_runs(ids, min_words, min_periods) if len(numbers) < len(words) else []
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                texts.append(_collapsed(words, own))
            added = [pa.array(counts, pa.int64()), pa.array(runs, _RUNS), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "n_words", "runs", "collapsed"])

    return scan


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """``docs`` with n_words, runs (start, length, period, in words) and ``collapsed`` added.

    Words are runs of characters other than ASCII white space, numbered from 0. A run is a stretch
    of words with smallest period ``period`` that has at least ``min_words`` words and
    ``min_periods`` periods and that neither neighbour extends. ``collapsed`` is the text's words
    joined by one blank, without those that some run holds after its first period.

    A null or empty text has no words, no run and an empty ``collapsed``. Repeated rows get the same
    result, an empty table an empty one. All other columns are passed through; those named n_words,
    runs or collapsed are replaced. Every document is one task's work, of time n log n and memory
    linear in its words; nothing is shuffled.
    """
    names = docs.columns
    packed = pack(docs.withColumn("text", F.col("text").cast("string")), "text")
    schema = T.StructType([
        *packed.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType()),
    ])
    return unpack(packed.mapInArrow(_scan(min_words, min_periods), schema), names, ("text",), ("n_words", "runs", "collapsed"))


def with_looping_tails(docs: DataFrame) -> DataFrame:
    """``docs`` in which about one text in ten repeats itself from some word on, a number of times
    that its doc_id decides: with h = crc32 of the decimal doc_id, h % 10 = 0, g = h // 10 and n > 0
    words, word i >= a becomes word a + (i - a) % p, where a = g % n and p = 1 + (n - a) // (3 + g % 8).
    The words of such a text are joined by one blank. Rows without doc_id stay as they are."""

    def bound(value: Column, body) -> Column:
        """``body`` of a value that is computed once."""
        return F.transform(F.array(value), body)[0]

    def tail(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = (g % n).cast("int")
        rest = F.size(words) - a
        p = (1 + F.floor(rest / (3 + g % 8))).cast("int")
        loop = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil(rest / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(loop, F.lit(1), rest)), " ")

    text = F.col("text").cast("string")
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    looped = bound(words, lambda w: F.when(F.size(w) > 0, tail(w)).otherwise(text))
    return docs.withColumn("text", F.when((h % 10 == 0) & text.isNotNull(), looped).otherwise(text))
