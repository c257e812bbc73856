"""Repeated passages: runs of consecutive sentences are hashed, joined over all texts, and removed but once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortlist.llm import bloom, words
from shortlist.llm.rows import pack, unpack
from shortlist.session import durable, release

RUN = 2  # pieces in a span, at least
MIN_WORDS = 25  # words in a span, at least; shorter ones are common phrases, not passages
LONG = 16  # words; longer sentences are cut at inner punctuation, and what is still longer
LONG_CUT = 4  # after one word in so many, by its hash
BITS_PER_DOCUMENT = 512

_END = np.zeros(256, bool)
_END[[0x21, 0x2E, 0x3F]] = True  # ! . ?
_INNER = np.zeros(256, bool)
_INNER[[0x2C, 0x3A, 0x3B]] = True  # , : ;


def sentences(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ends, hashes and word counts of the sentences, and where each text's sentences begin.

    A sentence ends before a line break, after . ! or ? with white space behind it, and with its
    text. One of more than ``LONG`` words also ends after , ; or : with white space behind it, and
    what is still longer after each word whose hash is a multiple of ``LONG_CUT``. These ends cut the
    same words the same way wherever they stand, so a passage within a longer sentence has sentences
    of its own. What has no word belongs to the sentence before it, or to the first one.
    """
    starts, stops, word_bounds = words.word_spans(raw, offsets, words.WORD)
    hashes = words.word_hashes(raw, starts, stops)
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = (_END[raw[:-1]] & words.SPACE[raw[1:]]) | (raw[1:] == 0x0A)
    cut[offsets] = True

    def too_long(places: np.ndarray) -> np.ndarray:
        """Whether each place lies in a sentence, as cut so far, of more than LONG words."""
        points = np.flatnonzero(cut)
        size = np.bincount(np.searchsorted(points, stops), minlength=len(points) + 1)
        return size[np.searchsorted(points, places)] > LONG

    inner = np.flatnonzero(_INNER[raw[:-1]] & words.SPACE[raw[1:]]) + 1
    cut[inner[too_long(inner)]] = True
    cut[stops[(hashes % np.uint64(LONG_CUT) == 0) & too_long(stops)]] = True
    points = np.flatnonzero(cut)
    points = points[points > 0]
    text_end = np.zeros(len(raw) + 1, bool)
    text_end[offsets[1:]] = True
    # number of words that end at or before each point, and before its text
    so_far = np.searchsorted(stops, points, "right")
    of_text = np.searchsorted(offsets[1:], points)
    has_word = np.diff(so_far, prepend=0) > 0
    closes = np.append(has_word[1:], True) | text_end[points]
    keep = closes & (so_far > word_bounds[of_text])
    ends, last = points[keep], so_far[keep]
    first = np.concatenate([[0], last[:-1]]) if len(last) else last
    counts = last - first
    # order-dependent sum: each word is mixed with its place in the sentence
    place = np.arange(len(hashes)) - np.repeat(first, counts) if len(ends) else np.zeros(0, np.int64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(words.mix(hashes ^ (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)), out=sums[1:])
    return ends, words.mix(sums[last] - sums[first]), counts, np.searchsorted(ends, offsets, "right")


def _spans(raw: np.ndarray, offsets: np.ndarray, run: int, min_words: int):
    """Text number, place, size and two hashes of the shortest runs that count from and up to every sentence.

    A run has at least ``run`` sentences and ``min_words`` words. Those that begin at a sentence
    reach all but the end of a passage, those that end at one reach its end too.
    """
    _, hashes, counts, bounds = sentences(raw, offsets)
    n = len(hashes)
    total = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.arange(n)
    stop = np.maximum(at + run, np.searchsorted(total, total[:-1] + min_words))
    start = np.minimum(at + 1 - run, np.searchsorted(total, total[1:] - min_words, "right") - 1)
    ahead, back = stop <= bounds[text + 1], start >= bounds[text]
    pairs = np.unique(np.concatenate([at[ahead] * (n + 1) + stop[ahead], start[back] * (n + 1) + at[back] + 1]))
    first, end = pairs // (n + 1), pairs % (n + 1)
    h1 = words.range_hashes(hashes, first, end)
    h2 = words.range_hashes(words.mix(hashes + np.uint64(1)), first, end)
    return text[first], first - bounds[text[first]], end - first, h1, h2


def _digests(h1: np.ndarray, h2: np.ndarray) -> bytes:
    return np.stack([h1, h2], 1).tobytes()


def _filters(bits: int, run: int, min_words: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for _, _, raw, offsets in words.chunks(batch.column("text")):
                _, _, _, h1, h2 = _spans(raw, offsets, run, min_words)
                _, where, n = np.unique(h1, return_index=True, return_counts=True)
                at = bloom.places(_digests(h1[where], h2[where]), bits)
                bloom.put(twice, at[bloom.has(once, at) | (n > 1)])
                bloom.put(once, at)
        yield from bloom.cut(once, twice)

    return build


def _suspects(run: int, min_words: int, bits: int, held):
    """Runs that the filter of repeated ones holds."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = np.frombuffer(held.value, np.uint8)
        for batch in batches:
            for begin, last, raw, offsets in words.chunks(batch.column("text")):
                text, place, size, h1, h2 = _spans(raw, offsets, run, min_words)
                hit = bloom.has(repeated, bloom.places(_digests(h1, h2), bits)) if len(h1) else np.zeros(0, bool)
                of = pa.array(text[hit] + begin)
                yield pa.record_batch(
                    [batch.column("doc_id").take(of), batch.column("text_hash").take(of), pa.array(place[hit].astype(np.int32)), pa.array(size[hit].astype(np.int32)),
                     pa.array(h1[hit].view(np.int64)), pa.array(h2[hit].view(np.int64))],
                    names=["doc_id", "text_hash", "place", "size", "h1", "h2"],
                )

    return hashed


def _cut(text: str, gone) -> tuple[str, int, int]:
    """The text without the sentences that the runs ``gone`` cover, the number of sentences, and how many went."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    ends = sentences(raw, np.array([0, len(raw)]))[0]
    if len(ends) == 0:
        return text, 0, 0
    if gone is None or len(gone) == 0:
        return text, len(ends), 0
    # white space at a text's start or end goes with the nearest sentence
    edges = np.concatenate([[0], ends])
    edges[-1] = len(raw)
    gone = np.asarray(gone, np.int64)
    change = np.zeros(len(ends) + 1, np.int64)
    np.add.at(change, gone >> 32, 1)
    np.add.at(change, (gone >> 32) + (gone & 0xFFFFFFFF), -1)
    kept = np.flatnonzero(np.cumsum(change)[:-1] == 0)
    return b"".join(raw[edges[i] : edges[i + 1]].tobytes() for i in kept).decode("utf-8", "surrogatepass"), len(ends), len(ends) - len(kept)


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType())]))
def _without(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_cut(t, g) for t, g in zip(texts, gone)], columns=["text", "n_sentences", "n_removed"])


def drop_repeated_passages(docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, other columns) with ``text`` reduced, and n_sentences, n_removed added.

    For sentences see ``sentences``; two are equal if their words are, with A-Z lower-cased. Runs of
    ``run`` consecutive sentences or more, as long as ``min_words`` words need, from and up to every
    sentence, are looked up among those of all texts. The first occurrence is the one in the
    smallest doc_id (none before all others), there at the smallest place; sentences that any other
    occurrence covers are removed. Of a passage that begins or ends inside a sentence of more than
    ``LONG`` words the words up to the first and after the last cut stay.

    A shorter text has no run. Null and empty texts stay. Rows with equal doc_id and text are one
    document, and each is reduced alike. All other columns are passed through; one named n_sentences
    or n_removed is replaced.

    Bloom filters tell which runs may occur twice; only those travel, as two hashes with their
    place. How often one occurs and where first is combined before the shuffle, so a passage in any
    share of the texts meets no single task.
    """
    names = docs.columns
    docs = pack(docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string")), "doc_id", "text")
    text = F.coalesce("text", F.lit("")).alias("text")
    texts = docs.select("doc_id", text).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    bits = bloom.size_for(docs.count(), BITS_PER_DOCUMENT)
    pieces = texts.select("text").mapInArrow(_filters(bits, run, min_words), bloom.PIECES)
    held = docs.sparkSession.sparkContext.broadcast(bloom.collect(pieces, bits, "twice"))
    runs = durable(texts.mapInArrow(_suspects(run, min_words, bits, held), "doc_id long, text_hash long, place int, size int, h1 long, h2 long"))
    where = F.struct("doc_id", "text_hash", "place")
    firsts = durable(runs.groupBy("h1", "h2").agg(F.min(where).alias("first")))
    covered = runs.join(firsts, ["h1", "h2"]).where(where != F.col("first"))
    # a covered run as one number: its place and its size
    span = F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(F.col("size").cast("long")).alias("span")
    covered = covered.select(F.struct("doc_id", "text_hash").alias("_of"), span)
    gone = durable(covered.groupBy("_of").agg(F.collect_list("span").alias("_gone")))
    release(firsts, runs)
    keyed = docs.withColumn("_key", F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")))
    joined = keyed.join(gone.hint("shuffle_hash"), F.col("_key") == F.col("_of"), "left")
    cut = joined.withColumn("_cut", _without(F.coalesce("text", F.lit("")), F.col("_gone")))
    reduced = cut.select(
        "doc_id", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.col("_cut.text")).alias("text"), "_rest",
        "_cut.n_sentences", "_cut.n_removed",
    )
    return unpack(reduced, names, ("doc_id", "text"), ("n_sentences", "n_removed"))
