"""Repeated lines: two Bloom filters find suspects, only those are shuffled and decided exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortlist.llm import bloom
from shortlist.llm.rows import pack, unpack
from shortlist.session import durable, release

MIN_CHARS = 40
MIN_DOCS = 5
BITS_PER_DOCUMENT = 128


def line_keys(text: bytes, min_chars: int) -> list[tuple[int, bytes]]:
    """(line number, digest of the key) of the lines whose key has at least ``min_chars`` code points."""
    out = []
    for i, line in enumerate(text.split(b"\n")):
        key = line.strip(b" \t\n\v\f\r").lower()
        if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
            out.append((i, hashlib.blake2b(key, digest_size=16).digest()))
    return out


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column("text").cast(pa.binary()):
        yield value.as_py() or b""


def _filters(bits: int, min_chars: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            seen: dict[bytes, int] = {}
            for text in _texts(batch):
                for digest in {d for _, d in line_keys(text, min_chars)}:
                    seen[digest] = seen.get(digest, 0) + 1
            if seen:
                places = bloom.places(b"".join(seen), bits)
                again = bloom.has(once, places) | (np.fromiter(seen.values(), np.int64, len(seen)) > 1)
                bloom.put(twice, places[again])
                bloom.put(once, places)
        yield from bloom.cut(once, twice)

    return build


def repeat_filter(docs: DataFrame, min_chars: int = MIN_CHARS, bits: int | None = None) -> tuple[int, bytes]:
    """(bits, filter) that holds the key of every line that is in two rows of ``docs`` or more.

    Each task fills a filter of what it saw once and one of what it saw again; the filters are
    merged piece by piece. Their size follows the number of documents between 128 KB and 128 MB.
    A fuller filter only passes more lines on to the exact step.
    """
    if bits is None:
        bits = bloom.size_for(docs.count(), BITS_PER_DOCUMENT)
    pieces = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_filters(bits, min_chars), bloom.PIECES)
    return bits, bloom.collect(pieces, bits, "twice")


def _with_suspects(docs: DataFrame, bits: int, filter_, min_chars: int) -> DataFrame:
    """``docs`` with the numbers and digests of the lines that the filter holds."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = np.frombuffer(filter_.value, np.uint8)
        for batch in batches:
            lines, digests = [], []
            for text in _texts(batch):
                keys = line_keys(text, min_chars)
                if keys:
                    hit = bloom.has(repeated, bloom.places(b"".join(d for _, d in keys), bits))
                    keys = [k for k, h in zip(keys, hit) if h]
                lines.append([i for i, _ in keys])
                digests.append([d for _, d in keys])
            columns = [*batch.columns, pa.array(lines, pa.list_(pa.int32())), pa.array(digests, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_lines", "_digests"])

    marks = T.StructType([
        *docs.schema.fields,
        T.StructField("_lines", T.ArrayType(T.IntegerType())), T.StructField("_digests", T.ArrayType(T.BinaryType())),
    ])
    return docs.mapInArrow(mark, marks)


def _cut(text: str | None, drop) -> str | None:
    if text is None or drop is None:
        return text
    gone = set(drop)
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)


@F.pandas_udf(T.StringType())
def _without(texts: pd.Series, lines: pd.Series) -> pd.Series:
    return pd.Series([_cut(t, drop) for t, drop in zip(texts, lines)], dtype=object)


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text, other columns) with ``text`` reduced, and n_lines, n_dropped added.

    A text is split at \\n; null and empty texts are one empty line and stay as they are. A line's
    key is the line without ASCII white space at both ends, with A-Z lower-cased. A key of at least
    ``min_chars`` code points that is in at least ``min_docs`` documents loses its lines in all
    documents but the one with the largest doc_id, which keeps all of them. Documents count by
    doc_id; rows without one are one document, smaller than any other. Repeated rows are treated
    alike. All other columns are passed through; one named n_lines or n_dropped is replaced.

    Documents without a suspected line never leave their task. Suspected lines are shuffled as
    128-bit digests, and a repeated line's count and largest doc_id are combined before the shuffle.
    """
    spark = docs.sparkSession
    names = docs.columns
    docs = pack(docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string")), "doc_id", "text")
    bits, filter_ = repeat_filter(docs, min_chars, bits)
    held = spark.sparkContext.broadcast(filter_)
    key = F.xxhash64("text").alias("_text_hash")

    marked = _with_suspects(docs.select("doc_id", "text"), bits, held, min_chars).where(F.size("_lines") > 0)
    suspects = durable(
        marked.select("doc_id", key, F.explode(F.arrays_zip("_lines", "_digests")).alias("s"))
        .select("doc_id", "_text_hash", F.col("s._lines").alias("line"), F.col("s._digests").alias("digest"))
    )
    repeated = (
        suspects.select("digest", "doc_id").distinct().groupBy("digest")
        .agg(F.count("*").alias("docs"), F.max("doc_id").alias("last")).where(F.col("docs") >= min_docs).drop("docs")
    )
    drops = durable(
        suspects.join(repeated, "digest").where(~F.col("doc_id").eqNullSafe(F.col("last")))
        .groupBy(F.col("doc_id").alias("_doc_id"), F.col("_text_hash").alias("_hash")).agg(F.collect_set("line").alias("_drop"))
    )
    release(suspects)

    marked = _with_suspects(docs, bits, held, min_chars)
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines")
    others = [c for c in docs.columns if c != "text"]
    clean = marked.where(F.size("_lines") == 0).select(*others, "text", n_lines, F.lit(0).cast("long").alias("n_dropped"))
    dirty = marked.where(F.size("_lines") > 0).select(*docs.columns, key)
    dirty = dirty.join(
        drops.hint("shuffle_hash"),
        F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_text_hash") == F.col("_hash")), "left",
    ).select(
        *others, F.when(F.col("_drop").isNull(), F.col("text")).otherwise(_without("text", "_drop")).alias("text"), n_lines,
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    return unpack(clean.unionByName(dirty), names, ("doc_id", "text"), ("n_lines", "n_dropped"))
