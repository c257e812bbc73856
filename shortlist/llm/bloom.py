"""Bloom filters that tasks fill side by side and that are merged piece by piece."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shortlist.llm import words

HASHES = 3
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 30  # a filter is at most 128 MB, whatever the input
PIECE_BYTES = 1 << 16
PIECES = "piece long, once binary, twice binary"


def size_for(items: int, bits_each: int = 16) -> int:
    """A power of two that gives ``items`` some bits each, within the limits. Beyond the limit a
    filter is fuller and lets more pass that it does not hold; nothing it holds is ever missed."""
    wanted = max(LEAST_BITS, bits_each * items)
    return min(MOST_BITS, 1 << (wanted - 1).bit_length())


def places(digests: bytes, bits: int) -> np.ndarray:
    """The ``HASHES`` bit numbers of each 16-byte digest."""
    halves = np.frombuffer(digests, np.uint64).reshape(-1, 2)
    steps = np.arange(HASHES, dtype=np.uint64)
    return (halves[:, :1] + steps * (halves[:, 1:] | np.uint64(1))) & np.uint64(bits - 1)


def places_of_ids(ids: np.ndarray, bits: int) -> np.ndarray:
    h = ids.astype(np.int64).view(np.uint64)
    return places(np.stack([words.mix(h + np.uint64(1)), words.mix(~h)], 1).tobytes(), bits)


def has(held: np.ndarray, at: np.ndarray) -> np.ndarray:
    masks = np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8))
    return ((held[at >> np.uint64(3)] & masks) != 0).all(axis=1)


def put(held: np.ndarray, at: np.ndarray) -> None:
    masks = np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8))
    np.bitwise_or.at(held, (at >> np.uint64(3)).ravel(), masks.ravel())


def piece(number: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([number]), pa.array([once.tobytes()]), pa.array([twice.tobytes()])]
    return pa.record_batch(columns, names=["piece", "once", "twice"])


def cut(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The pieces of a pair of filters that hold anything."""
    for start in range(0, len(once), PIECE_BYTES):
        part = once[start : start + PIECE_BYTES]
        if part.any():
            yield piece(start, part, twice[start : start + PIECE_BYTES])


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by piece. What two parts saw once each has been seen twice."""
    at, once, twice = None, None, None
    for batch in batches:
        for number, o, t in zip(*(batch.column(c) for c in ("piece", "once", "twice"))):
            o, t = np.frombuffer(o.as_py(), np.uint8), np.frombuffer(t.as_py(), np.uint8)
            if number.as_py() == at:
                twice = twice | t | (once & o)
                once = once | o
            else:
                if at is not None:
                    yield piece(at, once, twice)
                at, once, twice = number.as_py(), o, t
    if at is not None:
        yield piece(at, once, twice)


def collect(pieces: DataFrame, bits: int, which: str) -> bytes:
    """The merged filter ``which`` (once or twice) of all pieces, on the driver."""
    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    merged = pieces.repartition(n, "piece").sortWithinPartitions("piece").mapInArrow(merge, PIECES)
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.select("piece", which).toLocalIterator():
        out[row.piece : row.piece + PIECE_BYTES] = np.frombuffer(row[which], np.uint8)
    return out.tobytes()


def of_ids(ids: DataFrame) -> tuple[int, bytes]:
    """(bits, filter) of the values of a table's only column, a long."""
    bits = size_for(ids.count())
    name = ids.columns[0]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            put(held, places_of_ids(batch.column(name).to_numpy(zero_copy_only=False), bits))
        yield from cut(held, np.zeros_like(held))

    return bits, collect(ids.mapInArrow(build, PIECES), bits, "once")
