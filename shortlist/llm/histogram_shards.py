"""Shards of equal bytes by histogram sort: exact counts below candidate keys, refined, then one exchange."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shortlist.llm import words
from shortlist.llm.rows import pack, unpack
from shortlist.session import durable

SHARDS = 16
PROBES = 32  # candidate keys for each open splitter and round
PIECES = 8  # parts of a shard that are sorted side by side, at least
PIECE_BYTES = 512 << 20  # of text in a part, about
KEY_BYTES = 32
LEAST = -(1 << 63)


class Edge(NamedTuple):
    """A key, and the exact rows and bytes below it. The end of the order has no key."""

    key: bytes | None
    rows: int
    bytes: int


def size_of(text: Column) -> Column:
    """UTF-8 bytes of a text, none for null, and one."""
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long") + 1


def order_key(text: Column, doc_id: Column, row: Column) -> Column:
    """32 bytes that sort by digest of the text, then doc_id (null first), then row number. Equal texts
    are neighbours, and no two rows are equal."""
    eight = lambda number: F.unhex(F.lpad(F.hex(number), 16, "0"))
    known = F.coalesce(doc_id.cast("long"), F.lit(LEAST))
    return F.concat(F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")))), eight(known.bitwiseXOR(F.lit(LEAST))), eight(row))


def _keys(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.binary(KEY_BYTES))
    return np.frombuffer(column.buffers()[1], f"S{KEY_BYTES}")[column.offset : column.offset + len(column)]


def _edges(held: bytes) -> np.ndarray:
    return np.frombuffer(held, f"S{KEY_BYTES}")


def _draw(rows: DataFrame, edges: list[bytes], share: np.ndarray, turn: int) -> list[bytes]:
    """Keys drawn with the probability ``share`` of the bin between ``edges`` that they lie in."""
    held = rows.sparkSession.sparkContext.broadcast((b"".join(edges), share, turn))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_keys, share, turn = held.value
        for batch in batches:
            keys = _keys(batch.column("_key"))
            parts = keys.view(">u8").reshape(-1, KEY_BYTES // 8).astype(np.uint64)
            dice = words.mix(words.mix(parts[:, 3] + np.uint64(turn)) ^ parts[:, 0] ^ parts[:, 2])
            odds = share[np.searchsorted(_edges(sorted_keys), keys, "right")]
            taken = (dice >> np.uint64(11)).astype(np.float64) / (1 << 53) < odds
            if taken.any():
                yield pa.record_batch([batch.column("_key").filter(pa.array(taken))], names=["key"])

    return [bytes(r.key) for r in rows.select("_key").mapInArrow(draw, "key binary").collect()]


def _count(rows: DataFrame, edges: list[bytes], wanted: np.ndarray) -> dict[int, tuple[int, int]]:
    """Rows and bytes of the wanted bins: bin i lies before edge i, at or after edge i - 1."""
    held = rows.sparkSession.sparkContext.broadcast((b"".join(edges), wanted))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_keys, wanted = held.value
        n, size = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
        for batch in batches:
            at = np.searchsorted(_edges(sorted_keys), _keys(batch.column("_key")), "right")
            n += np.bincount(at, minlength=len(n))
            np.add.at(size, at, batch.column("_bytes").to_numpy(zero_copy_only=False))
        hit = np.flatnonzero((n > 0) & wanted)
        yield pa.record_batch([pa.array(hit), pa.array(n[hit]), pa.array(size[hit])], names=["bin", "n", "size"])

    bins = rows.select("_key", "_bytes").mapInArrow(tally, "bin long, n long, size long")
    return {r.bin: (r.n, r.size) for r in bins.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).collect()}


def splitters(rows: DataFrame, targets: Sequence[int], slack: Sequence[int], probes: int = PROBES) -> list[Edge]:
    """For each of the ascending byte counts ``targets`` an edge of the order of ``_key``.

    With slack it is the nearer known edge that has ``target`` bytes below it, give or take the
    slack. Without, or where rows are larger than it, the first edge that has at least ``target``
    bytes below it. Each round draws about ``probes`` keys from every gap that still holds an open
    splitter, counts rows and bytes below them in all partitions, and closes the gaps around the
    targets. The driver holds the splitters, their gaps and the drawn keys, never all keys.
    """
    total = rows.agg(F.count("*").alias("n"), F.sum("_bytes").alias("size")).first()
    start, end = Edge(b"\0" * KEY_BYTES, 0, 0), Edge(None, total.n, total.size or 0)
    gaps = [(start, end)] * len(targets)
    turn = 0
    while True:
        still = {}
        for (low, high), target, room in zip(gaps, targets, slack):
            near = min(high.bytes - target, target - low.bytes if room else high.bytes)
            if near > room and high.rows - low.rows > 1:
                still[low, high] = still.get((low, high), 0) + 1
        if not still:
            break
        edges = sorted({e.key for gap in still for e in gap if e.key is not None})
        share = np.zeros(len(edges) + 1)
        for (low, high), wanted in still.items():
            share[bisect_left(edges, low.key) + 1] = min(1.0, probes * wanted / (high.rows - low.rows))
        drawn = _draw(rows, edges, share, turn)
        turn += 1
        edges = sorted({*edges, *drawn})
        inside = np.zeros(len(edges) + 1, bool)
        spans = {}
        for low, high in still:
            spans[low, high] = bisect_left(edges, low.key) + 1, len(edges) if high.key is None else bisect_left(edges, high.key)
            inside[spans[low, high][0] : spans[low, high][1] + 1] = True
        counts = _count(rows, edges, inside)
        known = {}
        for (low, high), (first, last) in spans.items():
            known[low, high] = [low]
            for i in range(first, last):
                n, size = counts.get(i, (0, 0))
                known[low, high].append(Edge(edges[i], known[low, high][-1].rows + n, known[low, high][-1].bytes + size))
            known[low, high].append(high)
        for i, (gap, target) in enumerate(zip(gaps, targets)):
            if gap in known:
                # the first edge with enough bytes below it, and the one before
                at = max(bisect_left(known[gap], target, key=lambda e: e.bytes), 1)
                gaps[i] = known[gap][at - 1], known[gap][at]
    return [low if room and abs(target - low.bytes) < abs(high.bytes - target) else high for (low, high), target, room in zip(gaps, targets, slack)]


def shard(docs: DataFrame, shards: int = SHARDS, pieces: int = PIECES, piece_bytes: int = PIECE_BYTES, probes: int = PROBES) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... within the shard) added.

    A row's size is the UTF-8 bytes of its text and one. In the order of (digest of the text,
    doc_id), a row with b of all B bytes before it goes to shard floor(shards * b / B), so shards
    differ by no more than the largest row, and slots follow the same order. Equal texts lie side by
    side, in one shard unless a border falls among them: a group larger than a shard has to be cut,
    and is cut by doc_id. Rows equal in both are told apart by their place in the written table.

    Null texts count as empty, null doc_ids come first; an empty table stays empty, and with few rows
    some shards are. All other columns are passed through; those named shard or slot are replaced.

    The rows are written once with their keys, so that every round and the exchange see the same
    ones; rounds read only key and size. Borders of shards are exact, those of the ``pieces`` or more
    parts of a shard, of ``piece_bytes`` at most, may be off by a quarter of a part. The only exchange
    is by part; a slot is the exact count of rows before the part and the row's place in it.
    """
    names = docs.columns
    packed = pack(docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string")), "doc_id", "text")
    key = order_key(F.col("text"), F.col("doc_id"), F.monotonically_increasing_id())
    rows = durable(packed.select("*", key.alias("_key"), size_of(F.col("text")).alias("_bytes")))
    total = rows.agg(F.sum("_bytes")).first()[0] or 0

    pieces = max(pieces, -(-total // (shards * piece_bytes)))
    parts = range(1, shards * pieces)
    exact = [p % pieces == 0 for p in parts]
    targets = [-(-p * total // (shards * pieces)) for p in parts]
    room = total // (shards * pieces * 4)
    found = [Edge(b"", 0, 0), *splitters(rows, targets, [0 if e else room for e in exact], probes), Edge(None, 0, total + 1)]
    for p in parts:  # a part's border stays between those of its shard, also where rows are larger than parts
        if p % pieces:
            low, high = found[p - p % pieces], found[min(p - p % pieces + pieces, len(found) - 1)]
            found[p] = min(max(found[p], found[p - 1], low, key=lambda e: e.bytes), high, key=lambda e: e.bytes)
    last = b"\xff" * KEY_BYTES
    borders = b"".join(last if e.key is None else e.key for e in found[1:-1])
    first_row = np.array([e.rows for e in found[:-1]], np.int64)
    base = first_row - np.repeat(first_row[::pieces], pieces)
    held = docs.sparkSession.sparkContext.broadcast((borders, base))

    @F.pandas_udf("part long, shard int, base long")
    def place(keys: pd.Series) -> pd.DataFrame:
        borders, base = held.value
        part = np.searchsorted(_edges(borders), keys.to_numpy().astype(f"S{KEY_BYTES}"), "right")
        return pd.DataFrame({"part": part, "shard": (part // pieces).astype(np.int32), "base": base[part]})

    rank = F.row_number().over(Window.partitionBy("_part").orderBy("_key"))
    out = rows.withColumn("_place", place("_key")).select(*packed.columns, "_key", F.col("_place.part").alias("_part"), "_place.shard", "_place.base")
    out = out.withColumn("slot", F.col("base") + rank - 1)
    return unpack(out, names, ("doc_id", "text"), ("shard", "slot"))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """``shard(docs)`` as Parquet, one folder a shard, each file a run of slots in order."""
    shard(docs, **options).write.partitionBy("shard").parquet(path)
