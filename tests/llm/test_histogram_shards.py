"""Shards against one sorted list."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shortlist.llm import histogram_shards, queries


def plain(rows, shards):
    """(doc_id, text) -> Counter of (doc_id, text, shard, slot)."""
    digest = lambda t: hashlib.md5((t or "").encode()).digest()
    order = sorted(rows, key=lambda r: (digest(r[1]), r[0] is not None, r[0] or 0))
    total, before, used, out = sum(len((t or "").encode()) + 1 for _, t in rows), 0, Counter(), []
    for doc_id, text in order:
        at = shards * before // total
        out.append((doc_id, text, at, used[at]))
        used[at] += 1
        before += len((text or "").encode()) + 1
    return Counter((d, t or "", s, n) for d, t, s, n in out)


def sharded(table, **options):
    return Counter((r.doc_id, r.text or "", r.shard, r.slot) for r in histogram_shards.shard(table, **options).collect())


def compare(got, rows, shards):
    want = plain(rows, shards)
    # rows with equal doc_id and text may change places
    strip = lambda c: sorted(c.elements(), key=repr)
    assert strip(got) == strip(want)


@pytest.mark.parametrize(("shards", "probes"), [(16, 4), (3, 32), (1, 2)])
def test_one_third_of_the_rows_share_a_text(docs, shards, probes):
    rows = [(i, "copy of one text " * 5) for i in range(400)]
    rows += [(1000 + i, f"text {i} " * (i % 37)) for i in range(700)]
    rows += [(5000, "the same row é") for _ in range(90)] + [(i, None) for i in range(6000, 6050)] + [(None, "no id")] * 30 + [(-4, "")]
    got = sharded(docs(rows).repartition(5), shards=shards, probes=probes)
    compare(got, rows, shards)


def test_few_rows_long_rows_and_none(docs):
    for rows in ([(1, "a")], [(1, "x" * 100_000), (2, "b"), (3, None)], [(i, "") for i in range(5)]):
        compare(sharded(docs(rows)), rows, 16)
    out = histogram_shards.shard(docs([]))
    assert out.count() == 0 and out.columns == [*docs([]).columns, "shard", "slot"]


def test_borders_inside_a_shard_keep_the_slots(docs):
    rows = [(i, "w" * (i * 7919 % 300)) for i in range(900)]
    compare(sharded(docs(rows), shards=4, pieces=1, piece_bytes=2000), rows, 4)


def test_written_shards(spark, docs, tmp_path):
    rows = [(i, f"text {i}") for i in range(300)]
    histogram_shards.write_shards(docs(rows), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    compare(Counter((r.doc_id, r.text, r.shard, r.slot) for r in back.collect()), rows, 4)
    assert sorted(p.name for p in (tmp_path / "out").glob("shard=*")) == [f"shard={i}" for i in range(4)]


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents").select("doc_id", "text").collect()
    want = {d: (s, n) for d, _, s, n in plain([tuple(r) for r in docs], 16)}
    out = queries.QUERIES["op13_shards"](spark, sf)
    assert dict(out.dtypes) == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int",
    }
    texts = {r.doc_id: r.text for r in docs}
    for r in out.collect():
        body = (texts[r.doc_id] or "").encode()
        assert (r.shard, r.slot) == want[r.doc_id] and (r.size, r.text_crc32, r.law) == (len(body) + 1, zlib.crc32(body), "bytes")
    sizes = out.groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(sizes) == 16
