"""The classifier on labelled tables: held-out accuracy, calibration inputs, edge rows."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa

from shortlist.llm import quality, words

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.predictions(docs, labels)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 500
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.99
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    # stated probabilities agree with how often they come true
    assert abs(np.mean([r.score for r in rows]) - np.mean([r.quality for r in rows])) < 0.05


def test_folds_and_edge_rows(spark, docs):
    rows = [(i, f"good text number {i} goes on" if i % 2 else f"### {i} !!! $$$") for i in range(60)]
    rows += [(100, None), (101, ""), (101, ""), (None, "x"), (102, "w " * 100_000)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (3, None, 0), (5, 9, 0)], "doc_id long, quality int, toxic int")
    got = quality.predictions(docs(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 60]) > 0.9
    kept = quality.keep_good(docs(rows), labels)
    assert kept.columns == docs([]).columns
    want = {r.doc_id for r in got if r.predicted}
    assert {r.doc_id for r in kept.collect()} == want


def test_held_out_labels_teach_nothing(spark, docs):
    rows = [(i, f"some text {i}") for i in range(40)]
    schema = "doc_id long, quality int, toxic int"
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    score = lambda flip: {
        r.doc_id: r.score for r in quality.predictions(docs(rows), spark.createDataFrame(
            [(i, (i + (flip if i in held else 0)) % 2, 0) for i, _ in rows], schema)).collect()}
    assert score(0) == score(1)


def test_no_labels_no_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.predictions(docs([(1, "a b"), (2, None)]), none).collect()} == {0.5}
    assert quality.predictions(docs([]), none).count() == 0


def plain_mix(h):
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> 33)) * factor % 2**64
    return h ^ (h >> 33)


def plain_tokens(text):
    return re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff \t\n\v\f\r]+", text or "")


def token_hash(token):
    raw = np.frombuffer(token.encode(), np.uint8)
    return int(words.word_hashes(raw, np.array([0]), np.array([len(raw)]), words.SAME)[0])


def index_vector(h):
    out = np.zeros(quality.DIMS)
    for k in range(quality.NONZERO):
        d = plain_mix((h + k + 1) % 2**64)
        out[d % quality.DIMS] += 1 if d >> 40 & 1 else -1
    return out


def test_vectors_and_pooling_against_plain_python(spark, docs):
    rng = random.Random(2)
    vocabulary = ["the", "Été", "a1", "dog", "...", "!?", "#", "new ", "x" * 70, "\x01", "7", "Dog"]
    texts = ["".join(rng.choice(vocabulary) + rng.choice(["", " ", "\n", "  ", "\t"]) for _ in range(rng.randrange(0, 60))) for _ in range(70)]
    texts += [None, "", " \n", "one", texts[0]]
    table = docs(list(enumerate(texts)))
    got = quality.word_vectors(table)

    sums = {}
    for text in texts:
        hashes = [token_hash(t) for t in plain_tokens(text)]
        for i, h in enumerate(hashes):
            for j in range(max(0, i - quality.REACH), min(len(hashes), i + quality.REACH + 1)):
                if j != i:
                    bucket = h % quality.BUCKETS
                    sums[bucket] = sums.get(bucket, 0) + index_vector(hashes[j])
    common = sum(sums.values())
    common = common / max(np.linalg.norm(common), 1)
    want = {}
    for bucket, v in sums.items():
        v = v - (v @ common) * common
        want[bucket] = v / (np.linalg.norm(v) or 1)
    assert np.allclose(got[list(want)], list(want.values()), atol=1e-6)
    assert not got[[b for b in range(quality.BUCKETS) if b not in want]].any()

    pooled = quality.pool(pa.array(texts), got)
    for row, text in zip(pooled, texts):
        own = np.array([got[token_hash(t) % quality.BUCKETS] for t in plain_tokens(text)], float)
        if not len(own):
            assert not row.any()
            continue
        mean, alike = own.mean(axis=0), [0.0, *(a @ b for a, b in zip(own, own[1:]))]
        spread = np.sqrt(np.maximum((own**2).mean(axis=0) - mean**2, 0))
        rest = [np.linalg.norm(mean), np.log1p(len(own)), len(text.encode()) / len(own), sum(alike) / len(own)]
        assert np.allclose(row, [*mean, *spread, *rest], atol=2e-3, rtol=1e-4)
        assert np.allclose(row[: quality.DIMS], mean, atol=1e-6)
