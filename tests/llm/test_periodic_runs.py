"""Periodic runs against a plain search over all starts and periods."""

import random
import zlib

import numpy as np
import pytest

from shortlist.llm import periodic_runs, queries


def plain_runs(words, min_words=6, min_periods=4):
    n, out = len(words), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            part = words[start : start + length]
            smaller = any(part[p:] == part[:-p] for p in range(1, q))
            if length >= max(min_words, min_periods * q) and not smaller:
                out.append((start, length, q))
    return sorted(out)


def plain_tail(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
@pytest.mark.parametrize("limits", [(6, 4), (1, 3), (25, 4), (3, 5)])
def test_runs_of_random_sequences(letters, limits):
    rng = random.Random(letters * 100 + limits[0])
    for _ in range(150):
        words = []
        while len(words) < rng.randrange(1, 120):
            unit = [rng.randrange(letters) for _ in range(rng.randrange(1, 12))]
            words += (unit * rng.randrange(1, 9))[: rng.randrange(1, 60)]
        assert periodic_runs.find_runs(np.array(words), *limits) == plain_runs(words, *limits), words


def test_one_word_many_times_and_few_periods():
    assert periodic_runs.find_runs(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    long = np.tile(np.arange(5_000), 40)
    assert periodic_runs.find_runs(long) == [(0, 200_000, 5_000)]
    assert periodic_runs.find_runs(np.zeros(0, np.int64)) == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(9, np.int64), 6, 2)


def test_rows_nulls_and_other_columns(docs):
    texts = [
        (1, "a b a b x a b a b a b a b"), (1, "a b a b x a b a b a b a b"), (2, None), (3, ""), (None, "\t x\nx\x0bx\x0cx x\r x "),
        (4, "é ê é ê é ê é ê"), (5, "one"),
    ]
    table = docs(texts)
    out = periodic_runs.periodic_runs(table)
    assert out.columns == [*table.columns, "n_words", "runs", "collapsed"]
    rows = out.collect()
    assert len(rows) == len(texts) and {r["_key"] for r in rows} == {1}
    for row in rows:
        words = [w.decode() for w in (row.text or "").encode().split()]
        runs = plain_runs(words)
        assert row.n_words == len(words) and [tuple(r) for r in row.runs] == runs
        assert row.collapsed == plain_collapsed(words, runs)
    assert periodic_runs.periodic_runs(docs([])).count() == 0


def test_query_on_whole_documents(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in queries.table(spark, sf, "documents").collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op12_periodic_runs"](spark, sf).collect()}
    assert got.keys() == texts.keys()
    some = 0
    for doc_id, text in texts.items():
        words = plain_tail(doc_id, [w.decode() for w in (text or "").encode().split()])
        if len(words) > 1500:
            continue
        runs, row = plain_runs(words), got[doc_id]
        some += len(runs) > 0
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
    assert some > 5
