"""Collocations against plain counting, with every number of shards."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from shortlist.llm import collocations


def plain_counts(rows, max_words=4):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    return f, n


def plain(rows, min_count, top, max_words=4):
    out = []
    f, n = plain_counts(rows, max_words)
    for lang, counts in f.items():
        listed = []
        frequent = [p for p, a in counts.items() if len(p) > 1 and a >= min_count]
        for p in frequent:
            a = counts[p]
            score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            longer = [counts[q] for q in frequent if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * x >= 80 * a for x in longer):
                listed.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(listed)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    fixed = ["new york city hall", "the quick fox", "État de la", "a a a a a", "x"]
    rows = []
    for _ in range(300):
        parts = []
        for _ in range(rng.randrange(0, 25)):
            parts.append(rng.choice(fixed) if rng.random() < 0.4 else rng.choice("abcdefgh") + rng.choice("ijk"))
            parts.append(rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", " ? ", " "]))
        text = "".join(parts)
        rows.append((rng.choice(["en", "fr", None, "und", ""]), text.upper() if rng.random() < 0.2 else text))
    return rows + [("en", None), ("en", ""), (None, None)] + [("de", "one same text. the quick fox")] * 150


@pytest.mark.parametrize(("shards", "min_count", "top"), [(1, 5, 2000), (4, 5, 2000), (3, 20, 7), (7, 2, 50)])
def test_all_numbers(spark, monkeypatch, shards, min_count, top):
    monkeypatch.setattr(collocations, "CELLS_PER_DOCUMENT", 1)
    rows = corpus(shards)
    docs = spark.createDataFrame([(*r, "p", 3, "s") for r in rows], "lang string, text string, phrase string, n int, _shard string").repartition(5)
    out = collocations.collocations(docs, top=top, min_count=min_count, shards=shards)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, out.collect())) == plain(rows, min_count, top)


def test_a_full_table_of_stops_changes_nothing(spark, monkeypatch):
    """Cells shared by all phrases activate too early and too much; counts stay exact."""
    monkeypatch.setattr(collocations, "MOST_CELLS", 1 << 8)
    rows = corpus(9)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, collocations.collocations(docs, min_count=6).collect())) == plain(rows, 6, 2000)


def test_phrases_that_share_a_hash_are_counted_by_text(spark, monkeypatch):
    """With hashes of a few bits nearly all phrases share them."""
    mix = collocations.words.mix
    kept = np.uint64(0x3FF) << np.uint64(8)

    class Narrow(collocations._Text):
        def __init__(self, *args):
            super().__init__(*args)
            self.first = self.first & kept

        def longer(self, hashes, at, k):
            return super().longer(hashes, at, k) & kept

    monkeypatch.setattr(collocations, "_Text", Narrow)
    rows = corpus(4)[:120]
    # the class is sent to the workers with the closures only if it belongs to none of their modules
    Narrow.__module__ = "__main__"
    monkeypatch.setattr(collocations, "_occurrences", _moved(collocations._occurrences, Narrow))
    monkeypatch.setattr(collocations, "_names", _moved(collocations._names, Narrow))
    monkeypatch.setattr(collocations, "_recount", _moved(collocations._recount, Narrow))
    assert mix is collocations.words.mix
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, collocations.collocations(docs, min_count=3).collect())) == plain(rows, 3, 2000)


def _moved(factory, text):
    def make(*args):
        scan = factory(*args)

        def run(batches):
            import shortlist.llm.collocations as module

            before, module._Text = module._Text, text
            try:
                yield from scan(batches)
            finally:
                module._Text = before

        return run

    return make


def test_one_long_text_and_no_text(spark):
    rows = [("en", "to be or not to be, " * 5000), ("en", "be or " * 3)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == plain(rows, 30, 2000)
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).count() == 0


def test_large_numbers_stay_exact(spark, monkeypatch):
    big = 4_000_000_000_000_000_000
    rows = [("en", 0, "", big), ("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 7)]
    counts = spark.createDataFrame(rows, "lang string, words int, phrase string, f long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *_: counts)
    row = collocations.collocations(counts).first()
    assert row.score == 2_000_000 * (big - 7) // (2 * big - 1) and (row.l, row.r) == (big, big - 1)


def test_limits():
    with pytest.raises(ValueError):
        collocations.frequent_phrases(None, max_words=5)
    with pytest.raises(ValueError):
        collocations.frequent_phrases(None, shards=40)


def test_sums_hold_little_beside_their_input():
    rng = np.random.default_rng(5)
    n = 600_000
    parts = [(rng.integers(0, 400_000, n // 4).astype(np.uint64), rng.integers(0, 1 << 40, n // 4).astype(np.uint64), np.arange(n // 4) + i) for i in range(4)]
    keys, two, homes = (np.concatenate(c) for c in zip(*parts))
    tracemalloc.start()
    batches = list(collocations._summed(parts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # the old way joined and ordered all three columns side by side, some 60 bytes a phrase
    assert peak < 45 * n and not parts and max(b.num_rows for b in batches) <= collocations.BATCH
    got = pa.Table.from_batches(batches).to_pandas().set_index("key")
    want = pd.DataFrame({"key": keys.view(np.int64), "two": two, "home": homes}).groupby("key").agg(n=("two", "size"), two=("two", "sum"), home=("home", "min"))
    assert (got["n"] == want["n"]).all() and (got["home"] == want["home"]).all()
    assert (got["check"].to_numpy() == (want["two"].to_numpy().astype(np.uint64) & collocations.CHECK).view(np.int64)).all()
