"""Repeated lines against a plain count."""

import random

import numpy as np

from shortlist.llm import bloom, line_dedup

WS = " \t\n\v\f\r"


def brute(rows, min_chars, min_docs):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(WS))

    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            held.setdefault(key(line), set()).add(i)
    last = {k: max(d, key=lambda x: -1 if x is None else x) for k, d in held.items() if len(k) >= min_chars and len(d) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if last.get(key(x), i) == i]
        out.append((i, t if kept == lines else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def table(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=str)


def corpus():
    rng = random.Random(1)
    pool = [f"{'Ä' if i % 3 else ' '} line number {i} " + "x" * (i % 30) for i in range(60)]
    return [(i, "\n".join(rng.choice([x, x.upper(), "  " + x + "\r"]) for x in rng.choices(pool, k=rng.randrange(0, 12)))) for i in range(200)]


def test_against_count(docs):
    rows = corpus()
    got = line_dedup.drop_repeated_lines(docs(rows), min_chars=25, min_docs=5)
    assert table(got) == brute(rows, 25, 5)
    assert got.columns == ["doc_id", "text", "lang", "component_id", "_key", "ids", "_rest", "n_lines", "n_dropped"]


def test_edge_rows(docs):
    long = "very long line " * 20_000
    rows = [(1, long), (2, long.upper()), (3, None), (4, ""), (5, "\n\n"), (6, "same line\nsame line"), (7, "same line"),
            (None, "same line"), (None, "same line"), (6, "same line\nsame line"), (8, "été été\n x"), (9, "ÉTÉ été")]
    assert table(line_dedup.drop_repeated_lines(docs(rows), 3, 2)) == brute(rows, 3, 2)
    assert line_dedup.drop_repeated_lines(docs([]), 3, 2).count() == 0


def test_a_full_filter_changes_nothing(docs):
    """With far too few bits nearly every line is suspected; the result is the same."""
    rows = corpus()
    assert table(line_dedup.drop_repeated_lines(docs(rows), 25, 5, bits=1 << 16)) == brute(rows, 25, 5)


def test_filters_merge():
    """What two tasks saw once each is in the merged second filter."""
    import pyarrow as pa

    bits = 1 << 16
    build = line_dedup._filters(bits, 1)
    parts = [b for text in ("common\nleft", "common\nright") for b in build(iter([pa.record_batch([pa.array([text])], names=["text"])]))]
    parts.sort(key=lambda b: b.column("piece")[0].as_py())
    merged = list(bloom.merge(iter(parts)))
    twice = np.frombuffer(b"".join(b.column("twice")[0].as_py() for b in merged), np.uint8)
    digests = b"".join(d for _, d in line_dedup.line_keys(b"common\nleft\nright", 1))
    assert bloom.has(twice, bloom.places(digests, bits)).tolist() == [True, False, False]
