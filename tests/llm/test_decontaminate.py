"""Test passages against a plain scan."""

import hashlib
import random
import re

from shortlist.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(rows, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own:
                    hit |= set(range(i, i + n))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, rows, items, **kw):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, decontaminate.contamination(docs(rows), bench, **kw).collect()), key=str)


def corpus(seed=2):
    rng = random.Random(seed)
    vocabulary = ["été", "Σας", "ΣΑΣ", "İx", "a1", "The", "THE", "dog", "2b", "über"]
    text = lambda n: rng.choice([" ", ", ", "-", "_"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([2, 5, 12, 14]))) for i in range(8)] + [(8, items_text) for items_text in ["dog"]]
    rows = []
    for i in range(60):
        part = rng.choice(items)[1] if rng.random() < 0.5 else ""
        rows.append((i, f"{text(rng.randrange(0, 40))}; {part.swapcase() if part.isascii() else part} {text(3)}"))
    return rows, items


def test_against_scan(spark, docs):
    rows, items = corpus()
    assert run(spark, docs, rows, items) == brute(rows, items)
    assert run(spark, docs, rows, items[:4], window=4) == brute(rows, items[:4], 4)


def test_edge_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, "?!"), (None, "x y"), (4, "x y"), (4, "x y"), (5, "z " * 50_000 + "x y"), (6, "X\ny")]
    items = [(1, "x y"), (1, "x y"), (None, "x y"), (2, None), (3, ""), (4, "--")]
    assert run(spark, docs, rows, items) == brute(rows, items)
    assert run(spark, docs, rows, []) == brute(rows, [])
    assert run(spark, docs, [], items) == []


def test_a_shuffled_window_table_gives_the_same(spark, docs, monkeypatch):
    rows, items = corpus(3)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert run(spark, docs, rows, items) == brute(rows, items)


def test_removal(spark, docs):
    items = spark.createDataFrame([(1, "one two three"), (2, "three four")], "item_id long, text string")
    rows = [(1, "Zero, ONE two  three; four! five."), (2, "nothing here."), (3, None), (4, "one two three")]
    cut = decontaminate.remove_spans(docs(rows), items)
    assert cut.columns == docs([]).columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "Zero! five.", 2: "nothing here.", 3: None, 4: ""}
    left = decontaminate.remove_documents(docs(rows), items)
    assert left.columns == docs([]).columns and sorted(r.doc_id for r in left.collect()) == [2, 3]
