"""Personal data against the plain patterns and counts."""

import math
import random
import re

from pyspark.sql import functions as F

from shortlist.llm import pii

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    odd = digits[::-1][::2]
    even = digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return [
        lambda: True, lambda: all(int(p) <= 255 for p in found.split(".")),
        lambda: 12 <= len(digits) <= 19 and luhn(digits), lambda: 9 <= len(digits) <= 15,
    ][kind]()


def brute(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if valid(k, m[0]))


def test_patterns():
    rng = random.Random(4)
    bits = ["a@b.c", "@", "x.y", "1.2.3.4", "256.1.1.1", "00001.2.3.255", "4111 1111 1111 1111", "4111-1111-1111-1111", "+", "(", "1",
            "555", " ", "-", ".", "é", "+1 (555) 555-1234", "\n", "_%", "a@b", ".com", "12345678901234567890123"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        assert pii.base_spans(text) == brute(text), repr(text)


def test_long_runs_take_linear_time():
    assert pii.base_spans("a" * 300_000) == [] and pii.base_spans("1" * 300_000) == [] and pii.base_spans("@" * 100_000) == []


def test_edge_rows(docs):
    rows = [(1, None), (2, ""), (3, "é a@b.cd"), (3, "é a@b.cd"), (None, "+1 234 567 890"), (4, "x " * 100_000 + "1.2.3.4")]
    got = sorted(((r.doc_id, r.base) for r in pii.personal_data(docs(rows)).select("doc_id", pii.spans_text("base").alias("base")).collect()), key=str)
    assert got == sorted(
        [(1, ""), (2, ""), (3, "email:2:8"), (3, "email:2:8"), (None, "phone:0:14"), (4, "ip:200000:200007")], key=str)
    assert pii.personal_data(docs([])).count() == 0


def test_disclosure_counts(docs):
    rows = [(i, f"call Smithson at j{i % 3}@x.org now") for i in range(9)] + [(20 + i, "call now please at home") for i in range(40)]
    rows += [(70, "unrelated Smithson")]
    frame = docs(rows)
    found = pii._texts(frame).mapInArrow(pii._find, pii._FOUND)
    got = {(r.entity, r.term): r.disclosure for r in pii.disclosures(frame, found, 2, 0.0).collect()}
    n = len(rows)
    for person in range(3):
        for word, docs_with in (("smithson", 10), ("call", 49), ("now", 49), ("at", 49)):
            want = math.log(3 * n / (docs_with * 3)) / math.log(n / 3)
            key = (f"email:j{person}@x.org", pii._hashes([word])[0])
            assert abs(got[key] - want) < 1e-9
    clean = {r.doc_id: r.text for r in pii.sanitise(frame, 2, 0.5).collect()}
    assert clean[0] == "call  at <EMAIL> now" and clean[70] == "unrelated Smithson" and clean[20] == rows[9][1]


def test_sanitise_keeps_columns(docs):
    frame = docs([(1, "a@b.cd 1.2.3.4"), (2, None)])
    out = pii.sanitise(frame)
    assert out.columns == frame.columns
    assert {r.doc_id: r.text for r in out.select("doc_id", "text").orderBy(F.col("doc_id")).collect()} == {1: "<EMAIL> <IP>", 2: None}


def test_entity_that_mostly_stands_alone(docs):
    rows = [(i, "info@x.org") for i in range(18)] + [(18 + i, "ask Smithson info@x.org") for i in range(2)]
    rows += [(20 + i, "Smithson again") for i in range(2)] + [(22 + i, "ask again") for i in range(78)]
    frame = docs(rows)
    found = pii._texts(frame).mapInArrow(pii._find, pii._FOUND)
    got = {(r.entity, r.term): r.disclosure for r in pii.disclosures(frame, found, 2, 0.0).collect()}
    want = math.log(2 * 100 / (4 * 20)) / math.log(100 / 20)
    assert abs(got["email:info@x.org", pii._hashes(["smithson"])[0]] - want) < 1e-9 and want < pii.DISCLOSURE
    assert {r.doc_id: r.text for r in pii.sanitise(frame).collect()}[18] == "ask Smithson <EMAIL>"
