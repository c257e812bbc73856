"""Repeated sentence runs against a plain scan."""

import random
import re

import numpy as np
import pytest

from shortlist.llm import span_dedup, words

RUN, MIN_WORDS = 2, 9
WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
WS = " \t\n\v\f\r"


def ends_piece(word):
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(words.word_hashes(raw, np.array([0]), np.array([len(raw)]))[0]) % span_dedup.LONG_CUT == 0


def cut_at(text, cuts):
    edges = sorted({0, len(text), *cuts})
    return [text[a:b] for a, b in zip(edges, edges[1:])]


def sentences(text):
    parts = cut_at(text, {i for i, c in enumerate(text) if i and (c == "\n" or text[i - 1] in ".!?" and c in WS)})
    for ends in (lambda t: {i for i, c in enumerate(t) if i and t[i - 1] in ",;:" and c in WS}, lambda t: {m.end() for m in WORD.finditer(t) if ends_piece(m[0])}):
        parts = [x for t in parts for x in (cut_at(t, ends(t)) if len(WORD.findall(t)) > span_dedup.LONG else [t])]
    out = []
    for part in parts:
        if out and (not WORD.search(part) or not WORD.search(out[-1])):
            out[-1] += part
        else:
            out.append(part)
    return [x for x in out if WORD.search(x)] if WORD.search(text) else []


def key(sentence):
    return tuple("".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(sentence))


def runs(keys):
    """The shortest runs that count, from and up to every sentence."""
    enough = lambda a, b: b - a >= RUN and sum(map(len, keys[a:b])) >= MIN_WORDS
    n, out = len(keys), set()
    for i in range(n):
        out |= {(i, b) for b in range(i + 1, n + 1) if enough(i, b) and not enough(i, b - 1)}
        out |= {(a, i + 1) for a in range(i + 1) if enough(a, i + 1) and not enough(a + 1, i + 1)}
    return out


def brute(rows):
    found, gone = {}, {}
    for i, t in {(i, t or "") for i, t in rows}:
        keys = [key(s) for s in sentences(t)]
        for a, b in runs(keys):
            found.setdefault(tuple(keys[a:b]), set()).add(((i is not None, i or 0), t, a, b))
    for places in found.values():
        for (has, i), t, a, b in sorted(places)[1:]:
            gone.setdefault((i if has else None, t), set()).update(range(a, b))
    out = []
    for i, t in rows:
        parts, drop = sentences(t or ""), gone.get((i, t or ""), set())
        kept = t if not drop else "".join(s for n, s in enumerate(parts) if n not in drop)
        out.append((i, kept, len(parts), len(drop)))
    return sorted(out, key=str)


def table(df):
    return sorted(((r.doc_id, r.text, r.n_sentences, r.n_removed) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [6, 7])
def test_against_scan(docs, seed):
    rng = random.Random(seed)
    vocabulary = ["été", "dog", "The", "runs", "b2", "x", "cat", "sees", "over", "one", "lake", "tree"]
    pool = [" ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ";"]) for _ in range(rng.choice([1, 3, 6, 20, 45]))) for _ in range(7)]
    rows = []
    for i in range(80):
        rows.append((i, "".join(rng.choice(pool) + rng.choice([". ", "! ", "\n", ".\n", "?", " ", ": "]) for _ in range(rng.randrange(0, 9)))))
    got = span_dedup.drop_repeated_passages(docs(rows), RUN, MIN_WORDS)
    assert table(got) == brute(rows)
    assert sum(r[3] for r in table(got)) > 20


def test_edge_rows(docs):
    passage = "One two three, four. Five six seven eight! Nine ten."
    rows = [(3, passage), (1, "Intro here. " + passage.upper() + " More."), (2, None), (4, ""), (5, "\n\n . "), (6, passage), (6, passage),
            (None, passage), (7, passage + " " + passage), (8, "\n " + passage), (9, "word " * 50_000 + ". " + passage)]
    frame = docs(rows)
    got = span_dedup.drop_repeated_passages(frame, RUN, MIN_WORDS)
    short = [(i, t) for i, t in rows if i != 9]  # the scan is too slow for the long text, which has its own words
    assert [r for r in table(got) if r[0] != 9] == brute(short)
    assert got.columns == [*frame.columns, "n_sentences", "n_removed"]
    assert span_dedup.drop_repeated_passages(docs([]), RUN, MIN_WORDS).count() == 0


def words_of(text):
    return list(key(text))


def test_lists_of_short_lines(docs):
    rng = random.Random(8)
    items = ["\n".join(f"{a}{i} {b}{i}" for i, (a, b) in enumerate(zip(rng.choices("abcd", k=30), rng.choices("efgh", k=30)))) for _ in range(2)]
    rows = [(1, f"One intro\n{items[0]}\nend one"), (2, f"Another begin\n{items[0]}\nsecond end"), (3, f"Third\n{items[1]}")]
    got = {r.doc_id: r.text for r in span_dedup.drop_repeated_passages(docs(rows)).collect()}
    assert got[1] == rows[0][1] and got[3] == rows[2][1] and words_of(got[2]) == ["another", "begin", "second", "end"]


def test_passages_of_one_and_two_sentences(docs):
    one = " ".join(f"word{i}" for i in range(55)) + "."
    two = " ".join(f"left{i}" for i in range(40)) + ". " + " ".join(f"right{i}" for i in range(40)) + "."
    rows = [(1, f"Ann says this. {one} And goes."), (2, f"Bob is here! {one} He stays."), (3, f"First. {two} Last."), (4, f"Start. {two} Stop.")]
    got = {r.doc_id: words_of(r.text) for r in span_dedup.drop_repeated_passages(docs(rows)).collect()}
    assert got == {1: words_of(rows[0][1]), 2: ["bob", "is", "here", "he", "stays"], 3: words_of(rows[2][1]), 4: ["start", "stop"]}


def test_passages_that_begin_and_end_inside_sentences(docs):
    """Random passages of 51 words without any punctuation: the middle of almost all goes."""
    rng = random.Random(3)
    rows = []
    for p in range(60):
        shared = " ".join(f"p{p}w{rng.randrange(10**6)}" for _ in range(51))
        for side in "ab":
            before, after = (" ".join(f"{side}{p}{x}{i}" for i in range(30)) for x in "xy")
            rows.append((2 * p + (side == "b"), f"{before} {shared} {after}."))
    got = {r.doc_id: r for r in span_dedup.drop_repeated_passages(docs(rows)).collect()}
    assert all(got[2 * p].n_removed == 0 for p in range(60))
    assert sum(got[2 * p + 1].n_removed > 0 for p in range(60)) >= 57
    for p in range(60):
        assert {w for w in words_of(rows[2 * p + 1][1]) if w.startswith("b")} <= set(words_of(got[2 * p + 1].text))


def test_short_shared_phrases_stay(docs):
    shared = "One two three. Four five six! Seven eight nine ten eleven twelve."
    inside = " ".join(f"word{i}" for i in range(18))
    rows = [(1, f"Ann said {inside} at home. Then she left."), (2, f"Bob wrote {inside} to me! Nobody read it."), (3, shared), (4, f"Begin it. {shared} End it.")]
    assert all(r.n_removed == 0 for r in span_dedup.drop_repeated_passages(docs(rows)).collect())
