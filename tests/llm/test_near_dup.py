"""Near duplicates against all pairs."""

import random

import pytest

from shortlist.llm import near_dup
from shortlist.llm.components import components


def shingles(text, size):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    words = [w for w in words if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, rule):
    sets = [(i, shingles(t, rule.shingle)) for i, t in rows]
    comp = {}
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and None not in (sets[a][0], sets[b][0]) and 100 * len(x & y) >= rule.percent * len(x | y):
                parent[find(a)] = find(b)
    for a in range(len(sets)):
        own = [sets[b][0] for b in range(len(sets)) if find(b) == find(a)]
        comp[a] = min(own) if None not in own else None
    return sorted(
        ((i, len(s), comp[a], i is None or comp[a] == i) for a, (i, s) in enumerate(sets)), key=str)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 200))]
        for _ in range(rng.randrange(1, 14)):
            # around the limit, so that variants are linked through others or not at all
            rows.append((i, edited(rng, base, rng.randrange(0, max(2, len(base) // 25)))))
            i += 1
    rng.shuffle(rows)
    return [(k, t) for k, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("rule", [near_dup.Rule(3, 85), near_dup.Rule(5, 80)])
def test_components_equal_all_pairs(docs, rule):
    rows = corpus(rule.percent)
    got = sorted(map(tuple, near_dup.near_duplicates(docs(rows), rule).collect()), key=str)
    assert got == brute(rows, rule)
    assert 3 < sum(r[3] for r in got) < len(rows)


def test_edge_rows(docs):
    rows = [
        (5, "one two three four"), (3, "ONE  two\tthree\nfour"), (9, "one two"), (8, "one two"), (2, None), (1, ""), (4, " \n "),
        (7, "a"), (6, "a"), (None, "a"), (10, "a" * 300_000 + " b c"), (11, "a" * 300_000 + " b c"), (5, "one two three four"),
    ]
    rule = near_dup.Rule(3, 85)
    got = sorted(map(tuple, near_dup.near_duplicates(docs(rows), rule).collect()), key=str)
    assert got == brute(rows, rule)
    kept = near_dup.keep_one_of_each(docs(rows), rule)
    assert kept.columns == docs([]).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "10", "2", "3", "4", "6", "8", "None"]


def test_empty_table(docs):
    assert near_dup.near_duplicates(docs([])).count() == 0


def test_a_group_whose_head_is_a_variant(docs):
    """Variants are linked with the base alone, which is not the smallest id."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, edited(rng, base, 4)) for i in range(40)] + [(40, " ".join(base))]
    rule = near_dup.Rule(3, 80)
    got = sorted(map(tuple, near_dup.near_duplicates(docs(rows), rule).collect()), key=str)
    assert got == brute(rows, rule)


def test_rule_sizes():
    rule = near_dup.Rule(3, 85)
    apart = 1 - 0.85**6 - 6 * 0.85**5 * 0.15
    assert apart**rule.chunks <= rule.miss < apart ** (rule.chunks - 1)
    assert rule.radius > rule.chunks * 2 - 1


def test_long_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(500, 501)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 500: 500, 501: 500}


def test_one_id_with_different_texts(docs):
    """Rows of one doc_id belong to the components of their own texts; no link of either is lost."""
    one, two = (" ".join(f"{a}{i}" for i in range(60)) for a in "xy")
    rows = [(1, one), (1, two), (2, two + " more"), (3, one), (4, " ".join(f"z{i}" for i in range(60))), (2, "z0 z1"), (5, two + " less")]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(docs(rows), near_dup.Rule(3, 85)).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (2, 2, True), (3, 1, False), (4, 4, True), (5, 1, False)]
