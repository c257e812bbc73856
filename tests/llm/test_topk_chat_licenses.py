"""Top-k search, dialogue perspectives and licence rules against plain Python."""

import math
import random

import numpy as np

from shortlist.llm import block_topk, chat, licenses


def brute_topk(rows, k, every):
    vectors = sorted({
        (i, tuple(math.floor(64 * float(np.float32(x))) for x in v)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, q in vectors:
        if i % every == 0:
            scored = sorted({(-sum(a * b for a, b in zip(q, v)), j) for j, v in vectors if j != i and len(v) == len(q)})[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


def run_topk(spark, rows, k, every):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = block_topk.quantised(frame)
    return sorted(map(tuple, block_topk.top_products(v, v.where(f"vec_id % {every} = 0"), k).collect()))


def test_topk(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 8).round(1).tolist()) for i in range(300)] + [(300 + i, [0.5] * 8) for i in range(60)]
    rows += [(7, rows[7][1]), (500, None), (501, [1.0, None] * 4), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (None, [1.0] * 8), (504, [])]
    monkeypatch.setattr(block_topk, "SHARD_BLOCKS", 1)
    assert run_topk(spark, rows, 20, 20) == brute_topk(rows, 20, 20)
    assert run_topk(spark, rows[:5], 20, 2) == brute_topk(rows[:5], 20, 2)
    assert run_topk(spark, [], 20, 20) == []


def test_large_components(spark, monkeypatch):
    """Whole numbers beyond 32 bits, products beyond 64 bits, and components that have no 64-bit number."""
    monkeypatch.setattr(block_topk, "BLOCK", 2)
    least, most = -(2**63) + 1, 2**63 - 1
    floats = [1e9, -1e9, 2.0**40, -(2.0**40), 1.0, -3.25, 1e300, -1e300, 0.0]
    rng = np.random.default_rng(9)
    rows = [(i, [floats[j] for j in rng.integers(0, 6 if i < 30 else 9, 3)]) for i in range(45)]
    whole = {i: tuple(min(max(math.floor(64 * x), -(2**63)), most) for x in v) for i, v in rows}
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = block_topk.quantised(frame)
    assert {r.vec_id: tuple(r.vector) for r in v.collect()} == whole
    got = sorted(map(tuple, block_topk.top_products(v, v.where("vec_id % 5 = 0"), 6).collect()))
    want = []
    for i in range(0, 45, 5):
        scored = sorted((-min(max(sum(a * b for a, b in zip(whole[i], w)), least), most), j) for j, w in whole.items() if j != i)[:6]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    assert got == sorted(want)


def test_blocks_are_skipped_without_loss(monkeypatch):
    monkeypatch.setattr(block_topk, "BLOCK", 16)
    rng = np.random.default_rng(4)
    centers = rng.integers(-100, 100, (20, 6))
    vectors = np.concatenate([c + rng.integers(-3, 4, (40, 6)) for c in centers])
    ids = np.arange(len(vectors))
    q, v, s = block_topk.search_shard(ids, vectors, ids[:50], vectors[:50], 5)
    for i in range(50):
        scores = vectors @ vectors[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:5]
        assert v[q == i].tolist() == order and s[q == i].tolist() == scores[order].tolist()


def test_perspectives(spark):
    rows = [(1, 0, "ann", "hi é"), (1, 1, "bob b", "yo"), (1, 2, "ann", "bye"), (2, 0, "ann", None), (2, 0, None, "x"), (3, 0, "z", "q"),
            (1, 1, "bob b", "yo"), (None, 0, "n", "n"), (2, None, "ann", "early")]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, part int")
    got = {(r.conv_id, r.speaker, r.part): r for r in chat.perspectives(frame, part_turns=2).collect()}
    assert set(got) == {(1, "ann", 0), (1, "ann", 1), (1, "bob b", 0), (1, "bob b", 1), (2, "ann", 0), (2, "ann", 1), (2, "", 0), (2, "", 1), (3, "z", 0)}
    bob = got[1, "bob b", 0]
    assert bob.text == "<|im_start|>user name=ann\nhi é<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert [bob.text[m.start : m.end] for m in bob.masks] == ["yo<|im_end|>\n"] and (bob.n_turns, bob.n_own) == (2, 1)
    assert got[1, "bob b", 1].masks == [] and got[2, "ann", 0].text.startswith("<|im_start|>assistant\nearly")
    assert chat.perspectives(frame.where("false")).count() == 0


def test_one_dialogue_with_most_rows(spark):
    rng = random.Random(2)
    rows = [(1, i, rng.choice("abc"), f"t{i}") for i in range(3000)] + [(i, 0, "a", "x") for i in range(2, 50)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = [r for r in chat.perspectives(frame).where("conv_id = 1 and speaker = 'b'").orderBy("part").collect()]
    assert [r.part for r in parts] == list(range(47)) and max(r.n_turns for r in parts) == 64
    assert sum(r.n_turns for r in parts) == 3000 and sum(r.n_own for r in parts) == sum(r[2] == "b" for r in rows if r[0] == 1)


def test_licenses(docs):
    s = licenses.SENTENCES
    apache = "\n".join(s[k] for k in ("apache-2-header", "apache-2-comply", "apache-2-copy"))
    bsd = " ".join(s[k] for k in ("bsd-redistribute", "bsd-source", "bsd-binary"))
    rows = [
        (1, f"Intro.\n{s['mit-released']}\nMore {s['mit-released']}"), (2, apache.upper()), (3, bsd), (4, f"{bsd} {s['bsd-endorse']}"),
        (5, s["apache-2-comply"]), (6, None), (7, ""), (8, "x " * 100_000 + ".\n" + s["cc-by-4"]), (None, s["gpl-3-work"]),
        (9, f"{s['mit-grant']} {s['mit-keep']} {s['reserved']}"), (1, f"Intro.\n{s['mit-released']}\nMore {s['mit-released']}"),
    ]
    got = sorted(((r.doc_id, r.licenses, r.n_sentences) for r in licenses.license_scan(docs(rows)).collect()), key=str)
    assert got == sorted([
        (1, "MIT", 1), (2, "Apache-2.0", 3), (3, "BSD-2-Clause", 3), (4, "BSD-3-Clause", 4), (5, "", 1), (6, "", 0), (7, "", 0),
        (8, "CC-BY-4.0", 1), (None, "GPL-3.0-only", 1), (9, "MIT,Proprietary", 3), (1, "MIT", 1)], key=str)
    assert licenses.license_scan(docs([])).count() == 0


MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""
MPL = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. {}. If a copy of the MPL was not distributed, ..."
APACHE = """Licensed under the Apache License, Version 2.0
(the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""


def commented(text, mark, begin="", end=""):
    return begin + "".join(f"{mark}{line}".rstrip() + "\n" for line in text.split("\n")) + end + "code();\n"


def test_wrapped_licenses(docs):
    s = licenses.SENTENCES
    cc0 = s["cc0-1"].replace("law, ", "law,\r\n").replace("related ", "related\r\n")
    rows = [
        (1, MIT), (2, commented(MIT, "# ")), (3, commented(MIT, " * ", "/*\n", " */\n")), (4, BSD), (5, commented(BSD, "// ")), (6, GPL),
        (7, commented(GPL, ";; ")), (8, MPL.format("2.0")), (9, MPL.format("1.1")), (10, cc0), (11, MIT.replace("\n", "\r\n")),
        (12, "Heading\n" + s["mit-released"]), (13, "Released under the\n\nMIT License."), (14, "Released under. the MIT License."),
        (15, APACHE), (16, commented(APACHE, "REM ")), (17, "never Released under\nthe MIT License."), (18, "Released under\nthe MIT License"),
        (19, BSD + "\n3. " + s["bsd-endorse"].replace("may be", "may\n  be")), (20, "Released under\nthe MIT License only."),
    ]
    got = {r.doc_id: (r.licenses, r.n_sentences) for r in licenses.license_scan(docs(rows)).collect()}
    gpl, bsd, apache = ("GPL-3.0-or-later", 2), ("BSD-2-Clause", 3), ("Apache-2.0", 3)
    assert got == {
        1: ("MIT", 2), 2: ("MIT", 2), 3: ("MIT", 2), 4: bsd, 5: bsd, 6: gpl, 7: gpl, 8: ("MPL-2.0", 1), 9: ("", 0), 10: ("CC0-1.0", 1), 11: ("MIT", 2),
        12: ("MIT", 1), 13: ("", 0), 14: ("", 0), 15: apache, 16: apache, 17: ("", 0), 18: ("MIT", 1), 19: ("BSD-3-Clause", 4), 20: ("", 0)}


def test_license_sql_on_wrapped_texts(spark):
    """The SQL of the query and the scan agree on wrapped, commented, cut and joined notices."""
    import textwrap

    import duckdb

    from shortlist.llm.queries import SQL

    rng = random.Random(12)
    sentences = [*licenses.SENTENCES.values()]
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, sentences[0]), (None, sentences[1])]
    for i in range(10, 160):
        paragraphs = []
        for _ in range(rng.randrange(1, 4)):
            parts = [rng.choice(sentences) if rng.random() < 0.75 else rng.choice(["Some words here.", "Copyright 2020 é", "all rights", "MIT"]) for _ in range(rng.randrange(1, 5))]
            body = rng.choice([" ", "  ", "\n"]).join(parts)
            body = rng.choice([body, body.upper(), body.replace(",", ""), body[: rng.randrange(1, len(body))]])
            mark = rng.choice(["", "# ", " * ", "// ", "rem ", "-- "])
            paragraphs.append("\n".join(mark + x for x in textwrap.wrap(body, rng.choice([30, 72, 500]))))
        rows.append((i, rng.choice(["\n\n", "\n", "\n#\n", " "]).join(paragraphs)))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(con.execute(f"SELECT doc_id, n_sentences, sentence_ids, licenses FROM ({SQL['op3_licenses']})").fetchall(), key=str)
    got = sorted(map(tuple, licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == want and sum(r[1] > 0 for r in got) > 60
