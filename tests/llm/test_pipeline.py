"""Each stage of the pipeline against plain Python on what the stage before it kept."""

import importlib.util
import os
import sys

import pytest

import corpus_pipeline
from shortlist.llm import quality
from shortlist.llm.queries import PIECE_MODEL
from shortlist.llm.sentencepiece_codec import Codec
from shortlist.session import durable

SF = "/root/testdata/sf0.001"


def plain(name):
    """The plain versions of the operators' own tests."""
    spec = importlib.util.spec_from_file_location(f"plain_{name}", os.path.join(os.path.dirname(__file__), f"test_{name}.py"))
    module = importlib.util.module_from_spec(spec)
    sys.modules[spec.name] = module
    spec.loader.exec_module(module)
    return module


@pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="no model file")
def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(durable(stage(spark, tables[-1], SF)))
    assert all(t.columns == docs.columns for t in tables[:5])
    rows = [sorted((r.doc_id, r.text) for r in t.collect()) for t in tables[:5]]

    good = {r.doc_id for r in quality.predictions(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.predicted}
    assert rows[1] == [r for r in rows[0] if r[0] in good] and len(rows[1]) < len(rows[0])

    assert rows[2] == sorted((i, t) for i, t, _, _ in plain("line_dedup").brute(rows[1], 40, 5))
    assert all(r.n_chars == len(r.text) for r in tables[2].collect())

    near = plain("near_dup").brute(rows[2], corpus_pipeline.NEAR)
    first = {i for i, _, _, kept in near if kept}
    assert rows[3] == [r for r in rows[2] if r[0] in first] and len(rows[3]) < len(rows[2])

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in plain("decontaminate").brute(rows[3], items) if not r[5]}
    assert rows[4] == [r for r in rows[3] if r[0] in clean] and len(rows[4]) < len(rows[3])

    codec = Codec.load(PIECE_MODEL)
    got = {r.doc_id: (r.n_ids, r.ids, r.round_trip) for r in tables[5].collect()}
    want = {i: codec.encode(t) for i, t in rows[4]}
    assert got == {i: (len(ids), ids, True) for i, ids in want.items()}
    assert sorted(corpus_pipeline.run(spark, SF).select("doc_id").collect()) == sorted((i,) for i in want)


def test_stages_with_odd_rows_and_columns(spark, docs):
    """Nulls, empty and repeated texts, an empty table, no n_chars, and columns named as the operators' own."""
    rows = [(1, None), (2, ""), (None, "a text without an id"), (3, "one line\n" * 3), (3, "one line\n" * 3), (None, None), (4, "x")]
    for name, stage in corpus_pipeline.STAGES[1:4]:
        table = docs(rows)
        out = stage(spark, table, SF)
        assert out.columns == table.columns and out.dtypes == table.dtypes, name
        kept = out.collect()
        assert {(r.n_lines, r.component_id, r["_key"], r.ids, r["_rest"]) for r in kept} == {(7, "c", 1, "x", 0.5)}, name
        assert len(kept) == len(rows), name
        empty = stage(spark, docs([]), SF)
        assert empty.columns == table.columns and empty.count() == 0, name
    _, last = corpus_pipeline.STAGES[4]
    assert sorted((r.doc_id or 0, r.n_ids, r.round_trip) for r in last(spark, docs(rows), SF).collect())[0][2] and last(spark, docs([]), SF).count() == 0
