import json
import os

import pytest
from tests.oracle import SMALL, rows

from peakloom.llm import leakage, notebook
from peakloom.llm.queries import QUERIES, SQL

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    mine, other = rows(QUERIES[name], SQL[name], spark)
    assert mine and mine == other


def test_containers_hold_what_was_packed(spark):
    packed = QUERIES["p6_packed"](spark, SMALL).cache()
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert packed.select("doc_id").distinct().count() == documents.count() and packed.agg({"tokens": "max"}).first()[0] <= 4096
    used = QUERIES["p6_containers"](spark, SMALL).collect()
    least = -(-packed.agg({"tokens": "sum"}).first()[0] // 4096)
    assert least <= len(used) <= least * 1.05 + 1 and sum(r.pieces for r in used) == packed.count()


def test_passages_are_where_they_are_said_to_be(spark):
    items = {r.item_id: leakage.words(r.text) for r in spark.read.parquet(f"{SMALL}/eval_items.parquet").collect()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "layout").collect()}
    spans = QUERIES["p7_spans"](spark, SMALL).collect()
    assert spans and {(r.item_id, r.doc_id) for r in spans} == {tuple(r) for r in QUERIES["p7_found"](spark, SMALL).select("item_id", "doc_id").collect()}
    for r in spans:
        cell = notebook.cells(docs[r.doc_id].text, docs[r.doc_id].layout)[r.cell]
        own, item = leakage.words(cell[r.first_char : r.end_char]), items[r.item_id]
        assert len(own) == r.end_word - r.first_word >= 12 and all(any(item[k : k + 12] == own[j : j + 12] for k in range(len(item))) for j in range(len(own) - 11))
    left = QUERIES["p7_removed"](spark, SMALL).collect()
    assert {r.doc_id for r in left} == {r.doc_id for r in spans}
    for r in left:
        assert 0 < r.removed == len(docs[r.doc_id].text) - len(r.text)
        texts = [leakage.words(c) for c in notebook.cells(r.text, docs[r.doc_id].layout)]
        for s in spans:
            if s.doc_id == r.doc_id:
                item = items[s.item_id]
                grams = {tuple(item[k : k + 12]) for k in range(len(item) - 11)}
                assert not any(tuple(ws[j : j + 12]) in grams for ws in texts for j in range(len(ws) - 11))


def test_restored_texts_differ_only_inside_spans(spark):
    folder = next((f for f in ("/root/testdata/sf0.01", SMALL) if os.path.isdir(f)), SMALL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    spans = {}
    for r in QUERIES["p8_spans"](spark, folder).collect():
        spans.setdefault(r.doc_id, []).append((r.first_char, r.end_char, r.original))
    restored = QUERIES["p8_restored"](spark, folder).collect()
    assert {r.doc_id for r in restored} == set(spans) == {r.doc_id for r in QUERIES["p8_found"](spark, folder).collect()}
    for r in restored:
        old, new, at, there = texts[r.doc_id], r.text, 0, 0
        for first, end, original in sorted(spans[r.doc_id]):
            kept = old[at:first]
            assert new[there : there + len(kept)] == kept
            there += len(kept)
            if original is None:
                there += end - first
            else:
                forms = {original, json.dumps(original)[1:-1], json.dumps(original, ensure_ascii=False)[1:-1]}
                form = max((f for f in forms if new.startswith(f, there)), key=len)
                there += len(form)
            at = end
        assert new[there:] == old[at:]
