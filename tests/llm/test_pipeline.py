"""The pipeline against brute force, stage by stage, and the registered queries against their SQL."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer as Reference

import __spark_entry__ as entry_point
import corpus_pipeline
from tarifa.llm import toxicity
from tarifa.llm.common import table
from tarifa.llm.oracle import oracle
from tests.compare import connect, difference
from tests.llm import test_contamination, test_near_dup, test_secrets
from tests.llm.tables import SF_DIR, needs_tables

pytestmark = needs_tables


@pytest.mark.parametrize("name", sorted(oracle()))
def test_query_equals_sql(spark, name):
    assert difference(entry_point.queries()[name](spark, SF_DIR), connect(SF_DIR), oracle()[name]) is None


def test_all_operators_are_registered():
    names = {n.split("_")[0] for n in entry_point.queries()}
    assert {f"op{i}" for i in range(1, 11)} | {"pipeline"} <= names


def test_run_equals_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    model = toxicity.learn(docs, table(spark, SF_DIR, "labels"), "doc_id", "text", "toxic")
    rows = [r for r in rows if model.score(r[1]) < 0.3]
    groups = test_near_dup.brute(rows, 5)
    rows = [r for r in rows if groups[r[0]][2]]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    hit = {doc for doc, _, n, _ in test_contamination.brute(rows, items, 10) if n}
    rows = [r for r in rows if r[0] not in hit]
    assert 0 < len(rows) < docs.count() and hit

    reference = Reference.from_file(public_tokenizers.path("word_bpe_49k.json"))
    reference.no_truncation()
    reference.no_padding()
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert set(found) == {r[0] for r in rows}
    for doc, text in rows:
        for start, _, end in reversed(test_secrets.brute(text)):
            assert start < end
        clean = test_secrets.secrets.all_spans(text) == []
        if clean:
            ids = reference.encode(text, add_special_tokens=False).ids
            assert found[doc]["ids"] == ids
            assert found[doc]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_stages_keep_the_columns_and_rows_without_id(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "token=abcdefghijklmnop", None, None, None), (None, None, None, None, 3), (1, "", "en", "s", 0), (2, "a b c d e f", "en", "s", 11), (3, "a b c d e f", "en", "s", 11)]
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "'x' AS kept", "1 AS score", "2 AS spans")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == corpus_pipeline.COLUMNS, name
    left = sorted(docs.collect(), key=str)
    assert [r["doc_id"] for r in left].count(None) == 2 and {r["doc_id"] for r in left} == {None, 1, 2}
    assert {r["text"] for r in left if r["doc_id"] is None} == {"[assign removed]", None}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_a_row_with_another_text_does_not_go_with_a_copy(spark):
    same, other = "a b c d e f g", "quite another text of six words"
    rows = [(1, same, "en", "s", 1), (2, same, "en", "s", 1), (2, other, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == [(1, same), (2, other)]
