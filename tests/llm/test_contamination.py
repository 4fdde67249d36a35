import re

import pytest

from tarifa.llm import contamination as con
from tests.llm.tables import SF_DIR, docs_of, needs_tables, texts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, items, width):
    windows = {}
    for item, text in items:
        own = words(text)
        size = min(width, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + size]), set()).add(str(item))
    out = []
    for doc, text in rows:
        own, hit, names = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    names |= windows[tuple(own[i : i + size])]
        out.append((doc, len(own), len(hit), sorted(names)))
    return out


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 AS terms", "2 AS item", "3 AS items")


def found(spark, rows, items, width):
    result = con.contamination(docs_of(spark, rows), items_of(spark, items), width=width)
    return [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in result.collect()]


@needs_tables
def test_whole_table_equals_brute_force(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = texts(spark)
    assert sorted(found(spark, rows, items, 10)) == sorted(brute(rows, items, 10))


ROWS = [(1, None), (2, ""), (3, "... !"), (4, "A b-c D e f g"), (5, "x a b c d e y a b c"), (6, "b c d e f b c d e f"), (7, "Éa éa"), (9, "q " * 50_000 + "a b c d")]
ITEMS = [(1, "a b c d e f"), (2, "c d"), (10, None), (11, ""), (12, "a b c d z"), (12, "éa"), (13, "b c d e f")]


@pytest.mark.parametrize("block", [200_000, 2])
def test_edge_cases_in_one_and_in_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(con, "PHRASES", block)
    assert sorted(found(spark, ROWS, ITEMS, 4)) == sorted(brute(ROWS, ITEMS, 4))


def test_terms_that_are_too_many_index_everything(spark, monkeypatch):
    monkeypatch.setattr(con, "PHRASES", 3)
    monkeypatch.setattr(con, "TERMS", 1)
    assert sorted(found(spark, ROWS, ITEMS, 4)) == sorted(brute(ROWS, ITEMS, 4))


def test_missing_ids_repeated_rows_and_empty_tables(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d")]
    assert sorted(x[1:3] for x in found(spark, rows, [(1, "b c"), (None, "a b")], 4)) == [(4, 3)] * 3
    assert [x[3] for x in found(spark, rows, [(1, "b c"), (None, "a b"), (None, "b c")], 4)] == [["1"]] * 3
    assert found(spark, rows, [], 4) == [(d, 4, 0, []) for d in [None, 5, 5]]
    assert con.contamination(docs_of(spark, rows).limit(0), items_of(spark, ITEMS)).count() == 0


def test_proximity(spark):
    rows = [(1, "c x a y b"), (2, "a x x x x b c"), (3, "b a c")]
    result = con.contamination(docs_of(spark, rows), items_of(spark, [(1, "a b c")]), width=3, within=5).collect()
    assert {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in result} == {1: [(0, 5)], 2: [], 3: [(0, 3)]}
