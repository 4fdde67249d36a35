"""Small tables for the tests of this folder."""

from __future__ import annotations

import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")

#: Columns that operators use inside, here as strangers in the input.
CLASH = "'x' AS digest, 1 AS n, 2 AS rep, 'y' AS kept, 3 AS score, 4 AS label_, 5 AS component, 6 AS spans, 7 AS ids, 8 AS shard, 9 AS use"


def docs_of(spark, rows, clash=True):
    """(doc_id, text) rows as a table with columns of clashing names."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return frame.selectExpr("*", "CAST(NULL AS STRING) AS lang", "'s' AS source", "0L AS n_chars", *CLASH.split(", ")) if clash else frame


def texts(spark, n=None):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted((r["doc_id"], r["text"]) for r in rows)
    return rows[:n]


def roots(nodes, links):
    """The smallest node that each node reaches."""
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}
