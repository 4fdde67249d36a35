import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarifa.llm import neighbours
from tests.llm.tables import SF_DIR, needs_tables

CLASH = "'x' AS digest, 1 AS length, 2 AS place, 3 AS leaf, 'y' AS blob, 4 AS score, 5 AS rank, 6 AS salt, 7 AS own"


def brute(rows, k=10, step=100):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (query, point) in enumerate(good):
        if query % step == 0:
            near = sorted((math.sqrt(((v - point) ** 2).sum()), i) for n, (i, v) in enumerate(good) if n != at and len(v) == len(point))
            out += [(query, rank + 1, i, d) for rank, (d, i) in enumerate(near[:k])]
    return sorted(out)


def found(spark, rows, k=10, step=100):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", *CLASH.split(", "))
    return sorted(tuple(r) for r in neighbours.neighbours(frame, F.col("vec_id") % step == 0, k).collect())


def recall(got, want):
    assert {q for q, *_ in got} == {q for q, *_ in want} and len(got) == len(want)
    return len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}) / len(want)


def clustered(seed, n, dims=16, clusters=40):
    chance = np.random.default_rng(seed)
    centres = chance.normal(size=(clusters, dims))
    return [(i, (centres[i % clusters] + 0.3 * chance.normal(size=dims)).tolist()) for i in range(n)]


@needs_tables
@pytest.mark.parametrize("sf_dir", [SF_DIR, SF_DIR.replace("sf0.001", "sf0.1")])
def test_recall_on_whole_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got, want = found(spark, rows), brute(rows)
    assert recall(got, want) >= 0.9
    score = {(q, i): d for q, _, i, d in brute(rows, k=len(rows))}
    assert all(d == pytest.approx(score[q, i], rel=1e-12, abs=0) for q, _, i, d in got)


def test_recall_over_many_leaves_and_blocks(spark, monkeypatch):
    for name, value in (("LEAF", 20), ("BLOCK_BYTES", 3000), ("BLOCK_QUERIES", 3), ("SAMPLE", 1500)):
        monkeypatch.setattr(neighbours, name, value)
    rows = clustered(1, 6000)
    got, want = found(spark, rows, step=50), brute(rows, step=50)
    assert recall(got, want) >= 0.9
    ranks = {}
    for query, rank, _, score in got:
        ranks.setdefault(query, []).append((rank, score))
    assert all([r for r, _ in sorted(x)] == list(range(1, 11)) and [s for _, s in sorted(x)] == sorted(s for _, s in x) for x in ranks.values())


def test_copies_ties_and_rows_that_take_no_part(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 2000, 5)]  # one group of copies holds most rows
    rows += [(3, [1.0, 3.0]), (4, [1.0, 1.0]), (300, [1.0, 2.0]), (300, [5.0, 5.0])]  # ties, repeated rows
    rows += [(None, [1.0, 2.0]), (700, None), (800, []), (900, [0.0, 0.0]), (1000, [1.0, None]), (1100, [float("nan"), 1.0]), (1200, [float("inf"), 1.0])]
    rows += [(1300, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 4.0]), (1400, [9.0])]  # other lengths; the last one has no candidate
    rows += [(1500, [-0.0, 2.0]), (8, [0.0, 2.0])]
    assert found(spark, rows) == brute(rows)


def test_few_candidates_and_empty_table(spark):
    rows = [(100 * i, [float(i + 1), 1.0]) for i in range(6)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, rows[:1]) == []


def test_components_out_of_range_of_squares(spark):
    rows = [(0, [1e300, 1.0]), (1, [-1e300, 1.0]), (100, [1e-300, 0.0]), (101, [2e-300, 0.0])]
    got = {(q, i): d for q, _, i, d in found(spark, rows)}
    assert got[0, 1] == pytest.approx(math.inf) or got[0, 1] == pytest.approx(2e300)
    assert got[100, 101] == pytest.approx(1e-300)


def test_walk_gives_every_leaf_once():
    points = np.random.default_rng(3).normal(size=(3000, 8))
    tree = neighbours.Tree(points, 10.0, 5)
    assert len(tree.leaf_of) > 50
    order = list(tree.best_first(points[0]))
    assert sorted(order) == list(range(5, 5 + len(tree.leaf_of)))
    assert set(tree.down(points)) <= set(order) and order.index(tree.down(points[:1])[0]) < 5
