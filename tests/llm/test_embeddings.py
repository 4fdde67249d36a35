import math

import numpy as np

from tarifa.llm import embeddings
from tests.llm.tables import SF_DIR, needs_tables, roots


def frame_of(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return frame.selectExpr("*", "1 AS size", "'x' AS digest", "2 AS rep", "3 AS filter", "4 AS blob", "5 AS component")


def brute(rows, cosine=0.93):
    good = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, dtype=np.float32).astype(float)
        good.append((i, x / np.linalg.norm(x), label))
    links = [(a[0], b[0]) for k, a in enumerate(good) for b in good[k + 1 :] if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] >= cosine]
    root = roots([r[0] for r in rows if r[0] is not None], links)
    count = {i: 0 for i in root}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return {i: (count[i], root[i], root[i] == i) for i in root}


def found(spark, rows):
    result = embeddings.near_vectors(frame_of(spark, rows)).collect()
    assert len(result) == len(rows)
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in result if r["vec_id"] is not None}


@needs_tables
def test_whole_table_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert found(spark, rows) == brute(rows)


def test_recall_just_above_the_threshold(spark):
    """Pairs of cosine 0.93 to 0.95 among other vectors: at least 0.99 of them are found, and nothing else."""
    chance = np.random.default_rng(1)
    rows = []
    for k in range(400):
        a, b = np.linalg.qr(chance.normal(size=(64, 2)))[0].T
        c = chance.uniform(0.9301, 0.95)
        rows += [(2 * k, a.tolist(), k % 2), (2 * k + 1, (c * a + math.sqrt(1 - c * c) * b).tolist(), k % 2)]
    rows += [(2000 + k, chance.normal(size=64).tolist(), k % 2) for k in range(1500)]
    links = sum(n for n, _, _ in found(spark, rows).values()) / 2
    assert 0.99 * 400 <= links <= 400


def test_dense_group_in_blocks_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    chance = np.random.default_rng(2)
    centre = chance.normal(size=16)
    rows = [(k, (centre + 0.25 * chance.normal(size=16)).tolist(), 1) for k in range(300)]
    rows += [(500 + k, rows[k % 3][1], 1) for k in range(40)]  # copies
    rows += [(600, rows[0][1], 2), (601, rows[0][1], None), (602, None, 1), (603, [], 1), (604, [0.0] * 16, 1), (605, [1.0, None] * 8, 1)]
    rows += [(606, [float("nan")] * 16, 1), (607, [float("inf")] * 16, 1), (608, [1e30] * 16, 3), (609, [2e30] * 16, 3), (610, [1e-30] * 16, 3), (611, [1.0], 3), (612, [5.0], 3)]
    assert found(spark, rows) == brute(rows)


def test_missing_ids_and_no_rows(spark):
    rows = [(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (4, [1.0, 2.0], 1)]
    result = embeddings.near_vectors(frame_of(spark, rows)).collect()
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1, r["kept"]) for r in result) == [(-1, 0, -1, True)] * 2 + [(4, 1, 4, True)] * 2
    assert embeddings.near_vectors(frame_of(spark, rows).limit(0)).count() == 0


def test_one_id_on_several_vectors(spark):
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    rows = [(1, a, 1), (1, b, 1), (2, [1.0, 0.1, 0.0, 0.0], 1), (3, [0.1, 1.0, 0.0, 0.0], 1), (9, a, 2), (9, b, 2), (9, b, 2)]
    result = embeddings.near_vectors(frame_of(spark, rows)).collect()
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in result)
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (9, 0, 9, True), (9, 1, 9, True), (9, 1, 9, True)]
