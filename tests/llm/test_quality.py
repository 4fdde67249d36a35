import numpy as np

from tarifa.llm import quality
from tarifa.llm.common import WordHasher
from tests.llm.tables import docs_of

GOOD, BAD = "the house on the hill was quiet and old", "win cash now | win cash now | click | click"
ROWS = [(i, f"{GOOD} {i}" if i % 4 else f"{BAD} {i} | now") for i in range(400)]
LABELS = [(i, int(i % 4 > 0)) for i in range(400)]


def brute_weights(rows, target):
    hasher = WordHasher(quality.NOT_SEPARATOR)
    grams = {}
    for i, text in rows:
        words = [int(hasher([w])[0][0]) for w in (text or "").split()]
        pairs = [int(quality.mix(np.array([(a * 31 + b) % 2**64], dtype=np.uint64))[0]) for a, b in zip(words, words[1:])]
        grams[i] = [g % quality.BUCKETS for g in words + pairs]
    raw, good = np.ones(quality.BUCKETS), np.ones(quality.BUCKETS)
    for i, found in grams.items():
        for g in found:
            raw[g] += 1
            good[g] += i in target
    ratio = np.log(good / good.sum()) - np.log(raw / raw.sum())
    return {i: sum(ratio[g] for g in found) if found else None for i, found in grams.items()}


def test_weights_and_draw_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "LAST", 7)
    monkeypatch.setattr(quality, "BINS", 5)
    from tests.llm.test_classifiers import is_held_out

    rows = ROWS + [(500, None), (501, ""), (502, " \n")]
    labels = spark.createDataFrame(LABELS + [(3, 1), (None, 1), (9, None)], "doc_id long, quality int")
    result = quality.resample(docs_of(spark, rows), labels, fraction=0.6, seed=3).collect()
    weights = brute_weights(rows, {i for i, q in LABELS if q and not is_held_out(i)})
    assert len(result) == len(rows)
    for r in result:
        w = weights[r["doc_id"]]
        assert (r["log_weight"] is None and not r["kept"]) if w is None else abs(r["log_weight"] - w) < 1e-9
    keys = sorted((r["key"] for r in result if r["key"] is not None), reverse=True)
    assert {r["doc_id"] for r in result if r["kept"]} == {r["doc_id"] for r in result if r["key"] is not None and r["key"] >= keys[239]}
    assert sum(r["kept"] for r in result) == 240
    bad = [r for r in result if r["doc_id"] < 400 and r["doc_id"] % 4 == 0]
    assert sum(r["kept"] for r in bad) <= 0.05 * len(bad)


def test_noise_draws_in_proportion(spark):
    """Of rows with weights 0 and 2 the second is drawn first with probability e^2 / (1 + e^2)."""
    from pyspark.sql import functions as F

    noise = spark.range(20_000).select(quality.gumbel(F.col("id"), 1).alias("a"), (quality.gumbel(F.col("id"), 2) + 2).alias("b"))
    share = noise.agg(F.avg((F.col("b") > F.col("a")).cast("double"))).first()[0]
    assert abs(share - np.exp(2) / (1 + np.exp(2))) < 0.01


def test_ties_missing_ids_and_no_rows(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    rows = [(1, "a b")] * 5 + [(None, "a b")] * 5
    kept = [r["kept"] for r in quality.resample(docs_of(spark, rows), labels, fraction=0.1).collect()]
    assert sum(kept) == 5  # rows that tie with the last of the draw are in it
    assert quality.resample(docs_of(spark, rows).limit(0), labels, fraction=0.5).count() == 0
