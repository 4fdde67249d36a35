"""Toxicity of documents: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed character n-grams of the whole text. For each, the ratio of its smoothed document frequencies in both
classes is learnt, and the features that tell the classes apart most are kept. The value of a kept feature in a text is its log
ratio, grown with the logarithm of its count; the values of a text are scaled to a common length, and a logistic regression is
fitted over them. The intercept is moved to the share of toxic rows among all labelled rows, so that scores are probabilities
there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.llm.common import held_out, lowest_hashes, written
from tarifa.llm.ngrams import Presence, gram_blocks, logistic

ORDERS, BITS = (4, 6, 8), 20
#: Labelled rows of each class to learn from, and features kept.
SAMPLE, FEATURES = 2_000, 8_192
#: Length of the vector of a text with many features.
SCALE = 5.0


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, int, int]:
    """(label, text) of at most ``per_class`` rows of each class, taken by a hash of the id, and the size of each class.

    Rows are labelled 1 if any of their labels is 1. Held-out rows are left out. The ids are few by their bound and
    broadcast.
    """
    named = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    named = named.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in named.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = lowest_hashes(named, "label", per_class)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return written(texts.join(F.broadcast(chosen), "doc_id").select("label", "text"), "toxic-sample"), sizes.get(0, 0), sizes.get(1, 0)


def class_counts(sample: DataFrame) -> DataFrame:
    """(bucket, zeros, ones): documents of each class that have the bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, total = Presence(ORDERS, BITS), np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[label, present.distinct(text)] += 1
        some = np.flatnonzero(total.any(axis=0))
        for at in range(0, len(some), 1 << 16):
            part = some[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[0, part]), pa.array(total[1, part])], names=["bucket", "zeros", "ones"])

    rows = sample.select("label", "text").mapInArrow(count, "bucket long, zeros long, ones long")
    return rows.groupBy("bucket").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))


class Model:
    """Kept buckets (sorted), their log ratios and weights, and the intercept."""

    def __init__(self, kept: np.ndarray, ratio: np.ndarray, weight: np.ndarray, intercept: float) -> None:
        self.place = np.full(1 << BITS, -1, dtype=np.int32)
        self.place[kept] = np.arange(len(kept))
        self.ratio, self.weight, self.intercept = ratio, weight, intercept

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        found = [x[x >= 0] for x in (self.place[block] for block in gram_blocks(text, ORDERS, BITS))]
        index, counts = np.unique(np.concatenate(found) if found else np.zeros(0, dtype=np.int32), return_counts=True)
        value = self.ratio[index] * (1 + np.log(counts))
        return index.astype(np.int64), value * (SCALE / np.sqrt(value @ value + SCALE * SCALE))

    def score(self, text: str | None) -> float:
        index, value = self.vector(text)
        return float(1.0 / (1.0 + np.exp(-np.clip(self.weight[index] @ value + self.intercept, -35, 35))))


def vectors(sample: DataFrame, model: Model) -> DataFrame:
    """(label, index, value) of the rows, packed: lists of numbers would fill the driver's memory."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.vector(t) for t in batch.column(1).to_pylist()]
            index = pa.array([i.astype(np.int32).tobytes() for i, _ in found], pa.binary())
            value = pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), index, value], names=["label", "index", "value"])

    return sample.select("label", "text").mapInArrow(rows, "label int, index binary, value binary")


def fit(sample: DataFrame, zeros: int, ones: int) -> Model:
    """The model of a sample; without rows of both classes it has no features, and the share of ones as its score."""
    prior = (ones + 0.5) / (zeros + ones + 1.0)
    base = float(np.log(prior / (1 - prior))) if zeros + ones else -35.0
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0), base)
    n0, n1 = sizes[0], sizes[1]
    mean = (F.col("zeros") + F.col("ones")) / (n0 + n1)
    apart = F.abs(F.col("ones") / n1 - F.col("zeros") / n0) / F.sqrt(mean * (1 - mean) * (1 / n0 + 1 / n1) + 1e-9)
    best = class_counts(sample).withColumn("z", apart).orderBy(F.desc("z"), "bucket").limit(FEATURES).collect()
    best = sorted(best, key=lambda r: r["bucket"])
    kept = np.array([r["bucket"] for r in best], dtype=np.int64)
    ratio = np.log((np.array([r["ones"] for r in best]) + 1.0) / (n1 + 2.0)) - np.log((np.array([r["zeros"] for r in best]) + 1.0) / (n0 + 2.0))
    rows = vectors(sample, Model(kept, ratio, ratio, 0.0)).collect()
    rows.sort(key=lambda r: (r["label"], r["index"], r["value"]))
    data = [(np.frombuffer(r["index"], dtype=np.int32), np.frombuffer(r["value"], dtype=np.float32)) for r in rows]
    w, b = logistic(data, np.array([r["label"] for r in rows], dtype=float), len(kept), l2=1e-4, rounds=400)
    return Model(kept, ratio, w, b + base - float(np.log(n1 / n0)))


def score_of(spark: SparkSession, model: Model, text: Column) -> Column:
    """The score of a text column; the model (about 4 MB) is broadcast."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(held.value.score).astype(float)

    return score(F.coalesce(text, F.lit("")))


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int = SAMPLE) -> Model:
    sample, zeros, ones = training_sample(docs, labels, per_class, id_col, text_col, label_col)
    return fit(sample, zeros, ones)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = SAMPLE,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    Learns from at most ``per_class`` labelled rows of each class that are not held out; only the text enters a score.
    NULL and empty texts have no n-grams and get the intercept. Without labels of both classes every score is the smoothed
    share of toxic labels (0 without labels). Rows that repeat an id are scored each; a row without id is scored and not
    held out. An empty table gives an empty result; other columns are not read.
    """
    model = learn(docs, labels, id_col, text_col, label_col, per_class)
    score = score_of(docs.sparkSession, model, F.col(text_col)).alias("score")
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), score)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
