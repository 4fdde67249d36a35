"""Quality by importance resampling: how much likelier a text is under a model of good text than under one of all text.

Both models are bags of hashed words and word pairs with smoothed counts. The weight of a text is the log ratio of its
probabilities. Rows are drawn without replacement in proportion to their ratios by adding Gumbel noise to the log weights and
taking the k highest; the noise is a hash of the id, so that repeated runs draw the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import WordHasher, byte_groups, held_out, lowest_hashes, mix, text_groups, written
from tarifa.llm.near_dup import NOT_SEPARATOR

BUCKETS = 10_000
#: Rows of good text to learn from.
TARGET = 20_000
#: Bins of a round of the search for the k-th key, and rows that are ranked at the end.
BINS, LAST = 4_096, 10_000


def grams(words: np.ndarray, bounds: np.ndarray, i: int) -> np.ndarray:
    """The buckets of the words and word pairs of text i of a batch."""
    own = words[bounds[i] : bounds[i + 1]]
    with np.errstate(over="ignore"):
        pairs = mix(own[:-1] * np.uint64(31) + own[1:])
    return (np.concatenate([own, pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def bucket_counts(rows: DataFrame) -> DataFrame:
    """(bucket, raw, target): occurrences in all rows and in those marked as good; rows are (good, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = WordHasher(NOT_SEPARATOR), np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            good = batch.column(0).to_pylist()
            for start, texts in text_groups(batch.column(1)):
                words, bounds = hasher(texts)
                for i in range(len(texts)):
                    found = np.bincount(grams(words, bounds, i), minlength=BUCKETS)
                    total[0] += found
                    if good[start + i]:
                        total[1] += found
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(total[0]), pa.array(total[1])], names=["bucket", "raw", "target"])

    found = rows.select("good", "text").mapInArrow(count, "bucket long, raw long, target long")
    return found.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Per bucket the log ratio of the smoothed probabilities; the table has one row per bucket."""
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for r in counts.collect():
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_weight(text: Column, ratios: np.ndarray) -> Column:
    @F.pandas_udf("double")
    def weight(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hasher = WordHasher(NOT_SEPARATOR)
        for part in parts:
            texts, out = part.tolist(), []
            for start, end in byte_groups(texts):
                words, bounds = hasher(texts[start:end])
                out += [float(ratios[grams(words, bounds, i)].sum()) if bounds[i] < bounds[i + 1] else None for i in range(end - start)]
            yield pd.Series(out, dtype=float)

    return weight(F.coalesce(text, F.lit("")))


def gumbel(row_id: Column, seed: int) -> Column:
    """Noise of the standard Gumbel distribution from a hash of the id."""
    uniform = (F.pmod(F.xxhash64(row_id, F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def kth_highest(rows: DataFrame, key: str, k: int) -> float | None:
    """The k-th highest value of a column, by narrowing bins; None if there are fewer rows."""
    rows = rows.where(F.col(key).isNotNull())
    ends = rows.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n")).first()
    low, high, n = ends["low"], ends["high"], ends["n"]
    if k <= 0 or n < k:
        return None
    while n > LAST and low < high:
        width = (high - low) / BINS
        place = F.least(F.floor((F.col(key) - low) / width), F.lit(BINS - 1))
        inside = rows.where(F.col(key).between(low, high))
        bins = inside.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect()
        for b in sorted(bins, key=lambda b: -b["bin"]):
            if k <= b["n"]:
                break
            k -= b["n"]
        low, high, n = b["low"], b["high"], b["n"]
    if low == high:
        return low
    return rows.where(F.col(key).between(low, high)).select(key).orderBy(F.desc(key)).limit(k).agg(F.min(key)).first()[0]


def resample(
    docs: DataFrame,
    labels: DataFrame,
    fraction: float,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    target_rows: int = TARGET,
) -> DataFrame:
    """(doc_id, log_weight, key, kept) per row of ``docs``; ``kept`` marks the draw of ``fraction`` of the rows with words.

    Good text is that of at most ``target_rows`` rows, by a hash of the id, with a positive label that are not held out; the raw
    model counts all rows. NULL and empty texts and texts without words have no weight and are never drawn. Repeated rows
    have equal keys; rows that tie with the last of the draw are all in it. A row without id draws the noise of NULL. Without
    labels the good model is uniform. An empty table gives an empty result; other columns are not read.
    """
    good = labels.where((F.col(label_col) > 0) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    good = good.select(F.col(id_col).cast("long").alias("doc_id"), F.lit(1).alias("one")).distinct()
    good = lowest_hashes(good, "one", target_rows).select(F.col("doc_id").alias("good_id"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = rows.join(F.broadcast(good), F.col("doc_id") == F.col("good_id"), "left")
    ratios = log_ratios(bucket_counts(marked.select(F.col("good_id").isNotNull().alias("good"), "text")))
    weighted = rows.select("doc_id", log_weight(F.col("text"), ratios).alias("log_weight"))
    keyed = written(weighted.withColumn("key", F.col("log_weight") + gumbel(F.col("doc_id"), seed)), "weights")
    total = keyed.where("key is not null").count()
    least = kth_highest(keyed, "key", round(fraction * total))
    drawn = F.coalesce(F.col("key") >= F.lit(least), F.lit(False)) if least is not None else F.lit(False)
    return keyed.withColumn("kept", drawn)
