"""Language of documents: the family first, then one-versus-one linear support vector machines within it.

A text is the vector of the square roots of its hashed character n-gram counts, of length 1. Families are told apart by
linear support vector machines between each two of them, and so are the languages of the family that wins. The machine of a
pair votes, and its margin settles equal votes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import held_out, lowest_hashes, written
from tarifa.llm.ngrams import gram_blocks

ORDERS, BITS = (1, 2, 3), 14
#: Labelled rows of each language to learn from.
SAMPLE = 400

# Language codes by family. A language that is not listed belongs to a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def vector(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    counts = np.zeros(1 << BITS)
    for block in gram_blocks(text, ORDERS, BITS):
        counts += np.bincount(block, minlength=1 << BITS)
    index = np.flatnonzero(counts)
    value = np.sqrt(counts[index])
    return index, value / np.sqrt(max(1.0, counts.sum()))


def machine(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 10.0, rounds: int = 12) -> np.ndarray:
    """A linear support vector machine (hinge loss, bias in the last weight) by dual coordinate descent; y is 1 or -1."""
    w, alpha, order = np.zeros((1 << BITS) + 1), np.zeros(len(rows)), np.random.default_rng(5)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            index, value = rows[i]
            gradient = y[i] * (value @ w[index] + w[-1]) - 1.0
            new = min(max(alpha[i] - gradient / (value @ value + 1.0), 0.0), cost)
            change, alpha[i] = (new - alpha[i]) * y[i], new
            w[index] += change * value
            w[-1] += change
    return w


class Contest:
    """One-versus-one machines between names."""

    def __init__(self, names: list[str], rows: list, labels: list[str]) -> None:
        self.names = sorted(names)
        self.pairs = list(combinations(range(len(self.names)), 2))
        machines = []
        for a, b in self.pairs:
            own = [i for i, x in enumerate(labels) if x in (self.names[a], self.names[b])]
            y = np.array([1.0 if labels[i] == self.names[a] else -1.0 for i in own])
            machines.append(machine([rows[i] for i in own], y))
        self.weights = np.array(machines).reshape(len(self.pairs), (1 << BITS) + 1)

    def winner(self, index: np.ndarray, value: np.ndarray) -> tuple[str, float]:
        """The name with most votes (then margin, then first in order) and its confidence."""
        if len(self.names) == 1:
            return self.names[0], 1.0
        margins = self.weights[:, index] @ value + self.weights[:, -1]
        votes, support = np.zeros(len(self.names)), np.zeros(len(self.names))
        worst = np.full(len(self.names), np.inf)
        for (a, b), m in zip(self.pairs, margins, strict=True):
            votes[a if m >= 0 else b] += 1
            support[a] += m
            support[b] -= m
            worst[a], worst[b] = min(worst[a], m), min(worst[b], -m)
        best = max(range(len(self.names)), key=lambda i: (votes[i], support[i], -i))
        return self.names[best], float(1.0 / (1.0 + np.exp(-3.0 * np.clip(worst[best], -10, 10))))


class Hierarchy:
    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: list[str]) -> None:
        families = [FAMILY_OF.get(x, x) for x in labels]
        self.families = Contest(list(set(families)), rows, families)
        self.within = {}
        for family in set(families):
            own = [i for i, f in enumerate(families) if f == family]
            self.within[family] = Contest(list({labels[i] for i in own}), [rows[i] for i in own], [labels[i] for i in own])

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        index, value = vector(text)
        family, sure = self.families.winner(index, value)
        language, surer = self.within[family].winner(index, value)
        return language, sure * surer


def training_sample(docs: DataFrame, per_language: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text) of at most ``per_language`` rows of each language, by a hash of the id; held-out rows are left out."""
    named = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(F.col(id_col)))
    named = named.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    ids = named.where(F.length("text") > 0).select("doc_id", "lang").distinct()
    chosen = lowest_hashes(ids, "lang", per_language)
    return written(named.join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "text"), "language-sample")


def sample_vectors(sample: DataFrame) -> list:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [vector(t) for t in batch.column(1).to_pylist()]
            index = pa.array([i.astype(np.int32).tobytes() for i, _ in found], pa.binary())
            value = pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), index, value], names=["lang", "index", "value"])

    return sample.select("lang", "text").mapInArrow(rows, "lang string, index binary, value binary").collect()


def languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs``.

    Learns from at most ``per_language`` rows of each language that are not held out; only the text enters a prediction.
    ``lang_pred`` is one of the learnt values, or ``und`` with score 0 for NULL texts, texts without a letter, and all texts
    where nothing could be learnt. The score is the product of the confidences in family and language. Rows that repeat an
    id are predicted each; a row without id is predicted and not held out. An empty table gives an empty result; other
    columns are not read.
    """
    sample = sample_vectors(training_sample(docs, per_language, id_col, text_col, lang_col))
    sample.sort(key=lambda r: (r["lang"], r["index"], r["value"]))
    vectors = [(np.frombuffer(r["index"], dtype=np.int32), np.frombuffer(r["value"], dtype=np.float32)) for r in sample]
    model = docs.sparkSession.sparkContext.broadcast(Hierarchy(vectors, [r["lang"] for r in sample]) if sample else None)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hierarchy = model.value
        for batch in batches:
            found = [hierarchy.predict(t.as_py()) if hierarchy else ("und", 0.0) for t in batch.column(1)]
            names, sure = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), names, sure], names=["doc_id", "lang_pred", "score"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = narrow.mapInArrow(rows, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
