"""A training corpus from raw documents: five stages, each written and read again as the input of the next."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.llm import bpe, contamination, near_dup, secrets, toxicity
from tarifa.llm.common import release_memory, small_or_plain, table, written

#: Upper bounds for what a task holds of whole texts, besides Spark's own defaults: rows and bytes of an Arrow batch, rows of a
#: batch read from Parquet, bytes of a row group before it is written.
BOUNDS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20,
    "spark.sql.parquet.columnarReaderBatchSize": 512,
    "parquet.block.size": 16 << 20,
}
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def documents_of(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def without(docs: DataFrame, rows: DataFrame, by: list[str]) -> DataFrame:
    """The documents that are not among the rows; documents without id stay."""
    return documents_of(docs.join(small_or_plain(written(rows.select(*by).distinct(), "dropped")), by, "left_anti"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold. The score is computed on the row itself, so rows without id are judged too."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    return documents_of(docs).where(toxicity.score_of(spark, model, F.col("text")) < 0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8): the one with the smallest id.

    Documents go by id and text, so that a row with another text does not go with a copy that has its id.
    """
    marked = documents_of(docs).withColumn("text_digest", F.unhex(F.md5("text")))
    found = near_dup.near_duplicates(marked, shingle=5, percent=80, carry=("text_digest",))
    return without(marked, found.where(~F.col("kept")), ["doc_id", "text_digest"])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item (or a whole shorter item)."""
    found = contamination.contamination(docs, table(spark, sf_dir, "benchmark"), width=10)
    return without(docs, found.where("n_hit > 0 and doc_id is not null"), ["doc_id"])


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by marks and their length counted again."""
    cleaned = documents_of(docs).withColumn("text", secrets.redacted(F.col("text")))
    return cleaned.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) of all documents."""
    path = public_tokenizers.path("word_bpe_49k.json")
    decoded = bpe.decode(bpe.encode(docs, path), path)
    return decoded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def lean(stage: Stage) -> Stage:
    """The stage within little memory: workers of the stage before give theirs back, and batches and row groups are small."""

    @wraps(stage)
    def started(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_memory(spark)
        for name, bound in BOUNDS.items():
            spark.conf.set(name, str(bound))
        return stage(spark, docs, sf_dir)

    return started


STAGES = [
    ("toxicity", lean(drop_toxic)),
    ("near duplicates", lean(drop_near_duplicates)),
    ("decontamination", lean(drop_contaminated)),
    ("secrets", lean(remove_secrets)),
    ("tokens", lean(tokenized)),
]

#: A trained classifier, zstandard and a tokenizer have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
