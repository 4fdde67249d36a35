"""Shared pieces: written intermediate tables, word hashing, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarifa.session import scratch_folder

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
#: Bytes whose hashing is held in memory at once (about 40 bytes of working space for each).
BLOCK = 1 << 20
#: Rows of ids that may be broadcast (8 bytes each and Spark's hash table: about 100 MB); more are joined by shuffle.
BROADCAST_ROWS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written as Parquet in the shared scratch folder and read back, which cuts its lineage."""
    spark = frame.sparkSession
    folder = scratch_folder(spark, purpose)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def release_memory(spark: SparkSession) -> None:
    """Let the Python workers that wait for tasks give freed memory back to the system.

    Workers are reused from job to job and keep what they once needed, beside the heap of their executor. Short tasks, several
    for each core, reach the waiting workers; where the C library cannot trim, nothing happens.
    """

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches
        gc.collect()
        pa.default_memory_pool().release_unused()
        malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if malloc_trim is not None:
            malloc_trim(0)

    tasks = 8 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).mapInArrow(trim, "id long").agg(F.count(F.lit(1))).collect()


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def lowest_hashes(rows: DataFrame, group: str, most: int) -> DataFrame:
    """At most ``most`` rows of each of a few groups: those whose doc_id has the lowest hash.

    The sizes of the groups tell below which hash they lie, with room to spare, so that few rows meet in the task of a group
    however many tasks there were.
    """
    key = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("group_size"))
    near = rows.withColumn("hash_key", key).join(F.broadcast(sizes), group)
    near = near.where(F.col("hash_key") <= float(1 << 40) * (4.0 * most + 100) / F.col("group_size"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("hash_key", "doc_id"))
    chosen = near.withColumn("hash_rank", rank).where(F.col("hash_rank") <= most)
    return chosen.drop("hash_key", "hash_rank", "group_size")


def small_or_plain(ids: DataFrame) -> DataFrame:
    """The ids with a broadcast hint where a count proves them few."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 on unsigned 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed))


def powers(n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    if n > 1:
        out[1:] = np.uint64(0xD6E8FEB86659FD93)
        np.multiply.accumulate(out, out=out)
    return out


class WordHasher:
    """64-bit hashes of the words of texts, vectorised over the UTF-8 bytes of a batch.

    ``word_bytes`` is a table of 256 booleans. All separators must be ASCII, so that bytes decide. A-Z are lowered.
    """

    def __init__(self, word_bytes: np.ndarray) -> None:
        self.word = word_bytes.copy()
        codes = np.arange(256)
        upper = (codes >= 65) & (codes <= 90)
        values = stream(7, 256)
        values[upper] = values[codes[upper] + 32]
        self.word[upper] = word_bytes[codes[upper] + 32]
        values[~self.word] = 0
        self.values = values

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts, one after the other, and the first index of each text, with the end."""
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        lengths = np.fromiter((len(p) + 1 for p in parts), dtype=np.int64, count=len(parts))
        data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
        inside = np.zeros(len(data) + 1, dtype=bool)
        inside[1:] = self.word[data]
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        out = np.empty(len(starts), dtype=np.uint64)
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + BLOCK)))
            end = starts[to] if to < len(starts) else len(data)
            out[at:to] = self._hash(data[starts[at] : end], starts[at:to] - starts[at])
            at = to
        bounds = np.zeros(len(parts) + 1, dtype=np.int64)
        bounds[1:] = np.searchsorted(starts, np.cumsum(lengths))
        return out, bounds

    def _hash(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        sizes = np.diff(starts, append=len(data))
        place = np.arange(len(data)) - np.repeat(starts, sizes)
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(self.values[data] * powers(int(sizes.max()))[place], starts)
            return mix(sums)


def byte_groups(texts: list[str | None], limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters together; a longer text is a range of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def text_groups(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, list[str | None]]]:
    """The texts of a batch in groups of about ``limit`` bytes, each with its first row; only one group is in memory as text."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and size + n > limit:
            yield start, column.slice(start, i - start).to_pylist()
            start, size = i, 0
        size += n
    if start < len(column):
        yield start, column.slice(start).to_pylist()


def components(edges: DataFrame, purpose: str = "components", rounds: int | None = None) -> DataFrame:
    """(node, component): each linked node with the smallest node it reaches; ``edges`` has long columns a, b.

    Large-star and small-star rounds. Each takes a minimum per node with map-side combine and joins it back, so no
    neighbourhood is ever gathered; rounds are written to the shared folder. The result lists linked nodes only. With a number
    of ``rounds`` it may stop early: nodes of one component are then linked, but may carry several labels.
    """
    now = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        purpose,
    )
    before = None
    while True:
        if rounds == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b"), F.col("b")).distinct()
            )
        rounds = None if rounds is None else rounds - 1
        state = now.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if (state["n"], state["h"]) == before or not state["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b"), F.col("b")).distinct()
            )
        before = (state["n"], state["h"])
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a")
        small = (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(small.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        now = written(small, purpose)
