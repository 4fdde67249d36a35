"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on the driver on a bounded sample: ``SAMPLE`` vectors, or fewer where those would take ``SAMPLE_BYTES``. Each
node's points are parted by k-means into ``BRANCHES`` children until a leaf is expected to hold ``LEAF`` rows of the whole table,
or ``LEAST`` of the sample. Every row then goes down to a leaf. A query walks the tree best bin first: a priority queue holds
nodes by the distance of their centre, the nearest is taken, an inner node puts its children in, a leaf is visited.

How many leaves a query visits is calibrated: for ``TRIALS`` queries the exact neighbours among all rows are found in one pass,
and the visits are widened until ``RECALL`` of these neighbours lie in visited leaves. A query also goes on until its leaves hold
enough rows.

Leaves that follow each other in the tree make a shelf of ``BLOCK_BYTES`` of vectors. A query goes to each shelf it visits once,
with its leaves there, and brings back ``k + 1`` rows at most; a leaf larger than a shelf is dealt into blocks.

Of rows with equal vectors only the ``k + 1`` smallest ids can be among the nearest of anything, so a group of copies, however
large, is that many rows in the index, and equal queries are searched once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarifa.llm.common import written

SAMPLE, SAMPLE_BYTES = 20_000, 1 << 26
BRANCHES, LEAF, LEAST, ROUNDS = 8, 128, 6, 8
TRIALS, RECALL = 256, 0.97
#: Bytes of vectors of a shelf, queries that meet it in one task, and tasks that give out the result of a group of equal queries.
BLOCK_BYTES, BLOCK_QUERIES, SALTS = 1 << 25, 4096, 16


def distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision; equal rows have equal ones. Squares out of range are scaled first."""
    gaps = rows - point
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        out = np.sqrt((gaps * gaps).sum(axis=1))
        for i in np.flatnonzero(~np.isfinite(out) | (out < 1e-140)):
            most = np.abs(rows[i] / 2 - point / 2).max()
            out[i] = 2 * most * np.sqrt((((rows[i] / 2 - point / 2) / most) ** 2).sum()) if most > 0 else 0.0
    return out


class Tree:
    """Centres and children of the nodes; node 0 is the root, and leaves are numbered from ``first_leaf``."""

    def __init__(self, points: np.ndarray, rows: float, first_leaf: int) -> None:
        """``rows`` is the number of rows of the table that a point of the sample stands for."""
        self.centres, self.children, self.leaf_of = [points.mean(axis=0)], [np.zeros(0, dtype=np.int64)], {}
        chance = np.random.default_rng(first_leaf)
        todo = [(0, points)]
        while todo:
            node, own = todo.pop()
            parts = parted(own, chance) if len(own) * rows > LEAF and len(own) >= 2 * LEAST else []
            if len(parts) < 2:
                self.leaf_of[node] = first_leaf + len(self.leaf_of)
                continue
            self.children[node] = np.arange(len(self.centres), len(self.centres) + len(parts))
            for part in parts:
                todo.append((len(self.centres), part))
                self.centres.append(part.mean(axis=0))
                self.children.append(np.zeros(0, dtype=np.int64))
        self.centres = np.array(self.centres)

    def down(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point is in."""
        node, out = np.zeros(len(points), dtype=np.int64), np.zeros(len(points), dtype=np.int64)
        todo = np.arange(len(points))
        while len(todo):
            for at in np.unique(node[todo]):
                own = todo[node[todo] == at]
                if at in self.leaf_of:
                    out[own] = self.leaf_of[at]
                    node[own] = -1
                else:
                    node[own] = self.children[at][nearest(points[own], self.centres[self.children[at]])]
            todo = todo[node[todo] >= 0]
        return out

    def best_first(self, point: np.ndarray) -> Iterator[int]:
        """All leaves, in the order of a best-bin-first walk."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if node in self.leaf_of:
                yield self.leaf_of[node]
                continue
            below = self.children[node]
            for gap, child in zip(((self.centres[below] - point) ** 2).sum(axis=1).tolist(), below.tolist(), strict=True):
                heapq.heappush(queue, (gap, child))


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None, :] - 2 * points @ centres.T).argmin(axis=1)


def parted(points: np.ndarray, chance: np.random.Generator) -> list[np.ndarray]:
    """The points of each cluster of k-means that is not empty."""
    centres = points[np.sort(chance.choice(len(points), min(BRANCHES, len(points)), replace=False))]
    for _ in range(ROUNDS):
        at = nearest(points, centres)
        centres = np.array([points[at == c].mean(axis=0) for c in np.unique(at)])
    at = nearest(points, centres)
    return [points[at == c] for c in np.unique(at)]


def matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=np.float64).reshape(len(blobs), -1)


def by_length(blobs: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and vectors of each length."""
    lengths = np.array([len(b) // 8 for b in blobs])
    for length in np.unique(lengths):
        own = np.flatnonzero(lengths == length)
        yield int(length), own, matrix([blobs[i] for i in own])


def packed(rows: DataFrame) -> DataFrame:
    """(vec_id, length, blob): the components as doubles; adding 0.0 makes -0.0 equal to 0.0."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            ends = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            blobs = [values[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)]
            sizes = pa.array(np.diff(ends).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(blobs, pa.binary())], names=["vec_id", "length", "blob"])

    return rows.mapInArrow(pack, "vec_id long, length int, blob binary")


def sampled(rows: DataFrame, most: int) -> list[bytes]:
    """The vectors of at most ``most`` rows, those with the lowest hash of the vector."""
    n = rows.count()
    near = rows.withColumn("hash", F.pmod(F.xxhash64("digest"), F.lit(1 << 40)))
    near = near.where(F.col("hash") <= min(1.0, (2.0 * most + 100) / max(1, n)) * (1 << 40))
    return [bytes(r["blob"]) for r in near.orderBy("hash", "digest").select("blob").limit(most).collect()]


def fitted(index: DataFrame) -> dict[int, Tree]:
    """A tree for each length of vector in the sample."""
    n = index.count()
    length = index.agg(F.max("length")).first()[0] or 1
    points = sampled(index.where("place = 1"), min(SAMPLE, max(BRANCHES * LEAST, SAMPLE_BYTES // (8 * length))))
    trees: dict[int, Tree] = {}
    first = 0
    for length, _, own in by_length(points) if points else []:
        trees[length] = Tree(own, n / len(points), first)
        first += len(trees[length].leaf_of)
    return trees


def placed(index: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """The rows with their leaf; vectors of a length that the sample lacks have a leaf of their own, a negative number."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = np.zeros(len(batch), dtype=np.int64)
            for length, own, points in by_length(batch.column(2).to_pylist()):
                leaf[own] = trees[length].down(points) if length in trees else -length
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec_id", "length", "blob", "leaf"])

    return index.select("vec_id", "length", "blob").mapInArrow(place, "vec_id long, length int, blob binary, leaf long")


def calibrated(rows: DataFrame, trials: list[bytes], trees: dict[int, Tree], k: int) -> int:
    """Leaves to visit, so that the share ``RECALL`` of the exact neighbours of the trials lies in them."""
    trials = [t for t in trials if len(t) // 8 in trees]
    if not trials:
        return 1
    points = {length: (own, vectors) for length, own, vectors in by_length(trials)}

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, int, int]]] = [[] for _ in trials]
        for batch in batches:
            ids, leaves = (batch.column(i).to_numpy() for i in (0, 2))
            for length, own, vectors in by_length(batch.column(1).to_pylist()):
                if length not in points:
                    continue
                asked, targets = points[length]
                squares = (vectors**2).sum(axis=1)[:, None] + (targets**2).sum(axis=1)[None, :] - 2 * vectors @ targets.T
                most = min(k, len(own) - 1)
                nearest_rows = np.argpartition(squares, most, axis=0)[: k + 1]
                for column, trial in enumerate(asked.tolist()):
                    some = nearest_rows[:, column]
                    rows_ = zip(squares[some, column].tolist(), ids[own[some]].tolist(), leaves[own[some]].tolist(), strict=True)
                    best[trial] = heapq.nsmallest(k + 1, [*best[trial], *rows_])
        flat = [(t, *row) for t, near_rows in enumerate(best) for row in near_rows]
        columns = [pa.array([r[i] for r in flat], kind) for i, kind in enumerate((pa.int32(), pa.float64(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["trial", "gap", "vec_id", "leaf"])

    found = rows.select("vec_id", "blob", "leaf").mapInArrow(near, "trial int, gap double, vec_id long, leaf long")
    rank = F.row_number().over(Window.partitionBy("trial").orderBy("gap", "vec_id"))
    wanted: dict[int, list[int]] = {}
    ranked = found.withColumn("rank", rank).where((F.col("rank") > 1) & (F.col("rank") <= k + 1))  # the first is the trial itself
    for row in ranked.collect():  # TRIALS times k
        wanted.setdefault(row["trial"], []).append(row["leaf"])
    needed = []
    for trial, leaves in wanted.items():
        order = {leaf: i + 1 for i, leaf in enumerate(trees[len(trials[trial]) // 8].best_first(matrix([trials[trial]])[0]))}
        needed += [order[leaf] for leaf in leaves]
    visits = 1
    while sum(n <= visits for n in needed) < RECALL * len(needed):
        visits += 1
    return visits


def shelved(sizes: dict[int, int], lengths: dict[int, int]) -> dict[int, int]:
    """The shelf of each leaf. Leaves of one length that follow each other share one while they fit."""
    shelves: dict[int, int] = {}
    shelf, held, before = -1, 0, 0
    for leaf in sorted(sizes):
        need = sizes[leaf] * lengths[leaf] * 8
        if held + need > BLOCK_BYTES or lengths[leaf] != before or shelf < 0:
            shelf, held = shelf + 1, 0
        held, before = held + need, lengths[leaf]
        shelves[leaf] = shelf
    return shelves


def visited(queries: DataFrame, trees: dict[int, Tree], sizes: dict[int, int], shelves: dict[int, int], visits: int, enough: int) -> DataFrame:
    """(shelf, digest, blob, leaves): the leaves that each query visits, by shelf; at least so many that they hold ``enough`` rows."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, shelf, leaves = [], [], []
            for i, blob in enumerate(batch.column(1).to_pylist()):
                point = np.frombuffer(blob, dtype=np.float64)
                held, taken = 0, {}
                order = trees[len(point)].best_first(point) if len(point) in trees else [-len(point)]
                for n, at in enumerate(order):
                    if n >= visits and held >= enough:
                        break
                    if at in sizes:
                        held += sizes[at]
                        taken.setdefault(shelves[at], []).append(at)
                for at, own in taken.items():
                    row.append(i)
                    shelf.append(at)
                    leaves.append(np.array(sorted(own), dtype=np.int64).tobytes())
            rows = batch.take(pa.array(row, pa.int64()))
            columns = [pa.array(shelf, pa.int32()), *rows.columns, pa.array(leaves, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["shelf", "digest", "blob", "leaves"])

    return queries.select("digest", "blob").mapInArrow(walk, "shelf int, digest binary, blob binary, leaves binary")


def compared(rows: DataFrame, visits: DataFrame, sizes: dict[int, int], lengths: dict[int, int], shelves: dict[int, int], k: int) -> DataFrame:
    """(digest, vec_id, score): the nearest ``k`` rows of each query on each shelf, or block of a shelf with one large leaf."""
    spark = rows.sparkSession
    asked = {r["shelf"]: r["n"] for r in visits.groupBy("shelf").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each shelf
    held: dict[int, int] = {}
    for leaf, shelf in shelves.items():
        held[shelf] = held.get(shelf, 0) + sizes[leaf] * lengths[leaf] * 8
    facts = [(shelf, -(-n // BLOCK_BYTES), -(-asked[shelf] // BLOCK_QUERIES)) for shelf, n in held.items() if shelf in asked]
    places = spark.createDataFrame(list(shelves.items()), "leaf long, shelf int")
    blocks = spark.createDataFrame(facts, "shelf int, row_blocks int, query_blocks int")

    def block(key: Column, blocks: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(blocks)).cast("int")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    left = rows.join(F.broadcast(places.join(blocks, "shelf")), "leaf")  # a row for each leaf
    left = left.withColumn("b", block(F.col("vec_id"), "row_blocks")).withColumn("q", every("query_blocks"))
    right = visits.join(F.broadcast(blocks), "shelf").withColumn("q", block(F.col("digest"), "query_blocks")).withColumn("b", every("row_blocks"))

    def search(own: pa.Table, queries: pa.Table) -> pa.Table:
        digests, ids, scores = [], [], []
        if len(own) and len(queries):
            own = own.sort_by("leaf")
            leaf, vec_ids, vectors = own["leaf"].to_numpy(), own["vec_id"].to_numpy(), matrix(own["blob"].to_pylist())
            for query in queries.select(["digest", "blob", "leaves"]).to_pylist():
                wanted = np.frombuffer(query["leaves"], dtype=np.int64)
                use = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, leaf), len(wanted) - 1)] == leaf)
                score = distances(vectors[use], np.frombuffer(query["blob"], dtype=np.float64))
                some = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1]) if len(score) > k else np.arange(len(score))
                some = some[np.lexsort((vec_ids[use[some]], score[some]))][:k]
                digests += [query["digest"]] * len(some)
                ids.append(vec_ids[use[some]])
                scores.append(score[some])
        columns = [pa.array(digests, pa.binary()), pa.array(np.concatenate([*ids, np.zeros(0, dtype=np.int64)]))]
        return pa.table([*columns, pa.array(np.concatenate([*scores, np.zeros(0)]))], names=["digest", "vec_id", "score"])

    grouped = left.select("shelf", "b", "q", "leaf", "vec_id", "blob").groupBy("shelf", "b", "q")
    return grouped.cogroup(right.select("shelf", "b", "q", "digest", "blob", "leaves").groupBy("shelf", "b", "q")).applyInArrow(
        search, "digest binary, vec_id long, score double"
    )


def neighbours(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of which ``queries`` (of the column vec_id) is true, the ``k`` nearest other rows found.

    Score is the Euclidean distance of the vectors as they are, in double precision; ties go to the smaller id. Rows without id
    or vector, with a zero vector, or with a component that is NULL or not finite take no part. Every other row is a candidate,
    also one that repeats another or has the id of the query; only the query's own row is not. Vectors of different lengths are
    not compared. A query with fewer candidates gets all of them, one without gets no row. An empty table gives an empty result;
    other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    usable = F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    good = written(packed(rows.where(usable)).withColumn("digest", F.unhex(F.sha2("blob", 256))), "ann-vectors")
    place = F.row_number().over(Window.partitionBy("digest").orderBy("vec_id"))
    index = written(good.withColumn("place", place).where(F.col("place") <= k + 1), "ann-index")
    trees = fitted(index)
    leaves = written(placed(index, trees), "ann-leaves")
    facts = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("length")).collect()  # a row for each leaf
    sizes, lengths = {r["leaf"]: r["n"] for r in facts}, {r["leaf"]: r["length"] for r in facts}
    asked = good.where(queries)
    once = F.row_number().over(Window.partitionBy("digest").orderBy("vec_id"))
    distinct = written(asked.withColumn("place", once).where(F.col("place") == 1).select("digest", "blob"), "ann-queries")
    visits = calibrated(leaves, sampled(distinct, TRIALS), trees, k)
    shelves = shelved(sizes, lengths)
    walked = written(visited(distinct, trees, sizes, shelves, visits, k + 1), "ann-visits")
    found = compared(leaves, walked, sizes, lengths, shelves, k + 1)
    rank = F.row_number().over(Window.partitionBy("digest").orderBy("score", "vec_id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k + 1).groupBy("digest")
    best = best.agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("near"))  # k + 1 at most
    # a group of equal queries is dealt out by several tasks
    best = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = asked.select("digest", F.col("vec_id").alias("query_id"), F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int").alias("salt"))
    met = salted.join(best, ["digest", "salt"])
    own = F.array_position("near", F.struct(F.lit(0.0).alias("score"), F.col("query_id").alias("vec_id"))).cast("int")
    others = F.filter("near", lambda x, i: i + 1 != F.col("own"))
    met = met.withColumn("own", own).select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "hit"))
    return met.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
