"""Near-duplicate vectors by spherical-cap filters.

The filters are the directions of a random product code: a vector is turned and cut into two blocks, each block has a
codebook of random directions, and every pair of words of the two codebooks is a filter. A vector passes the filters whose
inner product with it is over a threshold; the list is decoded block by block, without going through all pairs. Vectors are
joined on label and filter, and those that meet are compared in double precision.

Each vector passes about ``LIST`` filters, and ``LEAST`` at least: where fewer exceed the threshold, it is lowered for that
vector. Pairs of cosine 0.93 then miss each other in fewer than one of a thousand cases. The number of filters follows from the largest label, so that a filter holds about
``BUCKET`` vectors of a label if vectors spread evenly. Filters that hold more are compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import ceil, sqrt
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import components, small_or_plain, written

LIST, LEAST, BUCKET = 32, 24, 64
#: Share of filters that a vector may pass: least and most.
SHARES = (1e-4, 0.02)
#: Vectors of a filter that are compared at once; more are dealt into blocks, and each two blocks meet in a task.
BLOCK = 1024


def filter_share(largest: int) -> float:
    return min(max(BUCKET / max(1, largest), SHARES[0]), SHARES[1])


@cache
def code(dims: int, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Rotation, the two codebooks and the threshold for vectors of a length."""
    words = ceil(sqrt(LIST / share))
    random = np.random.default_rng(dims)
    turn = np.linalg.qr(random.normal(size=(dims, dims)))[0]
    half = (dims + 1) // 2
    books = []
    for size in (half, dims - half):
        book = random.normal(size=(words, size))
        books.append(book / np.maximum(np.linalg.norm(book, axis=1, keepdims=True), 1e-300) / sqrt(2))
    return turn, books[0], books[1], NormalDist().inv_cdf(1 - share) / sqrt(dims)


def passed(units: np.ndarray, share: float) -> list[np.ndarray]:
    """The sorted filters of each unit vector."""
    turn, one, two, threshold = code(units.shape[1], share)
    turned = units @ turn
    left, right = turned[:, : one.shape[1]] @ one.T, turned[:, one.shape[1] :] @ two.T
    out = []
    for a, b in zip(left, right, strict=True):
        order = np.argsort(-b)
        # the best pairs are among the best words of both books
        best = np.sort((-np.sort(-a)[:LEAST, None] + b[order][None, :LEAST]).ravel())
        least = min(threshold, best[-min(LEAST, len(best))]) - 1e-9
        reach = np.searchsorted(-b[order], a - least, side="right")  # words of the second book that suffice
        rows = np.flatnonzero(reach)
        out.append(np.sort(np.concatenate([int(r) * len(b) + order[: reach[r]] for r in rows])))
    return out


def units_of(blobs: list[bytes]) -> np.ndarray:
    vectors = np.frombuffer(b"".join(blobs), dtype=np.float64).reshape(len(blobs), -1)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares must neither overflow nor vanish
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def packed(rows: DataFrame) -> DataFrame:
    """(vec_id, label, blob): the components as doubles."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).astype(np.float64)
            blobs = [values[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], names=["vec_id", "label", "blob"])

    return rows.mapInArrow(pack, "vec_id long, label string, blob binary")


def met(classes: DataFrame, share: float) -> DataFrame:
    """(label, filter, rep, size, blob, filters): each class in each filter that it passes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(batch.schema.get_field_index("blob")).to_pylist()
            lengths = np.array([len(b) for b in blobs])
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                for at in range(0, len(own), 512):
                    some = own[at : at + 512]
                    lists = passed(units_of([blobs[i] for i in some]), share)
                    take = np.repeat(some, [len(x) for x in lists])
                    part = batch.select(["label", "rep", "size", "blob"]).take(pa.array(take))
                    marks = [x.astype(np.int32).tobytes() for x in lists for _ in x]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(np.concatenate(lists)), *part.columns[1:], pa.array(marks, pa.binary())],
                        names=["label", "filter", "rep", "size", "blob", "filters"],
                    )

    return classes.select("label", "rep", "size", "blob").mapInArrow(
        rows, "label string, filter long, rep long, size long, blob binary, filters binary"
    )


def dealt(rows: DataFrame) -> DataFrame:
    """Rows with the two blocks that meet: both 0 in most filters; a row of a large one goes to all pairs of its block."""
    large = rows.groupBy("label", "filter").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    large = written(large.select("label", "filter", F.ceil(F.col("n") / (BLOCK / 2)).cast("int").alias("blocks")), "large-filters")
    rows = rows.join(small_or_plain(large), ["label", "filter"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("low", F.least("own", "with")).withColumn("high", F.greatest("own", "with")).drop("with", "blocks")


def compared(rows: DataFrame, cosine: float) -> DataFrame:
    """(rep, links, root): for each class and pair of blocks, vectors linked with it that meet it here first, and a class it reaches."""

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in pdf.groupby(pdf["blob"].map(len)):  # vectors of different lengths are not comparable
            group = group.sort_values("rep")
            rep, size, own = (group[c].to_numpy() for c in ("rep", "size", "own"))
            units = units_of(list(group["blob"]))
            linked = units @ units.T >= cosine
            np.fill_diagonal(linked, False)
            if group["low"].iloc[0] != group["high"].iloc[0]:
                linked &= own[:, None] != own[None, :]
            if not linked.any():
                continue
            root = np.arange(len(rep))
            while True:
                least = np.minimum(root, np.where(linked, root[None, :], len(rep)).min(axis=1))
                least = least[least]
                if (least == root).all():
                    break
                root = least
            # a pair counts in the first filter that both pass
            lists = [np.frombuffer(x, dtype=np.int32) for x in group["filters"]]
            here = group["filter"].iloc[0]
            codes, owner = np.concatenate(lists), np.repeat(np.arange(len(rep)), [len(x) for x in lists])
            names, place, times = np.unique(codes, return_inverse=True, return_counts=True)
            use = (names < here) & (times > 1)
            column = np.cumsum(use) - 1
            marks = np.zeros((len(rep), int(use.sum())), dtype=np.float32)
            mine = use[place]
            marks[owner[mine], column[place[mine]]] = 1
            first = linked & (marks @ marks.T == 0)
            out.append(pd.DataFrame({"rep": rep, "links": first @ size, "root": rep[root]})[linked.any(axis=1)])
        return pd.concat(out) if out else pd.DataFrame({"rep": [], "links": [], "root": []}, dtype="int64")

    return rows.groupBy("label", "filter", "low", "high").applyInPandas(links, "rep long, links long, root long")


def near_vectors(
    vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``.

    Vectors of equal label are linked where their cosine, in double precision, is at least ``cosine``; no pair below it is.
    Equal vectors are one class and are linked with each other without comparing them. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest id reachable, ``kept`` marks the rows that have it. Rows without label, vector
    or id, with a zero vector or a component that is NULL or not finite link with nothing; vectors of different lengths do not
    link. A row without id has no component and is kept. Repeated rows are equal vectors; each counts the others. Each row goes
    by its own vector, so rows of one id with different vectors are linked only if these are. An empty
    table gives an empty result; other columns are not read.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v")
    )
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    nonzero = F.exists("v", lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & nonzero, F.lit(False))
    good = packed(rows.where(usable)).withColumn("digest", F.sha2("blob", 256)).withColumn("row", F.monotonically_increasing_id())
    good = written(good, "vectors")
    sizes = good.groupBy("label", "digest").agg(F.min("row").alias("rep"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"))
    sizes = written(sizes, "vector-classes")
    largest = sizes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    classes = good.join(sizes.select("rep", "size"), F.col("row") == F.col("rep"))
    found = written(compared(dealt(met(classes, filter_share(largest))), cosine), "vector-links")
    labels = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), "vector-components")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    labels = labels.select(F.col("node").alias("rep"), F.col("component").alias("root"))
    smallest = sizes.join(labels, "rep").groupBy("root").agg(F.min("least").alias("component"))
    labels = labels.join(small_or_plain(written(smallest, "vector-component-ids")), "root")
    facts = sizes.join(counts, "rep", "left").join(labels, "rep", "left")
    facts = facts.select(
        F.col("label").alias("l"),
        F.col("digest").alias("d"),
        (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "least").alias("component"),
    )
    keyed = good.drop("blob", "row").join(facts, (F.col("label") == F.col("l")) & (F.col("digest") == F.col("d")))
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component"))
    every = keyed.select("vec_id", "n_links", "component").union(alone)
    return every.select(
        "vec_id", "n_links", F.col("component").alias("component_id"), F.coalesce(F.col("component") == F.col("vec_id"), F.lit(True)).alias("kept")
    )
