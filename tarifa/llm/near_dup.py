"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document is the set of its distinct word shingles, as 64-bit hashes. Equal sets are one class, found by a digest.
The signature of a class is read in several orders, each a rotation of the same values. All classes are sorted by each
order; neighbours there have the longest common prefixes and are the first candidates. Every candidate is confirmed on
the full sets and confirmed links are contracted.

What the neighbours leave open is settled by region, a run of classes with a common prefix in an order: regions whose
classes are already one component need nothing more. In others all pairs of different components are candidates. A region
that is too large is read deeper, where its classes part by further values, until its parts are small. At the greatest
depth a part that is still large is compared within a window that moves over it. A small sketch of each set drops candidates
that are far from the threshold (over four standard deviations); the others are confirmed on the full sets like the first.

These links make most large regions one component. One that still holds several, or lies at the border of two tasks, is then
compared completely: it is dealt into blocks, each two blocks meet in a task, and the full sets of all their pairs are compared.

With 24 orders, prefixes of 4 values and similarity 0.8 a pair shares no prefix with probability 3e-6.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import (
    WordHasher,
    components,
    mix,
    small_or_plain,
    stream,
    text_groups,
    written,
)

ORDERS, DEPTHS = 24, (4, 6, 9, 14)
VALUES = ORDERS * DEPTHS[0]
#: Classes of a region that are compared with each other; larger regions are read deeper.
REGION = 64
#: Classes of a block where a region is compared completely, and shingles of its sets together.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
#: Columns of the matrix by which common shingles are counted.
COLUMNS = 4096
#: Bins of a sketch, and standard deviations below the threshold at which a pair is no candidate any more.
BINS, DEVIATIONS = 192, 4.2

SEPARATORS = [9, 10, 11, 12, 13, 32]
NOT_SEPARATOR = np.array([b not in SEPARATORS for b in range(256)])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct shingles of a word sequence, sorted; a shorter sequence is one shingle, an empty one has none."""
    if not len(words):
        return words
    width = min(size, len(words))
    with np.errstate(over="ignore"):
        total = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for i in range(width):
            total = total * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - width + 1 + i]
        return np.unique(mix(total + np.uint64(width)))


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over the shingles, as 32-bit values."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 1024):
            np.minimum(
                least, np.multiply.outer(factors, shingles[at : at + 1024]).min(axis=1), out=least
            )
    return (least >> np.uint64(32)).astype(np.uint32)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One permutation hashing: of the shingles that fall into a bin the least one, as four bits; 0 is an empty bin."""
    with np.errstate(over="ignore"):
        bins = ((shingles * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)) % np.uint64(BINS)
        marks = np.uint64(1) + ((shingles * np.uint64(0x165667B19E3779F9)) >> np.uint64(32)) % np.uint64(15)
    out = np.zeros(BINS, dtype=np.uint8)
    out[bins[::-1].astype(np.int64)] = marks[::-1]  # shingles are sorted, so the least of a bin is written last
    return out[::2] | (out[1::2] << 4)


def near_enough(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, others: np.ndarray, percent: int) -> np.ndarray:
    """For rows and columns of unpacked sketches: may the similarity reach the threshold?

    The least shingle of a bin of the union is drawn from the union without replacement; it is in both sets with the
    probability of their similarity, and then both sketches hold it.
    """
    equal = ((left[:, None, :] == right[None, :, :]) & (left[:, None, :] > 0)).sum(axis=2)
    drawn = ((left[:, None, :] | right[None, :, :]) > 0).sum(axis=2)
    share = percent / 100
    union = (sizes[:, None] + others[None, :]) / (1 + share)
    spread = drawn * share * (1 - share) * np.maximum(1 - drawn / np.maximum(union, 1), 0.05)
    fits = np.minimum(sizes[:, None], others[None, :]) >= share * np.maximum(sizes[:, None], others[None, :])
    return fits & (equal >= share * drawn - DEVIATIONS * np.sqrt(spread) - 1)


def document_sets(docs: DataFrame, shingle: int, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n, digest, shingles, signature, sketch) of each document and the columns to carry; empty documents have NULL in
    digest to sketch."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NOT_SEPARATOR)
        factors = stream(11, VALUES) | np.uint64(1)
        for batch in batches:
            for start, texts in text_groups(batch.column(1)):
                words, bounds = hasher(texts)
                rows = []
                for i in range(len(texts)):
                    found = shingle_hashes(words[bounds[i] : bounds[i + 1]], shingle)
                    blob = found.tobytes()
                    rows.append(
                        (len(found), hashlib.blake2b(blob, digest_size=16).digest(), blob, signature(found, factors).tobytes(), sketch(found).tobytes())
                        if len(found)
                        else (0, None, None, None, None)
                    )
                n, *blobs = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        pa.array(n, pa.int64()),
                        *(pa.array(x, pa.binary()) for x in blobs),
                        *(c.slice(start, len(texts)) for c in batch.columns[2:]),
                    ],
                    names=["doc_id", "n", "digest", "shingles", "signature", "sketch", *carry],
                )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carry)
    fields = "".join(f", `{c}` {narrow.schema[c].dataType.simpleString()}" for c in carry)
    return narrow.mapInArrow(sets, f"doc_id long, n long, digest binary, shingles binary, signature binary, sketch binary{fields}")


def prefixes(signatures: np.ndarray, order: int) -> list[np.ndarray]:
    """For each depth a 64-bit key of the first values of an order."""
    keys, h = [], np.zeros(len(signatures), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(DEPTHS[-1]):
            h = mix(h + signatures[:, (order * DEPTHS[0] + i) % VALUES].astype(np.uint64) + np.uint64(i + 1))
            if i + 1 in DEPTHS:
                keys.append(h.view(np.int64))
    return keys


KEYS = [f"p{d}" for d in DEPTHS]


def ordered(reps: DataFrame) -> DataFrame:
    """One row per class and order: the order, the prefix keys, the class."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(-1, VALUES)
            for order in range(ORDERS):
                keys = [pa.array(k) for k in prefixes(marks, order)]
                which = pa.array(np.full(len(marks), order, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([which, *keys, batch.column(0)], names=["tree", *KEYS, "rep"])

    fields = ", ".join(f"{k} long" for k in KEYS)
    return reps.select("rep", "signature").mapInArrow(rows, f"tree int, {fields}, rep long")


def with_neighbours(rows: DataFrame) -> DataFrame:
    """Rows that share a prefix with a neighbour in their sorted order; ``other`` is the one before, if it does.

    Rows are range partitioned by the whole key, so that any long run of equal prefixes is split. The first row of a
    task has no neighbour before it; its region is still compared afterwards.
    """
    keys = ["tree", *KEYS, "rep"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the row carried over, and whether it shares a prefix with the row before it
        for batch in batches:
            if not batch.num_rows:
                continue
            tree, prefix, rep = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("tree", KEYS[0], "rep"))
            shared = np.zeros(len(rep), dtype=bool)
            shared[1:] = (tree[1:] == tree[:-1]) & (prefix[1:] == prefix[:-1])
            other = np.zeros(len(rep), dtype=np.int64)
            other[1:] = rep[:-1]
            if last is not None:
                held, alone = last
                shared[0] = held["tree"] == tree[0] and held[KEYS[0]] == prefix[0]
                other[0] = held["rep"]
                if shared[0] and alone:
                    yield pa.RecordBatch.from_pylist([held | {"other": None}], schema=out)
            follows = np.append(shared[1:], False)
            take = np.flatnonzero(shared | follows)
            if len(take):
                rows = batch.take(pa.array(take))
                found = pa.array(other[take], mask=~shared[take])
                yield pa.RecordBatch.from_arrays([*rows.columns, found], schema=out)
            last = batch.slice(len(rep) - 1, 1).to_pylist()[0], not (shared | follows)[-1]

    out = pa.schema([("tree", pa.int32()), *((k, pa.int64()) for k in KEYS), ("rep", pa.int64()), ("other", pa.int64())])
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = ", ".join(f"{k} long" for k in KEYS)
    return (
        rows.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(compare, f"tree int, {fields}, rep long, other long")
    )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; ``sets`` has (rep, digest, shingles)."""

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        found = []
        for x, y in zip(left, right, strict=True):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            found.append(100 * common >= percent * (len(x) + len(y) - common))
        return pd.Series(found, dtype=bool)

    members = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    used = sets.join(small_or_plain(members), "rep", "left_semi")
    side = lambda name, blob: used.select(F.col("rep").alias(name), F.col("shingles").alias(blob))
    joined = pairs.join(side("a", "left"), "a").join(side("b", "right"), "b")
    return joined.where(linked("left", "right")).select("a", "b")


def mixed_runs(values: np.ndarray, component: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """The runs of equal values within [low, high) that hold several components."""
    cut = np.flatnonzero(values[low + 1 : high] != values[low : high - 1]) + low + 1
    starts = np.concatenate([[low], cut])
    own = component[low:high]
    differ = np.minimum.reduceat(own, starts - low) != np.maximum.reduceat(own, starts - low)
    return [*zip(starts[differ].tolist(), np.append(cut, high)[differ].tolist(), strict=True)]


def region_pairs(
    keys: list[np.ndarray], component: np.ndarray, marks: np.ndarray, sizes: np.ndarray, percent: int, low: int, high: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs to confirm in a region: read deeper while it is large, and in overlapping parts at the end."""
    if high - low > REGION and len(keys) > 1:
        runs = mixed_runs(keys[1], component, low, high)
        return [p for r in runs for p in region_pairs(keys[1:], component, marks, sizes, percent, *r)]
    found = []
    for at in range(low, high - 1, REGION):
        end = min(at + 2 * REGION, high)
        to = min(at + REGION, end)
        near = near_enough(marks[at:to], marks[at:end], sizes[at:to], sizes[at:end], percent)
        near &= component[at:to, None] != component[None, at:end]
        i, j = np.nonzero(np.triu(near, 1))
        found.append((i + at, j + at))
    return found


def open_pairs(members: DataFrame, labels: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(a, b, tree, p4): pairs of classes that share a region, are not linked yet, and whose sketches are near enough.

    Rows are range partitioned by the whole key like before, so that large regions are split. A region at the border of two
    tasks is compared in two parts; the first and last region of each task are rows without a pair.
    """
    names = ["tree", *KEYS, "rep", "component", "n", "sketch"]

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.frombuffer(b"".join(batch.column(4).to_pylist()), dtype=np.uint32).reshape(-1, VALUES)
            for order in range(ORDERS):
                keys = [pa.array(k) for k in prefixes(marks, order)]
                which = pa.array(np.full(len(marks), order, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([which, *keys, *batch.columns[:4]], names=names)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        begun = False
        for batch in chain(batches, [None]):
            if batch is not None and not batch.num_rows:
                continue
            parts = [x for x in (held, batch and pa.Table.from_batches([batch])) if x is not None]
            if not parts:
                return
            rows = pa.concat_tables(parts).combine_chunks()
            tree, *keys, rep, component, sizes = (rows.column(c).to_numpy() for c in names[:-1])
            if not begun or batch is None:
                begun, at = True, [0, len(rep) - 1] if batch is None else [0]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.int64())] * 2 + [pa.array(tree[at]), pa.array(keys[0][at])], names=out)
            first = keys[0] + tree  # prefix keys of different orders are different hashes
            whole = len(rep)
            if batch is not None:  # the last region may go on
                whole = int(np.flatnonzero(np.append(True, first[1:] != first[:-1]))[-1])
                held = rows.slice(whole)
            if whole:
                packed = np.frombuffer(b"".join(rows.column("sketch").slice(0, whole).to_pylist()), dtype=np.uint8).reshape(whole, -1)
                marks = np.concatenate([packed & 15, packed >> 4], axis=1)
                runs = mixed_runs(first, component, 0, whole)
                pairs = [p for r in runs for p in region_pairs(keys, component, marks, sizes, percent, *r)]
                if pairs:
                    x, y = rep[np.concatenate([p[0] for p in pairs])], rep[np.concatenate([p[1] for p in pairs])]
                    none = [pa.nulls(len(x), pa.int32()), pa.nulls(len(x), pa.int64())]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), *none], names=out)

    out = ["a", "b", "tree", KEYS[0]]
    docs = reps.join(members.select("rep").distinct(), "rep", "left_semi").join(labels, "rep", "left")
    docs = docs.select("rep", F.coalesce("component", "rep").alias("component"), "n", "sketch", "signature")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = ", ".join(f"{k} long" for k in KEYS)
    rows = docs.mapInArrow(expand, f"tree int, {fields}, rep long, component long, n long, sketch binary")
    order = names[:-3]
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(compare, f"a long, b long, tree int, {KEYS[0]} long").distinct()


def dealt(members: DataFrame, borders: DataFrame, labels: DataFrame, reps: DataFrame) -> DataFrame | None:
    """(tree, p4, low, high, own, rep, component): classes of regions to compare completely, in each pair of their blocks.

    These are the regions of several components that are large or at the border of two tasks; None if there are none.
    """

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint32).reshape(-1, VALUES)
            for order in range(ORDERS):
                which = pa.array(np.full(len(marks), order, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([which, pa.array(prefixes(marks, order)[0]), *batch.columns[:3]], names=names)

    names = ["tree", KEYS[0], "rep", "component", "n"]
    region = names[:2]
    docs = reps.join(members.select("rep").distinct(), "rep", "left_semi").join(labels, "rep", "left")
    docs = docs.select("rep", F.coalesce("component", "rep").alias("component"), "n", "signature")
    rows = docs.mapInArrow(expand, f"tree int, {KEYS[0]} long, rep long, component long, n long")
    facts = rows.groupBy(*region).agg(
        F.count(F.lit(1)).alias("size"), F.min("component").alias("least"), F.max("component").alias("most"), F.max("n").alias("n")
    )
    facts = facts.where("least <> most").join(F.broadcast(borders.withColumn("border", F.lit(True))), region, "left")
    facts = facts.where((F.col("size") > REGION) | F.col("border"))
    fit = F.greatest(F.lit(2), F.least(F.lit(BLOCK), F.floor(BLOCK_SHINGLES / F.col("n"))))
    regions = written(facts.select(*region, F.ceil(F.col("size") / fit).cast("int").alias("blocks")), "open-regions")
    if regions.isEmpty():
        return None
    rows = rows.drop("n").join(small_or_plain(regions), region)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("own", "with")).withColumn("high", F.greatest("own", "with"))
    return written(rows.drop("with", "blocks"), "open-rows")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The number of common values of each two sets."""
    sets = left + right
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    place = np.cumsum(times > 1) - 1
    shared = times[column] > 1
    owner, column = owner[shared], place[column[shared]]
    by_column = np.argsort(column, kind="stable")
    owner, column = owner[by_column], column[by_column]
    common = np.zeros((len(left), len(right)), dtype=np.int64)
    for at in range(0, int(place[-1]) + 1, COLUMNS):
        low, high = np.searchsorted(column, [at, at + COLUMNS])
        marks = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        marks[owner[low:high], column[low:high] - at] = 1
        common += (marks[: len(left)] @ marks[len(left) :].T).astype(np.int64)
    return common


def region_links(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class linked with one of another component in a pair of blocks, and the least class that it reaches there."""

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        rep, component, own = (pdf[c].to_numpy() for c in ("rep", "component", "own"))
        left, right = np.flatnonzero(own == pdf["low"].iloc[0]), np.flatnonzero(own == pdf["high"].iloc[0])
        found = [np.frombuffer(x, dtype=np.uint64) for x in pdf["shingles"]]
        if not len(left) or not len(right) or component.min() == component.max():
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        common = common_counts([found[i] for i in left], [found[i] for i in right])
        size = np.array([len(x) for x in found])
        linked = 100 * common >= percent * (size[left][:, None] + size[right][None, :] - common)
        linked &= component[left][:, None] != component[right][None, :]
        i, j = np.nonzero(linked)
        x, y = left[i], right[j]
        root = np.arange(len(rep))
        while True:
            least = root.copy()
            np.minimum.at(least, x, root[y])
            np.minimum.at(least, y, root[x])
            least = least[least]
            if (least == root).all():
                break
            root = least
        moved = root != np.arange(len(rep))
        return pd.DataFrame({"a": rep[moved], "b": rep[root[moved]]})

    used = small_or_plain(written(rows.select("rep").distinct(), "open-classes"))
    rows = rows.join(sets.join(used, "rep", "left_semi").select("rep", "shingles"), "rep")
    return rows.groupBy("tree", KEYS[0], "low", "high").applyInPandas(links, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``.

    Documents are linked where ``100 * common >= percent * union`` of their distinct shingles; ``component_id`` is the
    smallest doc_id reachable by links, ``kept`` marks the rows that have it. Words are what stands between the ASCII
    separators, A-Z lowered; a text with fewer words than a shingle is one shingle. NULL and empty texts and texts
    without words have 0 shingles and form their own component. Repeated rows are equal texts and so linked; rows that
    repeat the kept doc_id are all kept. Each row goes by its own text, so rows of one doc_id with different texts are
    linked only if their texts are. A row without doc_id links with nothing, has no component and is kept.
    An empty table gives an empty result; other columns of ``docs`` are not read but for those to ``carry``, which follow.
    """
    base = written(document_sets(docs, shingle, id_col, text_col, carry).withColumn("row", F.monotonically_increasing_id()), "sets")
    named = base.where("doc_id is not null and n > 0")
    classes = named.groupBy("digest").agg(F.min("row").alias("rep"), F.min("doc_id").alias("least"))
    reps = named.join(classes.select("rep"), F.col("row") == F.col("rep"))
    reps = written(reps.select("rep", "n", "signature", "sketch"), "signatures")
    members = written(with_neighbours(ordered(reps)), "forest")

    first = members.where("other is not null").select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b"))
    sets = named.select(F.col("row").alias("rep"), "shingles")
    links = written(confirmed(first.where("a <> b").distinct(), sets, percent), "links")
    # these labels only spare comparisons, so a few rounds will do
    labels = written(components(links, rounds=2).withColumnRenamed("node", "rep").groupBy("rep").agg(F.min("component").alias("component")), "labels")
    more = written(open_pairs(members, labels, reps, percent), "open-pairs")
    links = links.union(confirmed(more.where("a is not null").select("a", "b"), sets, percent))
    labels = written(components(links), "labels")
    borders = more.where("a is null").select("tree", KEYS[0]).distinct()
    rows = dealt(members, borders, labels.withColumnRenamed("node", "rep"), reps)
    if rows is not None:
        last = region_links(rows, sets, percent)
        labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(last))

    linked = labels.select(F.col("node").alias("rep"), F.col("component").alias("root"))
    smallest = classes.join(linked, "rep").groupBy("root").agg(F.min("least").alias("component"))
    linked = linked.join(small_or_plain(written(smallest, "component-ids")), "root")
    rep_of = classes.join(linked, "rep", "left").select(F.col("digest").alias("d"), F.coalesce("component", "least").alias("component"))
    joined = base.select("doc_id", "n", "digest", *carry).join(rep_of, F.col("digest") == F.col("d"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        *carry,
    )
