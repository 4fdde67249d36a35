"""Divergence of the sources of a language, over the vocabulary that the language keeps.

A first pass counts in how many documents of a language each term stands. The kept terms are sorted, and each range of them
becomes a minimal acyclic transducer, whose path weights give a term's place in the order of all terms of its language. A second
pass streams the texts through the transducers and counts places instead of terms; ties are settled by place.

The transducers are held by every task while all of them take ``TABLE_BYTES`` at most. A larger vocabulary stays distributed:
the distinct terms of a batch go to the task of their range, which reads its transducer first and then streams them.

Pairs of sources are compared in blocks of places and of sources. A block goes through the occurring places of each source
only; places where both sources have nothing are counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarifa.llm import transducer
from tarifa.llm.common import small_or_plain, written

#: Bytes of transducers that a task may hold, and terms of a transducer.
TABLE_BYTES, PART_TERMS = 1 << 25, 1 << 18
#: Bytes of text that are cut into tokens at once; one longer text is cut on its own.
SLICE = 1 << 21
#: Counts that a task merges before it hands them on.
HELD = 1 << 20
#: Places and sources of a block of comparisons, and tasks that share a range of a large vocabulary.
PLACES, SOURCES, SALTS = 2048, 64, 8
SCALE = 1_000_000_000
GROUP = ["lang", "source"]


def sliced(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """The texts of a batch in slices of about ``SLICE`` bytes, with the number of the first one."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64)
    block = np.concatenate([[0], np.cumsum(sizes)[:-1] // SLICE]) if len(sizes) else np.zeros(0, dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(block[: len(sizes)])) + 1).tolist(), len(sizes)]
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        if end > start:
            yield start, column.slice(start, end - start)


def coded(batch: pa.RecordBatch, names: list[str]) -> tuple[np.ndarray, list[tuple]]:
    """A number for the group of each row, and the groups."""
    rows = list(zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names], strict=True))
    known: dict[tuple, int] = {}
    return np.array([known.setdefault(r, len(known)) for r in rows], dtype=np.int64), list(known)


def merged(parts: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The counts ``n`` of parts added up by their keys, in pieces that a task can hold."""
    held: list[pa.RecordBatch] = []

    def added() -> pa.Table:
        sums = pa.Table.from_batches(held).group_by(keys, use_threads=False).aggregate([("n", "sum")])
        return sums.rename_columns([*keys, "n"]).combine_chunks()

    for part in parts:
        held.append(part)
        if sum(map(len, held)) > HELD:
            sums = added()
            if len(sums) > HELD // 2:
                yield from sums.to_batches(max_chunksize=1 << 16)
                held = []
            else:
                held = sums.to_batches()
    if held:
        yield from added().to_batches(max_chunksize=1 << 16)


def counted(names: list[str], once: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Terms of each group of the texts of a task with their number of occurrences, or of documents, if ``once``."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, groups = coded(batch, names)
            for first, part in sliced(batch.column(batch.schema.get_field_index("text"))):
                data, _, sizes, owner = transducer.tokens(part)
                words = transducer.token_strings(data, sizes).dictionary_encode()
                place, width = words.indices.to_numpy().astype(np.int64), max(1, len(words.dictionary))
                if once:
                    pairs = np.unique(owner * width + place)
                    owner, place = pairs // width, pairs % width
                keys, n = np.unique(codes[first + owner] * width + place, return_counts=True)
                group = keys // width
                columns = [pa.array([groups[g][i] for g in group.tolist()], pa.string()) for i in range(len(names))]
                terms = words.dictionary.take(pa.array(keys % width)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*columns, terms, pa.array(n.astype(np.int64))], names=[*names, "term", "n"])

    return lambda batches: merged(parts(batches), [*names, "term"])


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """(lang, term): the terms that stand in at least so many documents of the language."""
    found = docs.select("lang", "text").mapInArrow(counted(["lang"], once=True), "lang string, term string, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("lang", "term")


def transducers(terms: DataFrame) -> DataFrame:
    """(lang, first, n_terms, packed, base): transducers over ranges of the sorted terms, base being the place of the first one."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed() -> pa.RecordBatch:
            packed = transducer.built(t.encode() for t in held)
            row = {"lang": [now], "first": [held[0]], "n_terms": [len(held)], "packed": [packed]}
            return pa.RecordBatch.from_pydict(row, pa.schema([("lang", pa.string()), ("first", pa.string()), ("n_terms", pa.int64()), ("packed", pa.binary())]))

        held: list[str] = []
        now = None
        for batch in batches:
            for lang, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (lang != now or len(held) >= PART_TERMS):
                    yield closed()
                    held = []
                now = lang
                held.append(term)
        if held:
            yield closed()

    ordered = terms.select("lang", "term").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    parts = written(ordered.mapInArrow(build, "lang string, first string, n_terms long, packed binary"), "transducers")
    # one row for each PART_TERMS terms
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("lang", "first", F.coalesce(F.sum("n_terms").over(before), F.lit(0)).alias("base"))
    return parts.join(bases, ["lang", "first"])


def numbered(terms: DataFrame, parts: DataFrame) -> DataFrame:
    """``terms`` (lang, source, term, n) with their place; terms that are not kept go.

    Each term goes to the task of its range. There the transducer of the range comes first in the order of the rows, and the
    terms are streamed through it.
    """
    firsts: dict[str, list[bytes]] = {}
    for row in parts.select("lang", "first").orderBy("lang", "first").toLocalIterator():  # one row for each PART_TERMS terms
        firsts.setdefault(row["lang"], []).append(row["first"].encode())

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, words = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            part = [transducer.part_of(firsts[a], w.encode()) if a in firsts else -1 for a, w in zip(langs, words, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32())], names=["lang", "source", "term", "n", "part"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, lang = None, None
        for batch in batches:
            heads = [i for i, ok in enumerate(batch.column(6).is_valid().to_pylist()) if ok]
            cuts = [0, *heads, len(batch)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                rows = batch.slice(start, end - start)
                if start in heads and len(rows):
                    lang = rows.column(0)[0].as_py()
                    table = transducer.Transducers([(lang, "", rows.column(5)[0].as_py(), rows.column(6)[0].as_py())])
                    rows = rows.slice(1)
                if not len(rows):
                    continue
                words = rows.column(2).cast(pa.large_binary())
                bounds = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
                data = np.frombuffer(words.buffers()[2], dtype=np.uint8)
                place = table.places(lang, data, bounds[:-1], np.diff(bounds))
                hit = pa.array(place >= 0)
                found = [rows.column(i).filter(hit) for i in range(4)]
                yield pa.RecordBatch.from_arrays([*found, pa.array(place[place >= 0])], names=["lang", "source", "term", "n", "place"])

    routed = terms.select("lang", "source", "term", "n").mapInArrow(route, "lang string, source string, term string, n long, part int")
    routed = routed.where("part >= 0").withColumn("salt", F.pmod(F.xxhash64("source", "term"), F.lit(SALTS)).cast("int"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy("first")) - 1
    heads = parts.withColumn("part", order).select(
        "lang", F.lit("").alias("source"), F.lit("").alias("term"), F.lit(0).cast("long").alias("n"), "part", "base", "packed",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    none = [F.lit(None).cast("long").alias("base"), F.lit(None).cast("binary").alias("packed")]
    rows = heads.union(routed.select("lang", "source", "term", "n", "part", *none, "salt"))
    rows = rows.repartition("lang", "part", "salt").sortWithinPartitions("lang", "part", "salt", F.col("packed").isNull())
    return rows.drop("salt").mapInArrow(stream, "lang string, source string, term string, n long, place long")


def recounted(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """(lang, source, place, n): occurrences of the kept terms of a language in each of its sources."""
    size = parts.agg(F.sum(F.length("packed"))).first()[0] or 0
    if size > TABLE_BYTES:
        words = docs.select(*GROUP, "text").mapInArrow(counted(GROUP, once=False), "lang string, source string, term string, n long")
        places = numbered(words, parts)
    else:
        held = [(r["lang"], r["first"], r["base"], bytes(r["packed"])) for r in parts.collect()]  # TABLE_BYTES at most

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = transducer.Transducers(held)
            for batch in batches:
                codes, groups = coded(batch, GROUP)
                for first, part in sliced(batch.column(2)):
                    data, starts, sizes, owner = transducer.tokens(part)
                    code = codes[first + owner]
                    place = np.full(len(starts), -1, dtype=np.int64)
                    langs = np.array([g[0] for g in groups], dtype=object)
                    for lang in set(langs.tolist()):
                        own = np.flatnonzero((langs == lang)[code])
                        place[own] = table.places(lang, data, starts[own], sizes[own])
                    order = np.lexsort((place, code))
                    order = order[place[order] >= 0]
                    place, code = place[order], code[order]
                    new = np.flatnonzero(np.diff(place, prepend=-1) | np.diff(code, prepend=-1))
                    n = np.diff(new, append=len(place))
                    names = [pa.array([groups[g][i] for g in code[new].tolist()], pa.string()) for i in range(2)]
                    yield pa.RecordBatch.from_arrays([*names, pa.array(place[new]), pa.array(n.astype(np.int64))], names=[*GROUP, "place", "n"])

        places = docs.select(*GROUP, "text").mapInArrow(lambda batches: merged(stream(batches), [*GROUP, "place"]), "lang string, source string, place long, n long")
    return places.groupBy(*GROUP, "place").agg(F.sum("n").alias("n"))


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exactly."""
    return F.expr(
        f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(20,0)) div CAST({total} + 2 * {terms} AS DECIMAL(20,0)) + 1"
    )


def gap(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def block_pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums over a block of places for all pairs of a low and a high source. A row without place gives a source and its least share."""
    base = pdf[pdf["place"] < 0].sort_values("number")
    number, none, size = base["number"].to_numpy(), base["p"].to_numpy(), int(base["size"].iloc[0])
    rows = pdf[pdf["place"] >= 0]
    at, column = np.searchsorted(number, rows["number"].to_numpy()), rows["place"].to_numpy() % PLACES
    share_of = np.repeat(none[:, None], PLACES, axis=1)
    share_of[at, column] = rows["p"].to_numpy()
    has = np.zeros(share_of.shape, dtype=bool)
    has[at, column] = True
    met, alone = np.zeros((2, len(number), len(number)), dtype=np.int64)
    for i in range(len(number)):
        use = np.flatnonzero(has[i])
        value = gaps(share_of[i, use][None, :], share_of[:, use])
        met[i] = value.sum(axis=1)
        alone[i] = np.where(has[:, use], 0, value).sum(axis=1)
    both = has.astype(np.float32) @ has.T.astype(np.float32)  # counts up to PLACES are exact
    either = has.sum(axis=1)[:, None] + has.sum(axis=1)[None, :] - both.astype(np.int64)
    value = met + alone.T + (size - either) * gaps(none[:, None], none[None, :])
    low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
    side = number // SOURCES
    a, b = np.nonzero((number[:, None] < number[None, :]) & (side[:, None] == low) & (side[None, :] == high))
    return pd.DataFrame({"lang": pdf["lang"].iloc[0], "a": number[a], "b": number[b], "value": value[a, b]})


def source_pairs(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, item, value): all ordered pairs of sources of a language. ``groups`` has number, p0, terms and sources."""
    sides = F.ceil(F.col("sources") / SOURCES).cast("int") - 1
    own = F.floor(F.col("number") / SOURCES).cast("int")
    blocks = F.greatest(F.ceil(F.col("terms") / PLACES), F.lit(1)).cast("long")
    facts = groups.select(*GROUP, "number", "p0", "terms", "total", own.alias("own"), sides.alias("last"))
    base = facts.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).select(
        "lang", "block", "number", F.lit(-1).cast("long").alias("place"), F.col("p0").alias("p"),
        F.least(F.lit(PLACES).cast("long"), F.col("terms") - F.col("block") * PLACES).alias("size"), "own", "last",
    )
    rows = counts.join(small_or_plain(facts), GROUP).select(
        "lang", F.floor(F.col("place") / PLACES).alias("block"), "number", "place", share("n", "total", "terms").alias("p"),
        F.lit(0).cast("long").alias("size"), "own", "last",
    )
    dealt = base.union(rows).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("last"))))
    dealt = dealt.withColumn("low", F.least("own", "with")).withColumn("high", F.greatest("own", "with")).drop("own", "last", "with")
    sums = dealt.groupBy("lang", "block", "low", "high").applyInPandas(block_pairs, "lang string, a long, b long, value long")
    sums = written(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "source-pairs")
    both = sums.union(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", "number", "source")
    one = small_or_plain(names.withColumnRenamed("number", "a"))
    two = small_or_plain(names.select("lang", F.col("number").alias("b"), F.col("source").alias("item")))
    return both.join(one, ["lang", "a"]).join(two, ["lang", "b"]).select(*GROUP, "item", "value")


def source_terms(groups: DataFrame, counts: DataFrame, terms: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank): terms that a source has more of than its language, the widest gaps first."""
    totals = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    own = counts.join(small_or_plain(groups.select(*GROUP, "total", "terms")), GROUP).join(small_or_plain(totals), "lang")
    overall = counts.groupBy("lang", "place").agg(F.sum("n").alias("lang_n"))
    met = own.join(overall, ["lang", "place"]).select(
        *GROUP, "place", share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q")
    )
    ahead = met.where("p > q").select(*GROUP, "place", gap("p", "q").alias("value"))
    rank = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "place"))
    best = ahead.withColumn("rank", rank).where(F.col("rank") <= top)
    best = written(best, "source-terms")
    return terms.select("lang", "place", "term").join(small_or_plain(best), ["lang", "place"]).select(*GROUP, F.col("term").alias("item"), "value", "rank")


def audit(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from the others, and by which terms.

    NULL text, lang and source are empty strings, which form a language and a source like any other. A language keeps the terms
    that stand in ``least`` of its documents; a repeated document counts each time. Part ``pair`` has a row for every other
    source of the language, part ``term`` the ``top`` kept terms of which the source has more than the language. A source
    without terms, a language without kept terms (all pairs are 0) and texts of any length are covered; ties go by the bytes of
    the item. An empty table gives an empty result; other columns are not read.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = written(kept_terms(docs, least), "kept-terms")
    parts = written(transducers(kept), "placed-transducers")
    terms = numbered(kept.select("lang", F.lit("").alias("source"), "term", F.lit(1).cast("long").alias("n")), parts)
    counts = written(recounted(docs, parts), "term-places")
    sizes = parts.groupBy("lang").agg(F.sum("n_terms").alias("terms"))
    totals = counts.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    groups = docs.select(*GROUP).distinct().join(totals, GROUP, "left").join(sizes, "lang", "left")
    groups = groups.fillna(0, ["total", "terms"])
    # a language without terms has no shares; any number but 0 below the line will do
    p0 = F.when(F.col("terms") > 0, share("0", "total", "terms")).otherwise(1)
    by_lang = Window.partitionBy("lang")
    number = (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long")
    groups = written(groups.select("*", p0.alias("p0"), number.alias("number"), F.count(F.lit(1)).over(by_lang).alias("sources")), "source-groups")
    pairs = source_pairs(groups, counts)
    rank = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item"))
    pairs = pairs.select(*GROUP, F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
    best = source_terms(groups, counts, terms, top)
    return pairs.union(best.select(*GROUP, F.lit("term").alias("part"), "item", "value", "rank"))
