"""Benchmark passages in documents, by a distributed positional inverted index.

The index is partitioned by documents: a shard is a run of documents of bounded size, and holds for each term the
positions of its occurrences in the shard, delta coded. It is written to the shared folder. A search goes to every shard
with a bounded block of phrases: the postings of the rarest term of a phrase in the shard, moved by its offset in the
phrase, are the possible starts; the lists of the next rarer terms are intersected with them until none is left. No list
ever leaves its shard, so a word that is in all documents costs each shard its own share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import WordHasher, text_groups, written

#: Bytes of text in a shard (a longer document is a shard of its own), and distinct phrases sent out at once.
SHARD, PHRASES = 4 << 20, 200_000
#: Terms that are sent to the tasks that build the index (8 bytes each); beyond it all terms are indexed.
TERMS = 4_000_000

CODES = np.arange(256)
WORD_BYTES = ((CODES >= 48) & (CODES <= 57)) | ((CODES >= 97) & (CODES <= 122)) | (CODES >= 128)


def build_index(docs: DataFrame, terms: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written index: (shard, term, postings) and per shard a row that lists its documents instead.

    ``terms`` (sorted 64-bit word hashes) restricts it to the terms that will be searched; ``None`` keeps all.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(WORD_BYTES)
        shard = (TaskContext.get().partitionId() << 32) - 1
        for batch in batches:
            for start, texts in text_groups(batch.column(1), SHARD):
                words, bounds = hasher(texts)
                words = words.view(np.int64)
                place = np.arange(len(words))
                if terms is not None:
                    at = np.minimum(np.searchsorted(terms, words), len(terms) - 1) if len(terms) else place
                    place = np.flatnonzero(terms[at] == words) if len(terms) else place[:0]
                order = place[np.argsort(words[place], kind="stable")]
                found, first = np.unique(words[order], return_index=True)
                blobs = [np.diff(x, prepend=0).astype(np.uint32).tobytes() for x in np.split(order, first[1:])] if len(order) else []
                shard += 1
                ids = batch.column(0).slice(start, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found) + 1, shard)),
                        pa.array([0, *found.tolist()], pa.int64()),
                        pa.array([b"", *blobs], pa.binary()),
                        pa.array([ids.fill_null(0).to_pylist(), *[None] * len(found)], pa.list_(pa.int64())),
                        pa.array([ids.is_valid().to_pylist(), *[None] * len(found)], pa.list_(pa.bool_())),
                        pa.array([bounds, *[None] * len(found)], pa.list_(pa.int64())),
                    ],
                    names=["shard", "term", "postings", "doc_ids", "named", "bounds"],
                )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "shard long, term long, postings binary, doc_ids array<long>, named array<boolean>, bounds array<long>"
    return written(narrow.mapInArrow(shards, schema), "index")


def phrases(items: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(terms, items): the distinct windows of ``width`` words of all items; a shorter item is one window.

    Items without id give windows too but are not listed.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(WORD_BYTES)
        for batch in batches:
            for start, texts in text_groups(batch.column(1)):
                words, bounds = hasher(texts)
                words = words.view(np.int64)
                for i in range(len(texts)):
                    own = words[bounds[i] : bounds[i + 1]]
                    if len(own):
                        size = min(width, len(own))
                        rows = np.lib.stride_tricks.sliding_window_view(own, size)
                        item = [batch.column(0)[start + i].as_py()] * len(rows)
                        yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(list(rows), pa.list_(pa.int64()))], names=["item", "terms"])

    narrow = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    found = narrow.mapInArrow(windows, "item string, terms array<long>").distinct()
    return written(found.groupBy("terms").agg(F.collect_set("item").alias("items")), "phrases")


def exact_starts(lists: list[np.ndarray]) -> np.ndarray:
    """Positions where the terms follow each other; ``lists`` has the postings of each in phrase order."""
    ranks = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    starts = lists[ranks[0]] - ranks[0]
    for i in ranks[1:]:
        if not len(starts):
            break
        wanted = starts + i
        at = np.minimum(np.searchsorted(lists[i], wanted), len(lists[i]) - 1)
        starts = starts[lists[i][at] == wanted]
    return starts


def near_spans(lists: list[np.ndarray], within: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans of at most ``within`` words that start at a term and hold all terms (distinct) in any order."""
    starts = np.unique(np.concatenate(lists))
    ends = starts.copy()
    for own in lists:
        at = np.searchsorted(own, starts)
        there = at < len(own)
        starts, ends, at = starts[there], ends[there], at[there]
        ends = np.maximum(ends, own[at])
    keep = ends - starts < within
    return starts[keep], ends[keep] + 1


def search(index: DataFrame, block: list[tuple[list[int], list[str]]], within: int | None = None) -> DataFrame:
    """(shard, place, doc_id, n_words, spans, items) of every document of the index for one block of phrases.

    ``spans`` are the merged ranges [start, end) of words inside occurrences of a phrase, ``items`` the items that have
    such a phrase. An occurrence is exact, or with ``within`` any span of so many words with all terms of the phrase.
    """
    schema = "shard long, place long, doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"

    def look_up(pdf: pd.DataFrame) -> pd.DataFrame:
        listed = pdf["bounds"].isna()
        directory = pdf[~listed].iloc[0]
        bounds = np.asarray(directory["bounds"], dtype=np.int64)
        postings = {
            int(t): np.cumsum(np.frombuffer(b, dtype=np.uint32), dtype=np.int64)
            for t, b in zip(pdf["term"][listed], pdf["postings"][listed], strict=True)
        }
        starts, ends, which = [], [], []
        for n, (terms, _) in enumerate(block):
            lists = [postings.get(t) for t in (terms if within is None else set(terms))]
            if any(x is None for x in lists):
                continue
            if within is None:
                s = exact_starts(lists)
                e = s + len(terms)
            else:
                s, e = near_spans(lists, within)
            if len(s):
                starts.append(s), ends.append(e), which.append(np.full(len(s), n))
        n_docs = len(bounds) - 1
        spans: list[list] = [[] for _ in range(n_docs)]
        items: list[set] = [set() for _ in range(n_docs)]
        if starts:
            start, end, phrase = np.concatenate(starts), np.concatenate(ends), np.concatenate(which)
            doc = np.searchsorted(bounds, start, side="right") - 1
            inside = end <= bounds[doc + 1]
            start, end, phrase, doc = start[inside], end[inside], phrase[inside], doc[inside]
            for d, p in set(zip(doc.tolist(), phrase.tolist(), strict=True)):
                items[d].update(block[p][1])
            order = np.argsort(start, kind="stable")
            for s, e, d in zip((start - bounds[doc])[order].tolist(), (end - bounds[doc])[order].tolist(), doc[order].tolist(), strict=True):
                if spans[d] and s <= spans[d][-1]["end"]:
                    spans[d][-1]["end"] = max(spans[d][-1]["end"], e)
                else:
                    spans[d].append({"start": s, "end": e})
        ids = pd.arrays.IntegerArray(np.array(directory["doc_ids"], dtype=np.int64), ~np.array(directory["named"], dtype=bool))
        return pd.DataFrame({
            "shard": directory["shard"], "place": np.arange(n_docs), "doc_id": ids,
            "n_words": np.diff(bounds), "spans": spans, "items": [sorted(x) for x in items],
        })

    return index.groupBy("shard").applyInPandas(look_up, schema)


def covered(spans: Column) -> Column:
    """Words inside a list of ranges that may overlap."""
    zero = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, s: Column) -> Column:
        fresh = F.greatest(s["end"] - F.greatest(s["start"], acc["upto"]), F.lit(0).cast("long"))
        return F.struct(F.greatest(acc["upto"], s["end"]).alias("upto"), (acc["n"] + fresh).alias("n"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda acc: acc["n"])


def contamination(
    docs: DataFrame,
    items: DataFrame,
    width: int = 10,
    within: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items) per row of ``docs``; ``spans`` are ranges of words.

    Words are runs of a-z (A-Z lowered), digits and all characters beyond ASCII; they are compared by 64-bit hashes. A
    word is hit inside any occurrence of a window of ``width`` consecutive words of an item. NULL and empty texts have no
    words. Items with equal windows are all reported; items that repeat an item_id count once; the words of those without
    item_id are hit as well, but they are not among ``items``. Repeated documents and those without doc_id each give their row. Without items nothing is hit, an empty
    ``docs`` gives an empty result, and other columns are not read. Phrases go out in blocks of bounded size.
    """
    found = phrases(items, width, item_col, item_text)
    total = found.count()
    blocks = max(1, -(-total // PHRASES))
    vocabulary = found.select(F.explode("terms").alias("term")).distinct()
    terms = None
    if blocks == 1 or vocabulary.count() <= TERMS:
        terms = np.sort(np.array([r.term for r in vocabulary.toLocalIterator()], dtype=np.int64))
    index = build_index(docs, terms, id_col, text_col)
    results = None
    for k in range(blocks):
        part = found.where(F.pmod(F.xxhash64("terms"), F.lit(blocks)) == k).collect()
        rows = search(index, [(list(r["terms"]), list(r["items"])) for r in part], within)
        results = rows if results is None else results.union(rows)
    if blocks > 1:
        results = results.groupBy("shard", "place").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
    return results.select("doc_id", "n_words", covered(F.col("spans")).alias("n_hit"), "spans", F.array_sort("items").alias("items"))
