"""Yearly ZIP archives: listing, unpacking and reading their XML."""

from __future__ import annotations

import hashlib
import re
import zipfile
from collections.abc import Callable, Iterator
from typing import BinaryIO
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.schemas import PDV_ELEMENT, STATION_ATTRIBUTES
from tarifa.session import bound_batches

# Root and record tags, and the name pattern "<label>_<year>_<label>_<day>.zip".
ROOT_TAG = "pdv_liste"
RECORD_TAG = "pdv"
NAME_PATTERN = r"(?i)_(\d{4})_[^_/]+_(\d{8})\.zip$"

BLOCK_BYTES = 1 << 20
BATCH_CHARS = 1 << 20
# What every record carries of its archive: lineage needs no join later.
ORIGIN = ["source_file", "annee", "sha256"]
UNPACKED = "source_file string, annee int, sha256 string, ordinal bigint, element string"
# A record without children: its tag must be cut with quotes respected.
EMPTY_RECORD = re.compile(rb"""<pdv(?:[^>"']|"[^"]*"|'[^']*')*>""")


class SourceError(ValueError):
    """An archive does not have the expected shape."""


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path``, one row each. Contents are only read where the column is used, up to 2 GiB a file."""
    return spark.read.format("binaryFile").load(path)


def source_hash(content: Column) -> Column:
    """Hex sha256 of the archive, kept as load lineage."""
    return F.sha2(content, 256)


def source_file(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _origin() -> list[Column]:
    name = source_file(F.col("path"))
    return [
        name.alias("source_file"),
        F.regexp_extract(name, NAME_PATTERN, 1).cast("int").alias("annee"),
        source_hash(F.col("content")).alias("sha256"),
    ]


def archive_manifest(archives: DataFrame) -> DataFrame:
    """Year and download day from each name, with hash and size."""
    day = F.regexp_extract(source_file(F.col("path")), NAME_PATTERN, 2)
    return archives.select(
        *_origin(), F.to_date(day, "yyyyMMdd").alias("jour"), F.col("length").alias("octets")
    )


def record_slices(stream) -> Iterator[str]:
    """Text of each record, found by a streaming parser; memory holds one record and one block."""
    parser = expat.ParserCreate()
    state = {"root": False, "start": None, "base": 0, "encoding": "utf-8"}
    blocks: list[bytes] = []  # what an open record needs; joined once, when it ends
    found: list[bytes] = []

    def buffered() -> bytes:
        if len(blocks) > 1:
            blocks[:] = [b"".join(blocks)]
        return blocks[0]

    def declaration(version, encoding, standalone):
        state["encoding"] = encoding or "utf-8"

    def opened(tag, attributes):
        if not state["root"]:
            if tag != ROOT_TAG:
                raise SourceError(f"root tag <{tag}> instead of <{ROOT_TAG}>")
            state["root"] = True
        elif tag == RECORD_TAG:
            state["start"] = parser.CurrentByteIndex
            # Nothing inside a record is looked at here, which halves the calls from the parser.
            parser.StartElementHandler = None

    def closed(tag):
        if tag != RECORD_TAG:
            return
        parser.StartElementHandler = opened
        buffer, base, start = buffered(), state["base"], state["start"]
        here = parser.CurrentByteIndex
        if here == start:
            end = EMPTY_RECORD.match(buffer, start - base).end()
        else:
            end = buffer.index(b">", here - base) + 1
        found.append(buffer[start - base : end])
        state["start"] = None

    parser.XmlDeclHandler = declaration
    parser.StartElementHandler = opened
    parser.EndElementHandler = closed
    try:
        while True:
            block = stream.read(BLOCK_BYTES)
            blocks.append(block)
            parser.Parse(block, not block)
            for record in found:
                yield record.decode(state["encoding"])
            found.clear()
            # Keep what an open record, or a tag cut by the block's end, still needs.
            done = parser.CurrentByteIndex if state["start"] is None else state["start"]
            if done > state["base"]:
                blocks[:] = [buffered()[done - state["base"] :]]
                state["base"] = done
            if not block:
                return
    finally:
        # Parser and handlers refer to each other; the blocks would stay until the collector runs.
        parser.XmlDeclHandler = parser.StartElementHandler = parser.EndElementHandler = None
        blocks.clear()
        found.clear()


def archive_records(file: BinaryIO) -> Iterator[str]:
    with zipfile.ZipFile(file) as archive:
        names = [name for name in archive.namelist() if name.lower().endswith(".xml")]
        if len(names) != 1:
            raise SourceError(f"{len(names)} XML files in the archive instead of one")
        with archive.open(names[0]) as stream:
            yield from record_slices(stream)


def _record_batch(origin: tuple, first: int, elements: list[str]) -> pa.RecordBatch:
    n = len(elements)
    source, year, digest = origin
    columns = [
        pa.repeat(pa.scalar(source, pa.string()), n),
        pa.repeat(pa.scalar(year, pa.int32()), n),
        pa.repeat(pa.scalar(digest, pa.string()), n),
        pa.array(range(first, first + n), pa.int64()),
        pa.array(elements, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[*ORIGIN, "ordinal", "element"])


def _record_batches(origin: tuple, file: BinaryIO) -> Iterator[pa.RecordBatch]:
    first, elements, size = 0, [], 0
    for element in archive_records(file):
        elements.append(element)
        size += len(element)
        if size >= BATCH_CHARS:
            yield _record_batch(origin, first, elements)
            first, elements, size = first + len(elements), [], 0
    if elements:
        yield _record_batch(origin, first, elements)


def _contents(column: pa.Array) -> Iterator[pa.Buffer]:
    """The bytes of each row as parts of the column's own buffer; a scalar of the column would be a copy."""
    if not len(column):
        return
    _, bounds, data = column.buffers()
    places = memoryview(bounds).cast("q" if pa.types.is_large_binary(column.type) else "i")
    for i in range(column.offset, column.offset + len(column)):
        yield data.slice(places[i], places[i + 1] - places[i])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contents of a batch are read where they lie: no copy of them is made."""
    for batch in batches:
        *origins, contents = batch.columns
        for *origin, content in zip(*(column.to_pylist() for column in origins), _contents(contents)):
            yield from _record_batches(tuple(origin), pa.BufferReader(content))


def open_anywhere(path: str) -> BinaryIO:
    """A seekable stream of a file in a store that Arrow knows (local, HDFS, S3, GCS)."""
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def unpack_files(files: DataFrame, open_file: Callable[[str], BinaryIO] = open_anywhere) -> DataFrame:
    """Like ``unpack_archives`` from paths alone: tasks read the archive as a stream, so its size has no limit."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, name, year in zip(*(column.to_pylist() for column in batch.columns)):
                with open_file(path) as file:
                    digest = hashlib.sha256()
                    while block := file.read(BLOCK_BYTES):
                        digest.update(block)
                    file.seek(0)
                    yield from _record_batches((name, year, digest.hexdigest()), file)

    name, year, _ = _origin()
    # a path per task: reading is the work, and there are few
    return files.select("path", name, year).repartition("path").mapInArrow(unpack, UNPACKED)


def unpack_archives(archives: DataFrame) -> DataFrame:
    """One row per station record of each archive, still as XML text.

    A ZIP cannot be split, so an archive is one task here; the task takes and emits bounded batches.
    Parsing the records is left to Spark's XML functions after ``spread_records``.
    """
    bound_batches(archives.sparkSession)
    return archives.select(*_origin(), "content").mapInArrow(_unpack, UNPACKED)


def spread_records(records: DataFrame) -> DataFrame:
    """Spread the records of each archive over all tasks; the key keeps retried tasks repeatable."""
    return records.repartition("source_file", "ordinal")


def parse_records(records: DataFrame) -> DataFrame:
    """Station attributes and the array of price tags; malformed XML is an error.

    An absent tag gives NULL, an empty one ``""``; surrounding spaces are kept.
    """
    options = {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false"}
    parsed = F.from_xml(F.col("element"), PDV_ELEMENT, options)
    # Attribute names in the XML, in the order of the raw columns.
    attributes = ["_id", "_latitude", "_longitude", "_cp", "_pop"]
    return records.select(*ORIGIN, "ordinal", parsed.alias("p")).select(
        *ORIGIN,
        "ordinal",
        *[F.col(f"p.{a}").alias(name) for a, name in zip(attributes, STATION_ATTRIBUTES)],
        "p.adresse",
        "p.ville",
        "p.prix",
    )


def station_rows(parsed: DataFrame) -> DataFrame:
    return parsed.drop("prix")


def price_rows(parsed: DataFrame) -> DataFrame:
    """One row per price tag with the station's attributes; an empty tag stays as NULLs."""
    return (
        parsed.withColumn("t", F.explode("prix"))
        .drop("prix", "adresse", "ville")
        .select(
            "*",
            F.col("t._id").alias("prix_id"),
            F.col("t._nom").alias("prix_nom"),
            F.col("t._maj").alias("maj"),
            F.col("t._valeur").alias("valeur"),
        )
        .drop("t")
    )


def empty_tags(prices: DataFrame) -> DataFrame:
    """Number of price tags without any attribute, per archive."""
    blank = F.coalesce("prix_id", "prix_nom", "maj", "valeur").isNull()
    return prices.groupBy("source_file").agg(F.count_if(blank).alias("prix_vides"))
