"""WARC archives: written with one record per page, read back by boundary-chain verification.

Spark writes the archives as text whose line separator is the end of a record, and reads them as text whose line separator
is the magic of a record, so that file splits, retries and any store that Spark knows come with it. What stands between two
magics is a candidate record: its header says where its successor starts. Payloads may hold the magic too; only candidates
on the chain of successors from the start of a file are records.

The chain is followed in two levels. The task of a split follows it inside, and emits for each candidate the first
successor beyond the split. Pointer jumping over these finds the first true record of each split in a logarithmic number
of rounds. With it a second pass cuts the records; one that reaches into further splits is put together from its pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import ceil, log2

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarifa.llm.common import BROADCAST_ROWS, written
from tarifa.session import scratch_folder

MAGIC = "WARC/1."
END = "\r\n\r\n"
LENGTH = re.compile(rb"\r\nContent-Length: *(\d+) *(?:\r\n|$)", re.IGNORECASE)
#: Fewer bytes are not worth a revisit record.
LEAST = 100
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def page_records(pages: DataFrame, date: str, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(value) the text of a record of each page without its end.

    Of equal payloads of at least ``LEAST`` bytes the smallest id is the response; rows without id are always responses. The
    table of repeated digests is broadcast where its size allows, so that payloads are not shuffled.
    """
    payload = F.coalesce(html_col, F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(url_col, F.lit("")).alias("url"),
        payload.alias("payload"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
    )
    long = F.octet_length("payload") >= LEAST
    repeated = rows.where(long).groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    repeated = written(repeated.select("digest", "first"), "repeated-payloads")
    if repeated.count() <= BROADCAST_ROWS // 4:
        repeated = F.broadcast(repeated)
    rows = rows.join(repeated, "digest", "left")
    revisit = F.coalesce(long & (F.col("id") > F.col("first")), F.lit(False))
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), "payload"))
    clean = F.col("url")
    for found, put in [("\r", "%0D"), ("\n", "%0A"), (" ", "%20"), (MAGIC, MAGIC.replace("/", "%2F"))]:
        clean = F.replace(clean, F.lit(found), F.lit(put))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"\r\n{name}: "), value)

    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    return rows.select(
        F.concat(
            F.lit(f"{MAGIC}1"),
            line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            line("WARC-Record-ID", urn("id")),
            line("WARC-Date", F.lit(date)),
            line("WARC-Target-URI", clean),
            line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
            line("X-Payload-Length", F.octet_length("payload").cast("string")),
            F.when(revisit, F.concat(line("WARC-Refers-To", urn("first")), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
            line("Content-Type", F.lit("application/http; msgtype=response")),
            line("Content-Length", F.octet_length(block).cast("string")),
            F.lit(END),
            block,
        ).alias("value")
    )


def write_archives(
    pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> None:
    """A folder of WARC files of the pages; NULL pages are empty payloads, control characters in addresses are escaped."""
    page_records(pages, date, id_col, url_col, html_col).write.option("lineSep", END).text(folder)


def chunks(spark: SparkSession, folder: str) -> DataFrame:
    """(file, block, value): what stands before, between and after magics, in order within each split of a file."""
    read = spark.read.option("lineSep", MAGIC).text(folder)
    return read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )


def span_of(chunk: bytes) -> int:
    """Bytes from the magic of a candidate to its successor, or 0 if it has no header."""
    end = chunk.find(b"\r\n\r\n")
    length = LENGTH.search(chunk, 0, end) if end >= 0 and chunk[1:3] == b"\r\n" else None
    return len(MAGIC) + end + 4 + int(length[1]) + 4 if length else 0


def split_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[bytes]]]:
    """The chunks of a task by split."""

    def rows() -> Iterator[tuple[tuple[str, int], bytes]]:
        for batch in batches:
            for file, block, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield (file, block), value

    every = rows()
    held = next(every, None)
    while held is not None:
        key = held[0]

        def own() -> Iterator[bytes]:
            nonlocal held
            while held is not None and held[0] == key:
                yield held[1]
                held = next(every, None)

        yield key, own()


def split_chains(found: DataFrame) -> DataFrame:
    """(file, block, size, starts, exits) per split: its bytes, the candidates in it, and where the chain from each leaves it.

    Offsets count from the end of the magic before the first chunk of the split; a chain that breaks inside has no exit.
    """

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), own in split_rows(batches):
            starts, ends, at = [], [], 0
            for value in own:
                span = span_of(value)
                if span:
                    starts.append(at - len(MAGIC))
                    ends.append(at - len(MAGIC) + span)
                at += len(value) + len(MAGIC)
            # the first magic after the split begins at `at` less its length; from there on chains have left
            exits, exit_of = [0] * len(starts), {}
            for i in range(len(starts) - 1, -1, -1):
                exits[i] = ends[i] if ends[i] >= at - len(MAGIC) else exit_of.get(ends[i])
                exit_of[starts[i]] = exits[i]
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block]), pa.array([at]), pa.array([starts], pa.list_(pa.int64())), pa.array([exits], pa.list_(pa.int64()))],
                names=["file", "block", "size", "starts", "exits"],
            )

    return found.mapInArrow(follow, "file string, block long, size long, starts array<long>, exits array<long>")


def verified_splits(found: DataFrame) -> DataFrame:
    """(file, block, base, entry, following): where each split starts in its file, its first true record if it has one, and
    the first true record after it (or the end of the file). Files whose chain does not end with them are an error."""
    splits = written(split_chains(found), "warc-splits")
    order = Window.partitionBy("file").orderBy("block")  # a row per split: few per file
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.withColumn("base", F.coalesce(before, F.lit(0)))
    ends = splits.groupBy("file").agg((F.sum("size") - len(MAGIC)).alias("length"), F.count(F.lit(1)).alias("splits"))
    pointers = splits.select("file", "block", "base", F.explode(F.arrays_zip("starts", "exits")).alias("p"))
    pointers = written(
        pointers.select("file", "block", (F.col("base") + F.col("p.starts")).alias("at"), (F.col("base") + F.col("p.exits")).alias("to")), "warc-pointers"
    )
    reached = ends.select("file", F.lit(0).cast("long").alias("at"))
    jump = pointers.select("file", "at", "to").where("to is not null")
    most = ends.agg(F.max("splits")).first()[0] or 1
    for _ in range(ceil(log2(most)) + 1):
        step = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = written(reached.union(step).distinct(), "warc-reached")
        further = jump.select("file", F.col("at").alias("to"), F.col("to").alias("then"))
        jump = written(jump.join(further, ["file", "to"]).select("file", "at", F.col("then").alias("to")), "warc-jumps")
    broken = ends.where("length > 0").join(reached, (ends["file"] == reached["file"]) & (F.col("at") == F.col("length")), "left_anti").count()
    if broken:
        raise ValueError(f"{broken} archives are damaged: their chain of records does not reach their end")
    entries = pointers.join(reached, ["file", "at"]).groupBy("file", "block").agg(F.min("at").alias("entry"))
    known = splits.select("file", "block", "base").join(entries, ["file", "block"], "left").join(ends.select("file", "length"), "file")
    after = F.first("entry", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    return known.select("file", "block", "base", "entry", F.coalesce(after, "length").alias("following"))


FIELDS = "file string, offset long, record_type string, page_id long, url string, refers_to long, payload_bytes long, payload_digest string, intact boolean, payload binary"
ID = re.compile(rb"<urn:page:(-?\d+)>")


def parsed(file: str, offset: int, record: bytes, with_payload: bool) -> dict:
    """A record without its magic and end."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip()
    payload = block.partition(b"\r\n\r\n")[2] if b"application/http" in fields.get(b"content-type", b"") else block
    kind = fields.get(b"warc-type", b"").decode("utf-8", "replace")
    digest = hashlib.sha256(payload).hexdigest()
    size = len(payload)
    stated = fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha256:")
    intact = stated == digest
    if kind == "revisit":  # the payload is elsewhere; the record states its digest and length
        digest, size, intact = stated, int(fields.get(b"x-payload-length", b"0")), len(stated) == 64
    number = lambda name: int(m[1]) if (m := ID.search(fields.get(name, b""))) else None
    return {
        "file": file, "offset": offset, "record_type": kind, "page_id": number(b"warc-record-id"),
        "url": fields.get(b"warc-target-uri", b"").decode("utf-8", "replace"), "refers_to": number(b"warc-refers-to"),
        "payload_bytes": size, "payload_digest": digest, "intact": intact, "payload": payload if with_payload and kind != "revisit" else None,
    }


SCHEMA = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("intact", pa.bool_()), ("payload", pa.binary()),
])
PIECE = pa.schema([*SCHEMA, ("until", pa.int64()), ("at", pa.int64()), ("piece", pa.binary())])


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of a folder of WARC files: (file, offset, record_type, page_id, url, refers_to, payload_bytes,
    payload_digest, intact, payload).

    Digest and length of a response come from its bytes, those of a revisit from its header; ``intact`` tells whether they
    agree with the header. An empty folder gives no records; a file whose records do not fill it is an error.
    """
    found = chunks(spark, folder)
    splits = written(verified_splits(found), "warc-verified")
    known = {(r["file"], r["block"]): (r["base"], r["entry"], r["following"]) for r in splits.toLocalIterator()}  # a few numbers per 128 MB
    places = spark.sparkContext.broadcast(known)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []

        def batch_of() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_pylist(out, schema=PIECE)
            out.clear()
            return rows

        size = 0
        for key, own in split_rows(batches):
            base, entry, following = places.value[key]
            # the open record: its offset (None if it began in an earlier split), its end, its pieces
            offset, until, pieces = None, entry if entry is not None else following, []
            at = base
            for value in own:
                start = at - len(MAGIC)
                if start == until:
                    if pieces:
                        if offset is None:
                            out.append({"file": key[0], "until": until, "at": first, "piece": MAGIC.encode().join(pieces)})
                        else:
                            out.append(parsed(key[0], offset, MAGIC.encode().join(pieces)[:-4], with_payload))
                    offset, until, pieces = start, start + span_of(value), []
                if not pieces:
                    first = start
                if start >= 0:  # what stands before the first magic of a file is no record
                    pieces.append(value)
                    size += len(value)
                at += len(value) + len(MAGIC)
                if size > 1 << 22:
                    yield batch_of()
                    size = 0
            if pieces and offset is not None and until == at - len(MAGIC):
                out.append(parsed(key[0], offset, MAGIC.encode().join(pieces)[:-4], with_payload))
            elif pieces:
                out.append({"file": key[0], "offset": offset, "until": until, "at": first, "piece": MAGIC.encode().join(pieces)})
        if out:
            yield batch_of()

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        offset = int(pdf["at"].iloc[0])
        row = parsed(pdf["file"].iloc[0], offset, MAGIC.encode().join(pdf["piece"])[:-4], with_payload)
        return pa.Table.from_pylist([row], schema=SCHEMA).to_pandas(integer_object_nulls=True)

    rows = found.mapInArrow(cut, FIELDS + ", until long, at long, piece binary")
    if splits.where("following is not null").groupBy("file").count().where("count > 1").isEmpty():
        return rows.drop("until", "at", "piece")
    rows = written(rows, "warc-records")
    straddling = rows.where("piece is not null").select("file", "until", "at", "piece")
    return rows.where("piece is null").drop("until", "at", "piece").union(straddling.groupBy("file", "until").applyInPandas(join, FIELDS))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", with_payload: bool = False) -> DataFrame:
    """The records of an archive of the pages, written to the shared folder and read back.

    NULL html is an empty payload. Repeated rows of the smallest id of equal payloads are all responses; rows without id are
    responses. An empty table gives no records; other columns are not read.
    """
    spark = pages.sparkSession
    folder = scratch_folder(spark, "warc")
    write_archives(pages, folder, id_col=id_col, url_col=url_col, html_col=html_col)
    return read_archives(spark, folder, with_payload)
