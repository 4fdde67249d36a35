import hashlib

import pytest

from tarifa.llm import warc
from tarifa.session import scratch_folder

TRAP = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def pages_of(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return frame.selectExpr("*", "'x' AS digest", "1 AS id", "2 AS first", "3 AS payload", "4 AS value")


def expected(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, p in payloads:
        if i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, p in payloads:
        again = i is not None and len(p) >= 100 and i > first[p]
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first[p] if again else None))
    return sorted(out, key=str)


def read(rows):
    assert all(r["intact"] for r in rows)
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)


ROWS = [
    (1, "http://a/1", "x" * 100), (2, "http://a/2", "x" * 100), (3, None, "x" * 99), (4, "u", "x" * 99), (5, "u", None), (6, "u", ""), (7, "http://b/\r\nX: 1 WARC/1.1", "é" * 60),
    (None, "u", "x" * 100), (1, "u", "x" * 100), (-5, "u", "é" * 60), (10, "u", TRAP * 3), (11, "u", "WARC/1." * 50), (12, "u", "\r\n\r\n" * 40), (13, "u", "ends WARC/1."),
    (14, "u", "long " * 60_000 + TRAP + "tail " * 40_000), (15, "u", "\r\n"),
]


@pytest.mark.parametrize("split", ["4k", "128m"])
def test_round_trip_rejects_magic_inside_payloads(spark, split):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        folder = scratch_folder(spark, "warc-test")
        warc.write_archives(pages_of(spark, ROWS).coalesce(2), folder)
        found = warc.read_archives(spark, folder, with_payload=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert read(found) == expected(ROWS)
    texts = {r["page_id"]: bytes(r["payload"]) for r in found if r["payload"] is not None}
    assert texts[14] == ROWS[14][2].encode() and texts[10] == (TRAP * 3).encode()
    assert {r["url"] for r in found if r["page_id"] == 7} == {"http://b/%0D%0AX:%201%20WARC%2F1.1"}


def test_no_pages(spark):
    assert warc.round_trip(pages_of(spark, ROWS).limit(0)).count() == 0


def test_damage_is_an_error(spark):
    folder = scratch_folder(spark, "warc-test")
    broken = "WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"
    spark.createDataFrame([(broken,)], "value string").write.option("lineSep", "\r\n\r\n").text(folder)
    with pytest.raises(ValueError, match="1 archives are damaged"):
        warc.read_archives(spark, folder)
