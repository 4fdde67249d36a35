import datetime as dt
import gc
import hashlib
import io
import json
import tracemalloc
import zipfile
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contract import mapping
from tarifa.config import Settings
from tarifa.sources import archives as arc
from tarifa.sources import raw
from tarifa.sources.run_results import (
    execution_document,
    read_run_results,
    run_summary,
    status_counts,
)
from tests.lakes import prices, report

HEAD = '<?xml version="1.0" encoding="ISO-8859-1"?>\n<pdv_liste>\n'
SAMPLE = HEAD + """  <pdv id="1" latitude="4620100" longitude="519800" cp="01000" pop="R">
    <adresse>1 RUE L&#xE8;S BOIS é &amp; </adresse><ville>V</ville>
    <prix nom="Gazole" id="1" maj="2025-01-02T00:37:00" valeur="1.669"/>
  </pdv>
  <pdv id="2" latitude="" longitude="" cp="01000" pop="R"><adresse>B</adresse><ville>V</ville><prix/></pdv>
  <pdv id="3" latitude="1" longitude="2" cp="01000" pop="N"><ville/></pdv>
  <!-- <pdv id="9"></pdv> -->
  <pdv id="4" cp="a>b" pop='"'/>
</pdv_liste>
"""


def write_zip(folder, name, members) -> str:
    path = folder / name
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for member, text in members.items():
            archive.writestr(member, text.encode("ISO-8859-1"))
    return str(path)


def parse(spark, folder):
    records = arc.unpack_archives(arc.read_archives(spark, str(folder)))
    return arc.parse_records(arc.spread_records(records))


def test_archives_are_made_one_at_a_time():
    """An archive leaves as soon as the rows of the next one begin; a record that is NULL is left out."""
    taken = []

    def batches():
        for path in ("a", "b", "c"):
            for place in range(4):
                taken.append(path)
                elements = ["<pdv id='é'/>" if place else None, "<pdv/>"]
                yield pa.RecordBatch.from_arrays([pa.array([path] * 2), pa.array(elements)], names=["path", "element"])

    made = mapping._zip(batches())
    first = next(made)
    assert taken == ["a"] * 4 + ["b"]
    archive = zipfile.ZipFile(io.BytesIO(first.column(3)[0].as_py()))
    body = "<pdv/>" + "<pdv id='é'/><pdv/>" * 3
    assert archive.read("prices.xml").decode("ISO-8859-1") == HEAD + body + "</pdv_liste>\n"
    assert first.column(2)[0].as_py() == len(first.column(3)[0].as_py())
    assert [first.column(0)[0].as_py(), *(b.column(0)[0].as_py() for b in made)] == ["a", "b", "c"]


def test_records_of_an_archive(spark, tmp_path):
    write_zip(tmp_path, "a_annuel_2025_telecharge_20260928.zip", {"a.XML": SAMPLE, "readme.txt": "x"})
    parsed = parse(spark, tmp_path)
    stations = {r["pdv_id"]: r for r in arc.station_rows(parsed).collect()}
    assert sorted(stations) == ["1", "2", "3", "4"]
    assert stations["1"]["adresse"] == "1 RUE LèS BOIS é & "
    assert (stations["3"]["adresse"], stations["3"]["ville"]) == (None, "")
    assert (stations["2"]["latitude"], stations["4"]["latitude"]) == ("", None)
    assert (stations["4"]["cp"], stations["4"]["pop"]) == ("a>b", '"')
    prices = arc.price_rows(parsed)
    rows = {r["pdv_id"]: r for r in prices.collect()}
    assert sorted(rows) == ["1", "2"]
    assert (rows["1"]["valeur"], rows["1"]["maj"]) == ("1.669", "2025-01-02T00:37:00")
    assert [rows["2"][c] for c in ("prix_id", "prix_nom", "maj", "valeur")] == [None] * 4
    assert arc.empty_tags(prices).first()["prix_vides"] == 1


def test_records_across_blocks():
    """A document of several read blocks gives every record whole."""
    body = "".join(f'<pdv id="{i}"><adresse>{"é" * (i % 700)}</adresse></pdv>\n' for i in range(9000))
    stream = io.BytesIO((HEAD + body + "</pdv_liste>").encode("ISO-8859-1"))
    records = list(arc.record_slices(stream))
    assert len(stream.getvalue()) > 2 * arc.BLOCK_BYTES
    assert records == body.splitlines()


@pytest.mark.parametrize(
    "members, message",
    [
        ({"a.xml": SAMPLE, "b.xml": SAMPLE}, "2 XML files"),
        ({"a.txt": "x"}, "0 XML files"),
        ({"a.xml": "<other/>"}, "root tag <other>"),
    ],
)
def test_wrong_archives_are_refused(spark, tmp_path, members, message):
    write_zip(tmp_path, "a_annuel_2025_telecharge_20260928.zip", members)
    with pytest.raises(Exception, match=message):
        parse(spark, tmp_path).count()


def test_load_replaces_one_year(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for year in (2025, 2026):
        path = write_zip(source, f"x_annuel_{year}_telecharge_20260928.zip", {"a.xml": SAMPLE})
    archives = arc.read_archives(spark, str(source))
    loaded = F.lit(dt.datetime(2026, 9, 28, 10, 37, 30, tzinfo=dt.timezone.utc))
    manifest = {r["annee"]: r for r in arc.archive_manifest(archives).collect()}
    digest = hashlib.sha256(open(path, "rb").read()).hexdigest()
    assert manifest[2026]["sha256"] == digest
    assert manifest[2026]["jour"] == dt.date(2026, 9, 28)
    landed = raw.land_archives(archives, loaded, str(tmp_path / "landed"))
    prices = raw.raw_prices(landed)
    folder = str(tmp_path / "prix")
    raw.write_raw(prices, folder)
    raw.write_raw(prices.where("_source_year = 2026 and prix_id is not null"), folder)
    back = raw.read_raw(spark, folder)
    counts = {r["_source_year"]: r["lignes"] for r in raw.raw_counts({"prix": back}).collect()}
    assert counts == {2025: 2, 2026: 1}
    assert back.columns == prices.columns
    assert raw.read_raw(spark, folder, [2026]).count() == 1
    row = back.where("_source_year = 2026").first()
    assert (row["_source_sha256"], row["_source_file"]) == (digest, "x_annuel_2026_telecharge_20260928.zip")


def test_empty_load_is_refused(spark):
    schema = "_source_year smallint, pdv_id string, prix_id string, prix_nom string, maj string, valeur string"
    frame = spark.createDataFrame([(2025, "1", None, None, None, None)], schema)
    findings = raw.price_load_findings(raw.price_stats(frame), Settings(), dt.date(2025, 3, 1))
    assert {r["regle"] for r in findings.collect()} == {"no_dated_report", "empty_price_tags"}
    with pytest.raises(arc.SourceError, match="no_dated_report"):
        raw.require_load(findings)


@pytest.mark.parametrize(
    "today, expected",
    [
        (dt.date(2028, 1, 15), {2025: "missing", 2027: "previous_year", 2028: "current_year"}),
        (dt.date(2028, 1, 16), {2025: "missing", 2027: "missing", 2028: "current_year"}),
        (dt.date(2026, 6, 1), {2025: "missing", 2026: "current_year"}),
    ],
)
def test_years_to_load(spark, today, expected):
    present = spark.createDataFrame(
        [("prix", 2025), ("prix", 2026), ("stations", 2026)], "entite string, annee smallint"
    )
    found = raw.years_to_load(present, Settings(), today).collect()
    assert {r["annee"]: r["raison"] for r in found} == expected


def test_run_results(spark, tmp_path):
    document = {
        "args": {"which": "build", "select": ["a", "b"]},
        "metadata": {"generated_at": "2026-09-28T10:00:00Z"},
        "elapsed_time": 12.34,
        "results": [
            {"unique_id": "model.p.a", "status": "success"},
            {"unique_id": "test.p.b", "status": "pass"},
            {"unique_id": "test.p.c", "status": "pass"},
        ],
    }
    path = tmp_path / "run.json"
    path.write_text(json.dumps(document, indent=1))
    results = read_run_results(spark, str(path))
    counts = {(r[0], r[1]): r[2] for r in status_counts(results).collect()}
    assert counts == {("model", "success"): 1, ("test", "pass"): 2}
    assert run_summary(results).first().asDict() == {
        "commande": "build", "selection": "a b", "genere_le": "2026-09-28T10:00:00Z", "duree_s": 12.3,
    }
    assert json.loads(execution_document(results).first()["execution"]) == {
        "commande": "build", "selection": ["a", "b"], "genere_le": "2026-09-28T10:00:00Z", "duree_s": 12.3,
        "modeles": {"success": 1}, "tests": {"pass": 2},
    }
    del document["args"]["select"]
    document["results"] = []
    path.write_text(json.dumps(document))
    whole = json.loads(execution_document(read_run_results(spark, str(path))).first()["execution"])
    assert (whole["selection"], whole["modeles"], whole["tests"]) == ("tout le projet", {}, {})


def test_two_runs_keep_their_own_counts(spark, tmp_path):
    for hour, states in [(10, ["pass"]), (11, ["pass", "fail"])]:
        nodes = [{"unique_id": f"test.p.{i}", "status": s} for i, s in enumerate(states)]
        run = {"args": {"which": "build"}, "metadata": {"generated_at": f"2026-09-28T{hour}:00:00Z"}, "elapsed_time": 1.0, "results": nodes}
        (tmp_path / f"{hour}.json").write_text(json.dumps(run))
    found = execution_document(read_run_results(spark, str(tmp_path))).collect()
    assert {r["genere_le"][11:13]: json.loads(r["execution"])["tests"] for r in found} == {"10": {"pass": 1}, "11": {"fail": 1, "pass": 1}}


def test_counts_come_from_footers(spark, tmp_path):
    rows = [report(p, 1, f"{year}-01-02T08:00:00", "1.5") for year in (2024, 2025) for p in range(year - 2020)]
    raw.write_raw(prices(spark, rows), str(tmp_path))
    counts = raw.partition_counts(spark, str(tmp_path))
    assert "ReadSchema: struct<>" in counts._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, counts.collect())) == [("prix", 2024, 4), ("prix", 2025, 5)]


def test_contents_of_a_batch_are_not_copied(spark):
    """Archives of 60 MB in one batch are read in a few megabytes, and each record comes with the place it has in its archive."""
    element = f"<pdv id='1'><adresse>{'x' * 3000}</adresse></pdv>"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("prices.xml", (HEAD + element * 1000 + "</pdv_liste>").encode("ISO-8859-1"))
    columns = [pa.array(["f"] * 20), pa.array([2024] * 20, pa.int32()), pa.array(["d"] * 20), pa.array([buffer.getvalue()] * 20)]
    batch = pa.RecordBatch.from_arrays(columns, names=[*arc.ORIGIN, "content"])
    tracemalloc.start()
    ordinals = [n for part in arc._unpack(iter([batch])) for n in part.column(3).to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ordinals == list(range(1000)) * 20
    assert peak < 16 << 20


def test_contents_go_to_python_in_small_batches(spark):
    """Twelve files of 1 MB come in several batches, not in one."""
    rows = spark.range(0, 12, 1, 1).select(
        F.concat(F.lit("x_annuel_2024_telecharge_20241231_"), "id", F.lit(".zip")).alias("path"),
        F.encode(F.repeat(F.lit("x"), 1 << 20), "UTF-8").alias("content"),
    )
    arc.unpack_archives(rows)  # bounds the batches of the session

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    found = [r["n"] for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(found) == 12 and max(found) <= 6


def test_a_read_archive_leaves_nothing_behind():
    """The blocks of a parser go with it, without the collector."""
    document = (HEAD + f"<pdv id='1'><adresse>{'x' * 3000}</adresse><prix/></pdv>" * 500 + "</pdv_liste>").encode("ISO-8859-1")
    gc.collect()
    gc.disable()
    try:
        tracemalloc.start()
        assert sum(1 for _ in range(10) for _ in arc.record_slices(io.BytesIO(document))) == 5000
        left = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
        gc.enable()
    assert left < 1 << 20


def anonymous_mb():
    """Memory of this process without mapped files, what Arrow and the parser hold included."""
    lines = Path("/proc/self/smaps_rollup").read_text().splitlines()
    return int(next(line for line in lines if line.startswith("Anonymous:")).split()[1]) / 1024


def test_a_large_archive_is_made_outside_of_memory():
    """While archives of 64 MB are made and handed over, none of them is held in memory."""
    element = "<pdv id='é'>" + "x" * (1 << 20) + "</pdv>"

    def batches():
        for path in ("a", "b", "c"):
            for _ in range(64):
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([element])], names=["path", "element"])

    before, most, sizes = anonymous_mb(), 0, []
    for batch in mapping._zip(batches()):
        most = max(most, anonymous_mb())
        sizes.append(batch.column(2)[0].as_py())
    assert len(sizes) == 3 and min(sizes) > 64 << 20
    assert most - before < 32


def test_a_large_archive_is_not_copied_to_be_read():
    """The first records of an archive of 64 MB come without a second one in memory; slices and empty batches are read alike."""
    element = "<pdv id='1'>" + "x" * (1 << 20) + "</pdv>"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("prices.xml", (HEAD + element * 64 + "</pdv_liste>").encode("ISO-8859-1"))
    contents = pa.array([b"no archive", buffer.getvalue()])
    columns = [pa.array(["e", "f"]), pa.array([2023, 2024], pa.int32()), pa.array(["c", "d"]), contents]
    batch = pa.RecordBatch.from_arrays(columns, names=[*arc.ORIGIN, "content"])
    before = anonymous_mb()
    found = arc._unpack(iter([batch.slice(0, 0), batch.slice(1, 1)]))
    first = next(found)
    assert anonymous_mb() - before < 32
    assert first.slice(0, 1).to_pylist() == [
        {"source_file": "f", "annee": 2024, "sha256": "d", "ordinal": 0, "element": element}
    ]
    assert first.num_rows + sum(part.num_rows for part in found) == 64
