"""From archives to exports."""

import datetime as dt
import zipfile
from dataclasses import replace

import pytest

from tarifa.config import FUELS, Settings
from tarifa.plans import pipeline
from tarifa.plans.lake import TABLES
from tarifa.plans.snapshots import SnapshotConflict, SnapshotLog
from tarifa.plans.years import derive_years, stored_lake
from tarifa.sources import archives as arc

LOADED = dt.datetime(2025, 2, 10, 6, 0, tzinfo=dt.timezone.utc)


def write_archive(folder, year, day, bad_price=None, late=False):
    stations = []
    for pdv in range(1, 5):
        kind = "A" if pdv % 2 else "R"
        tags = []
        for fuel, name in FUELS.items():
            for step in range(10):
                at = dt.datetime(year, 1, 1, 8) + dt.timedelta(days=4 * step, minutes=pdv)
                price = bad_price or f"{0.8 + (fuel not in (3, 4)) + 0.01 * ((pdv + step) % 3):.3f}"
                if late and step == 9 and year < 2026:  # a price that holds beyond the end of the year
                    at = dt.datetime(year, 12, 28, 9, pdv)
                tags.append(f'<prix nom="{name}" id="{fuel}" maj="{at.isoformat()}" valeur="{price}"/>')
        stations.append(
            f'<pdv id="{pdv}" latitude="4620100" longitude="519800" cp="0100{pdv}" pop="{kind}">'
            f"<adresse>{pdv} RUE</adresse><ville>V</ville>{''.join(tags)}</pdv>"
        )
    text = f'<?xml version="1.0" encoding="ISO-8859-1"?><pdv_liste>{"".join(stations)}</pdv_liste>'
    with zipfile.ZipFile(folder / f"x_annuel_{year}_telecharge_{day}.zip", "w") as archive:
        archive.writestr("x.xml", text.encode("ISO-8859-1"))


def test_whole_run(spark, tmp_path):
    source, folder = tmp_path / "in", str(tmp_path / "lake")
    source.mkdir()
    write_archive(source, 2025, "20250209", bad_price="9876")
    write_archive(source, 2025, "20250210")
    settings = Settings()
    findings = pipeline.load(spark, str(source), folder, LOADED, settings)
    assert [r["regle"] for r in findings.collect()] == ["stale"]
    lake = pipeline.open_lake(spark, folder, settings)
    stored, results = pipeline.build(lake, folder)
    assert results.where("violations > 0").count() == 0
    found = pipeline.publish(stored, str(tmp_path / "out"), LOADED.replace(tzinfo=None), {"producteur": "x"})
    assert {r["niveau"] for r in found.collect()} <= {"warn"}
    assert len(list((tmp_path / "out" / "metadata").glob("part-*"))) == 1
    pipeline.register_views(stored, "t_")
    assert spark.sql("select count(*) from t_current_prices").first()[0] == 24


def test_failed_check_stops_the_run(spark, tmp_path):
    write_archive(tmp_path, 2025, "20250209", bad_price="9876")
    folder = str(tmp_path / "lake")
    pipeline.load(spark, str(tmp_path), folder, LOADED, Settings())
    with pytest.raises(pipeline.CheckError, match="price_range"):
        pipeline.build(pipeline.open_lake(spark, folder), folder)


def test_no_archive(spark, tmp_path):
    with pytest.raises(Exception, match="no archive"):
        pipeline.load(spark, str(tmp_path), str(tmp_path / "lake"), LOADED, Settings())


def test_year_without_records_stops_the_load(spark, tmp_path):
    """One good and one empty archive: the load names the empty year and leaves the lake as it was."""
    source, folder = tmp_path / "in", str(tmp_path / "lake")
    source.mkdir()
    write_archive(source, 2025, "20250210")
    pipeline.load(spark, str(source), folder, LOADED, Settings(), years=[2025])
    before = pipeline.open_lake(spark, folder).raw_prices.count()
    with zipfile.ZipFile(source / "x_annuel_2024_telecharge_20250210.zip", "w") as archive:
        archive.writestr("x.xml", "<pdv_liste/>")
    write_archive(source, 2025, "20250211", bad_price="9.999")
    with pytest.raises(arc.SourceError, match="no_dated_report: 2024; no_station: 2024"):
        pipeline.load(spark, str(source), folder, LOADED, Settings(), years=[2024, 2025])
    lake = pipeline.open_lake(spark, folder)
    assert lake.raw_prices.count() == before and lake.raw_prices.where("valeur = '9.999'").count() == 0


def test_file_that_is_no_archive_stops_the_load(spark, tmp_path):
    write_archive(tmp_path, 2025, "20250210")
    (tmp_path / "autre.zip").write_bytes(b"x")
    with pytest.raises(arc.SourceError, match="autre.zip"):
        pipeline.load(spark, str(tmp_path), str(tmp_path / "lake"), LOADED, Settings())


def test_years_that_a_load_takes(spark, tmp_path):
    source, folder = tmp_path / "in", str(tmp_path / "lake")
    source.mkdir()
    for year in (2024, 2025, 2026):
        write_archive(source, year, "20260215")
    settings, later = Settings(first_year=2024), dt.datetime(2026, 2, 15, tzinfo=dt.timezone.utc)
    assert sorted(pipeline.wanted_years(spark, folder, settings, later.date())) == [2024, 2025, 2026]
    pipeline.load(spark, str(source), folder, later, settings)
    assert pipeline.wanted_years(spark, folder, settings, later.date()) == [2026]
    assert sorted(pipeline.wanted_years(spark, folder, settings, dt.date(2026, 1, 10))) == [2025, 2026]


def test_unreadable_time_is_a_failed_check_and_the_old_tables_stay(spark, tmp_path):
    write_archive(tmp_path, 2025, "20250210")
    folder = str(tmp_path / "lake")
    pipeline.load(spark, str(tmp_path / "x_annuel_2025_telecharge_20250210.zip"), folder, LOADED, Settings())
    lake = pipeline.open_lake(spark, folder)
    pipeline.build(lake, folder)
    before = pipeline.open_tables(lake, folder).current_prices.collect()
    damaged = lake.with_relations(raw_prices=lake.raw_prices.replace("2025-01-01T08:01:00", "2025-02-30T08:61:00", ["maj"]))
    with pytest.raises(pipeline.CheckError, match="maj_parsable"):
        pipeline.build(damaged, folder)
    stored = {r["controle"]: r["statut"] for r in spark.read.parquet(f"{folder}/checks").collect()}
    assert stored["maj_parsable"] == "fail"
    assert pipeline.open_tables(lake, folder).current_prices.collect() == before


def test_year_without_archive_stops_the_load(spark, tmp_path):
    source, folder = tmp_path / "in", str(tmp_path / "lake")
    source.mkdir()
    write_archive(source, 2026, "20260215")
    with pytest.raises(arc.SourceError, match="no_archive: 2024, 2025"):
        pipeline.load(spark, str(source), folder, LOADED, Settings(), years=[2024, 2025, 2026])
    assert SnapshotLog(spark, folder).read().number == 0
    found = pipeline.load(spark, str(source), folder, LOADED, Settings(), years=[2025, 2026], absent="warn")
    assert ("warn", "no_archive", 2025) in {(r["niveau"], r["regle"], r["_source_year"]) for r in found.collect()}


def test_failure_between_the_entities_leaves_the_old_pair(spark, tmp_path, monkeypatch):
    source, folder = tmp_path / "in", str(tmp_path / "lake")
    source.mkdir()
    write_archive(source, 2025, "20250210")
    pipeline.load(spark, str(source), folder, LOADED, Settings(), years=[2025])
    before = [sorted(map(repr, f.collect())) for f in raw_frames(spark, folder)]
    write_archive(source, 2025, "20250211", bad_price="1.999")
    write_raw = pipeline.raw.write_raw

    def broken(rows, target):
        if target.endswith("/stations"):
            raise OSError("disk")
        write_raw(rows, target)

    monkeypatch.setattr(pipeline.raw, "write_raw", broken)
    with pytest.raises(OSError, match="disk"):
        pipeline.load(spark, str(source), folder, LOADED, Settings(), years=[2025])
    assert [sorted(map(repr, f.collect())) for f in raw_frames(spark, folder)] == before
    assert not list((tmp_path / "lake").glob("data/*/landed"))


def raw_frames(spark, folder):
    lake = pipeline.open_lake(spark, folder)
    return lake.raw_prices, lake.raw_stations


def test_snapshots_conflict_and_clean_up(spark, tmp_path):
    log = SnapshotLog(spark, str(tmp_path / "lake"))
    start = log.read()
    for n in range(4):
        run = log.new_run(log.read())
        spark.range(n + 1).write.parquet(f"{log.folder}/{run}/t")
        log.commit(replace(log.read(), tables={"t": {"all": f"{run}/t"}}))
    with pytest.raises(SnapshotConflict):
        log.commit(start)
    lost = log.new_run(start)  # of a run that failed
    spark.range(1).write.parquet(f"{log.folder}/{lost}/t")
    going_on = log.new_run(log.read())
    spark.range(1).write.parquet(f"{log.folder}/{going_on}/t")
    removed = log.clean(keep=2)
    assert log.numbers() == [3, 4] and len(removed) == 3 and lost in removed and going_on not in removed
    assert [log.frame(log.read(n).tables["t"]).count() for n in (3, 4)] == [3, 4]


def table_rows(lake):
    return {name: sorted(map(repr, getattr(lake, name).collect())) for name in TABLES}


def test_refresh_derives_only_replaced_years(spark, tmp_path):
    """The middle one of three years is replaced: raw folders of the others and reports of the first are gone by then."""
    replaced = 2025
    source, folder = tmp_path / "in", str(tmp_path / "lake")
    source.mkdir()
    settings = Settings(first_year=2024)
    later = dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc)
    for year in (2024, 2025, 2026):
        write_archive(source, year, "20260210", late=True)
    pipeline.load(spark, str(source), folder, later, settings)
    whole = pipeline.open_lake(spark, folder, settings)
    stored, written = pipeline.refresh(spark, folder, settings)
    assert table_rows(stored) == table_rows(whole)
    assert pipeline.refresh(spark, folder, settings)[1] == []
    write_archive(source, replaced, "20260211", bad_price="1.234", late=True)
    pipeline.load(spark, str(source), folder, later, settings, years=[replaced])
    expected = table_rows(pipeline.open_lake(spark, folder, settings))
    log = SnapshotLog(spark, folder)
    for year, path in log.read().raw["prix"].items():
        others = [path] if int(year) != replaced else []
        if int(year) < replaced:
            others.append(log.read().tables["staged_prices"][year])
        for other in others:
            for file in (tmp_path / "lake" / other).glob("*.parquet"):
                file.write_bytes(b"not to be read")
    base = log.read()
    parts = derive_years(log, base, settings)
    lake = stored_lake(spark, log, replace(base, tables={name: parts.tables[name] for name in TABLES}), settings)
    assert table_rows(lake) == expected
    assert {name.split("/")[1] for name in parts.written if name.startswith("staged_prices")} == {str(replaced)}
    assert not [name for name in parts.written if name.split("/")[1] != "all" and int(name.split("/")[1]) < replaced]
