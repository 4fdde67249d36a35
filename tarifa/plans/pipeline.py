"""The whole run: load archives, write tables, check them, export."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.config import Settings
from tarifa.plans.exports import export_findings, write_exports
from tarifa.plans.lake import TABLES, PriceLake, write_tables
from tarifa.plans.snapshots import SnapshotLog
from tarifa.plans.years import derive_years, stored_lake
from tarifa.quality.checks import CHECKS, rules_by_relation, run_checks
from tarifa.sources import archives as arc
from tarifa.sources import raw


class CheckError(RuntimeError):
    """A check of error severity found rows, so nothing is published."""


def listed_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, annee, jour) of every file below the path, from its name; both are empty where the name does not fit."""
    name = arc.source_file(F.col("path"))
    return arc.read_archives(spark, path).select(
        "path",
        F.regexp_extract(name, arc.NAME_PATTERN, 1).alias("annee"),
        F.regexp_extract(name, arc.NAME_PATTERN, 2).alias("jour"),
    )


def newest_copies(listed: DataFrame, years: list[int] | None = None) -> list[tuple[int, str]]:
    """Year and path of the newest copy of each year; there is one row per year."""
    if years is not None:
        listed = listed.where(F.col("annee").isin([str(year) for year in years]))
    newest = listed.where(F.col("jour") != "").groupBy("annee").agg(F.max_by("path", "jour").alias("path"))
    return sorted((int(row["annee"]), row["path"]) for row in newest.collect())


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate data, in any store that Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def wanted_years(spark: SparkSession, folder: str, settings: Settings, today: dt.date) -> list[int]:
    """Years to load: the current one, the previous one in early January, and those the lake lacks.

    Which years there are is known from the latest snapshot; no row is read.
    """
    snapshot = SnapshotLog(spark, folder).read()
    present = [(entity, year) for entity in raw.ENTITIES for year in snapshot.years(entity)]
    years = raw.years_to_load(spark.createDataFrame(present, "entite string, annee int"), settings, today)
    return [row["annee"] for row in years.collect()]


def load(
    spark: SparkSession,
    archive_path: str,
    folder: str,
    loaded_at: dt.datetime,
    settings: Settings,
    years: list[int] | None = None,
    absent: str = "error",
) -> DataFrame:
    """Load the newest copy of each year; returns the findings. Years that fail their rules stay as they were.

    Without ``years`` the current year, in early January the one before, and years that the lake lacks are loaded. A year
    without an archive is a finding of the level ``absent``; as an error it stops the load before anything is read. A file whose
    name is none of an archive is an error: nothing below the path is passed over in silence. Prices and stations become visible
    together, by the snapshot that names both.
    """
    log = SnapshotLog(spark, folder)
    base = log.read()
    run = f"{folder}/{log.new_run(base).removeprefix('/')}"
    listed = listed_archives(spark, archive_path)
    unused = [arc.source_file(F.col("path")).alias("f")]
    strangers = sorted(r["f"] for r in listed.where(F.col("jour") == "").select(*unused).collect())
    if strangers:
        raise arc.SourceError(f"no archive names: {', '.join(strangers)}")
    wanted = sorted(wanted_years(spark, folder, settings, loaded_at.date()) if years is None else set(years))
    chosen = newest_copies(listed, wanted)
    if not chosen:
        raise arc.SourceError(f"no archive below {archive_path}")
    found = [year for year, _ in chosen]
    missing = raw.archive_findings(year_frame(spark, wanted), year_frame(spark, found), absent)
    raw.require_load(missing)
    files = spark.createDataFrame([(path,) for _, path in chosen], "path string")
    by_path = all(re.match(r"(?:file|hdfs|s3|gs|gcs):", path) for _, path in chosen)
    archives = files if by_path else spark.read.format("binaryFile").load([path for _, path in chosen])
    try:
        landed = raw.land_archives(archives, F.lit(loaded_at), f"{run}/landed", by_path)
        prices, stations = raw.raw_prices(landed), raw.raw_stations(landed)
        loading = year_frame(spark, found)
        findings = (
            raw.price_load_findings(raw.price_stats(prices), settings, loaded_at.date(), loading)
            .unionByName(raw.station_load_findings(raw.station_stats(stations), loading))
            .unionByName(missing)
        )
        findings.write.parquet(f"{run}/findings")
        findings = spark.read.schema(findings.schema).parquet(f"{run}/findings")
        raw.require_load(findings)
        written = {}
        for entity, rows in (("prix", prices), ("stations", stations)):
            raw.write_raw(rows, f"{run}/{entity}")
            written[entity] = log.partitions(f"{run.removeprefix(folder + '/')}/{entity}")
        log.commit(base.with_raw(written))
    finally:
        remove_folder(spark, f"{run}/landed")
    return findings


def year_frame(spark: SparkSession, years: list[int]) -> DataFrame:
    return spark.createDataFrame([(year,) for year in years], "annee int")


def open_lake(spark: SparkSession, folder: str, settings: Settings | None = None) -> PriceLake:
    """The raw years of the latest snapshot, both entities of one version."""
    log = SnapshotLog(spark, folder)
    return stored_lake(spark, log, replace(log.read(), tables={}), settings)


#: Checks of the raw layer, which must hold before its values are read as times and numbers.
SOURCE_CHECKS = ["maj_parsable", "maj_in_file_year", "spring_gap_hour", "empty_tags_alone"]


def checked(lake: PriceLake, names: list[str], folder: str, mode: str) -> DataFrame:
    """Results of some checks, stored; stops at a failed one."""
    run_checks(lake, names).write.mode(mode).parquet(folder)
    results = lake.raw_prices.sparkSession.read.parquet(folder)
    failed = [r["controle"] for r in results.where(F.col("statut") == "fail").collect()]
    if failed:
        raise CheckError(", ".join(sorted(failed)))
    return results


def build(lake: PriceLake, folder: str) -> tuple[PriceLake, DataFrame]:
    """Check the raw layer, write the tables of the whole lake, check them, and only then make them visible in a snapshot.

    A failed check leaves the tables of the last good run in place; ``open_tables`` reads those.
    """
    log = SnapshotLog(lake.raw_prices.sparkSession, folder)
    base = log.read()
    run = log.new_run(base)
    checked(lake, SOURCE_CHECKS, f"{folder}/checks", "overwrite")
    stored = write_tables(lake, f"{folder}/{run}", rules_by_relation(lake.settings))
    results = checked(stored, [name for name in CHECKS if name not in SOURCE_CHECKS], f"{folder}/checks", "append")
    names = ["staged_prices", "staged_stations", *TABLES]
    log.commit(replace(base, tables={name: {"all": f"{run}/{name}"} for name in names}, keys={}))
    return stored, results


def refresh(spark: SparkSession, folder: str, settings: Settings | None = None) -> tuple[PriceLake, list[str]]:
    """Bring the tables up to date by year; returns the lake and the parts that were derived.

    The raw checks run on the years whose folders are new, the other checks on the tables; as in ``build``, nothing is visible
    before all hold.
    """
    settings = settings or Settings()
    log = SnapshotLog(spark, folder)
    base = log.read()
    new = {
        entity: {year: path for year, path in base.raw.get(entity, {}).items() if base.keys.get(f"{table}/{year}") != path}
        for entity, table in (("prix", "staged_prices"), ("stations", "staged_stations"))
    }
    if new["prix"]:
        checked(stored_lake(spark, log, replace(base, raw=new, tables={}), settings), SOURCE_CHECKS, f"{folder}/checks", "overwrite")
    parts = derive_years(log, base, settings)
    after = replace(base, tables=parts.tables, keys=parts.keys)
    stored = stored_lake(spark, log, after, settings)
    checked(stored, [name for name in CHECKS if name not in SOURCE_CHECKS], f"{folder}/checks", "append" if new["prix"] else "overwrite")
    log.commit(after)
    return stored, parts.written


def open_tables(lake: PriceLake, folder: str) -> PriceLake:
    """The lake with the tables of the last run that passed its checks."""
    log = SnapshotLog(lake.raw_prices.sparkSession, folder)
    tables = log.read().tables
    return lake.with_relations(**{name: log.frame(tables[name]) for name in ["staged_prices", "staged_stations", *TABLES]})


def publish(
    lake: PriceLake,
    folder: str,
    generated_at: dt.datetime,
    source: dict[str, str],
    run: DataFrame | None = None,
    rules: list[str] | None = None,
) -> DataFrame:
    """Check the export rules, then write the exports, with the reading ``rules`` of the caller; returns the findings."""
    findings = export_findings(lake, generated_at)
    errors = [r["regle"] for r in findings.where(F.col("niveau") == "error").collect()]
    if errors:
        raise CheckError(", ".join(sorted(errors)))
    write_exports(lake, folder, generated_at, source, run, rules)
    return findings


def register_views(lake: PriceLake, prefix: str = "") -> None:
    """Temporary views of every relation, for SQL users."""
    names = [
        "raw_prices", "raw_stations", "staged_prices", "staged_stations", "prices_in_force",
        "price_changes", "stations", "current_prices", "daily_medians", "motorway_gap",
    ]
    for name in names:
        getattr(lake, name).createOrReplaceTempView(prefix + name)
