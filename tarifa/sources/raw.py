"""The raw layer: lineage, yearly replacement, reading back, load statistics and rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarifa.config import Settings
from tarifa.functions.text import trim_spaces
from tarifa.functions.time import try_clock
from tarifa.schemas import LINEAGE_COLUMNS, PRICE_COLUMNS, RAW_PRICES, RAW_STATIONS, STATION_COLUMNS
from tarifa.sources import archives as arc

ENTITIES = {"prix": PRICE_COLUMNS, "stations": STATION_COLUMNS}
# The folders of the layer add their year.
SCHEMAS = {
    entity: T.StructType([*schema.fields, T.StructField("annee", T.IntegerType())])
    for entity, schema in [("prix", RAW_PRICES), ("stations", RAW_STATIONS)]
}


def with_lineage(rows: DataFrame, loaded_at: Column) -> DataFrame:
    """Year, file, hash and load time of each row, from what its archive left on it."""
    return rows.select(
        *[name for name in rows.columns if name not in {*arc.ORIGIN, "ordinal"}],
        F.col("annee").cast("smallint").alias("_source_year"),
        F.col("source_file").alias("_source_file"),
        F.col("sha256").alias("_source_sha256"),
        loaded_at.cast("timestamp").alias("_loaded_at"),
    )


def land_archives(archives: DataFrame, loaded_at: Column, folder: str, by_path: bool = False) -> DataFrame:
    """Unpack and parse once into a nested table; both raw entities are column subsets of it."""
    unpack = arc.unpack_files if by_path else arc.unpack_archives
    parsed = arc.parse_records(arc.spread_records(unpack(archives)))
    landed = with_lineage(parsed, loaded_at)
    landed.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return archives.sparkSession.read.parquet(folder)


def raw_prices(landed: DataFrame) -> DataFrame:
    return arc.price_rows(landed).select(*PRICE_COLUMNS, *LINEAGE_COLUMNS)


def raw_stations(landed: DataFrame) -> DataFrame:
    return arc.station_rows(landed).select(*STATION_COLUMNS, *LINEAGE_COLUMNS)


def write_raw(rows: DataFrame, folder: str) -> None:
    """Replace whole years: partitions present in ``rows`` are overwritten, other years stay.

    REBALANCE groups the rows of a year into files of advisory size and splits a year that holds most
    rows, so neither many small files nor one huge task results. The job commit makes it visible whole.
    """
    (
        rows.withColumn("annee", F.col("_source_year"))
        .hint("rebalance", F.col("annee"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("annee")
        .parquet(folder)
    )


def read_raw(spark: SparkSession, folder: str, years: list[int] | None = None, entity: str = "prix") -> DataFrame:
    """All years by column name; a column an older year lacks is NULL. ``years`` prunes folders.

    The declared schema is read, so opening the lake looks into no file.
    """
    frame = spark.read.schema(SCHEMAS[entity]).parquet(folder)
    if years:
        frame = frame.where(F.col("annee").isin(years))
    return frame.drop("annee")


def partition_counts(spark: SparkSession, folder: str, entity: str = "prix") -> DataFrame:
    """Rows per entity and year of a written layer. The year is the folder's and no column is read, so that the row counts come
    from the footers of the files alone."""
    frame = spark.read.schema(SCHEMAS[entity]).parquet(folder)
    counts = frame.groupBy(F.col("annee").cast("smallint").alias("_source_year")).agg(F.count(F.lit(1)).alias("lignes"))
    return counts.select(F.lit(entity).alias("entite"), "_source_year", "lignes")


def raw_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per entity and year."""
    counts = None
    for entity, frame in frames.items():
        part = frame.groupBy("_source_year").agg(F.count(F.lit(1)).alias("lignes"))
        part = part.select(F.lit(entity).alias("entite"), "_source_year", "lignes")
        counts = part if counts is None else counts.unionByName(part)
    return counts


def price_stats(raw: DataFrame) -> DataFrame:
    """Volumes and period per year.

    Rows are first reduced to one per (year, station, fuel) in the map tasks; distinct counts then run
    on that small result. First and last time are kept as times, which hash tables hold, and written as the source writes
    them at the end; unreadable times are the business of ``maj_parsable``.
    """
    dated = F.col("maj").isNotNull()
    off_year = dated & (F.left(F.col("maj"), F.lit(4)) != F.col("_source_year").cast("string"))
    blank = F.coalesce("prix_id", "prix_nom", "maj", "valeur").isNull()
    per_pair = raw.groupBy("_source_year", "pdv_id", "prix_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(dated).alias("dates"),
        F.count_if(off_year).alias("hors"),
        F.count_if(blank).alias("vides"),
        F.min(try_clock(F.col("maj"))).alias("premier"),
        F.max(try_clock(F.col("maj"))).alias("dernier"),
    )
    per_station = per_pair.groupBy("_source_year", "pdv_id").agg(
        F.sum("n").alias("n"),
        F.sum("dates").alias("dates"),
        F.count_if(F.col("dates") > 0).alias("couples"),
        F.sum("hors").alias("hors"),
        F.sum("vides").alias("vides"),
        F.min("premier").alias("premier"),
        F.max("dernier").alias("dernier"),
    )
    text = lambda name: F.translate(F.col(name).cast("string"), " ", "T").alias(name)
    volumes = per_station.groupBy("_source_year").agg(
        F.sum("n").alias("releves"),
        F.count_if((F.col("dates") > 0) & F.col("pdv_id").isNotNull()).alias("stations"),
        F.sum("couples").alias("couples"),
        F.sum("hors").alias("hors_annee"),
        F.sum("vides").alias("prix_vides"),
        F.min("premier").alias("premier"),
        F.max("dernier").alias("dernier"),
    )
    return volumes.withColumns({name: text(name) for name in ("premier", "dernier")})


def station_stats(raw: DataFrame) -> DataFrame:
    """Volumes and blanks per year."""

    def blank(name: str) -> Column:
        return F.col(name).isNull() | (trim_spaces(F.col(name)) == "")

    def missing(name: str) -> Column:
        return F.col(name).isNull() | (F.col(name) == "")

    per_id = raw.groupBy("_source_year", "pdv_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(blank("adresse")).alias("a"),
        F.count_if(blank("ville")).alias("v"),
        F.count_if(missing("latitude") | missing("longitude")).alias("c"),
    )
    return per_id.groupBy("_source_year").agg(
        F.sum("n").alias("stations"),
        F.count("pdv_id").alias("identifiants"),
        F.sum("a").alias("sans_adresse"),
        F.sum("v").alias("sans_ville"),
        F.sum("c").alias("sans_coordonnees"),
    )


def _findings(stats: DataFrame, rules: list[tuple[str, str, Column, Column]]) -> DataFrame:
    """Rules (level, name, condition, value) over one-row-per-year statistics."""
    found = [
        F.when(
            condition,
            F.struct(
                F.lit(level).alias("niveau"),
                F.lit(name).alias("regle"),
                value.cast("bigint").alias("valeur"),
            ),
        )
        for level, name, condition, value in rules
    ]
    return (
        stats.select("_source_year", F.explode(F.array_compact(F.array(*found))).alias("f"))
        .select("_source_year", "f.niveau", "f.regle", "f.valeur")
    )


def of_years(stats: DataFrame, years: DataFrame | None) -> DataFrame:
    """A row for each year of a load (column annee), also for one without a single record: its counts are 0."""
    if years is None:
        return stats
    wanted = years.select(F.col("annee").cast("smallint").alias("_source_year")).distinct()
    counts = [f.name for f in stats.schema if f.dataType.typeName() == "long"]
    return wanted.join(stats, "_source_year", "left").fillna(0, counts)


def price_load_findings(
    stats: DataFrame, settings: Settings, today: dt.date, years: DataFrame | None = None
) -> DataFrame:
    """Errors stop a load (nothing dated); warnings report empty tags, off-year and stale reports.

    ``years`` lists the years that were to be loaded, so that one without records is noticed.
    """
    stats = of_years(stats, years)
    last_day = F.to_date(F.left(F.col("dernier"), F.lit(10)))
    delay = F.datediff(F.lit(today), last_day)
    is_current = F.col("_source_year") == today.year
    undated = (F.col("releves") == 0) | F.col("dernier").isNull()
    return _findings(
        stats,
        [
            ("error", "no_dated_report", undated, F.col("releves")),
            ("warn", "empty_price_tags", F.col("prix_vides") > 0, F.col("prix_vides")),
            ("warn", "outside_year", F.col("hors_annee") > 0, F.col("hors_annee")),
            ("warn", "stale", is_current & (delay > settings.max_delay_days), delay),
        ],
    )


def station_load_findings(stats: DataFrame, years: DataFrame | None = None) -> DataFrame:
    stats = of_years(stats, years)
    twice = F.col("stations") - F.col("identifiants")
    blanks = ["sans_adresse", "sans_ville", "sans_coordonnees"]
    return _findings(
        stats,
        [
            ("error", "no_station", F.col("stations") == 0, F.col("stations")),
            ("warn", "duplicated_ids", twice > 0, twice),
            *[("warn", name, F.col(name) > 0, F.col(name)) for name in blanks],
        ],
    )


def archive_findings(wanted: DataFrame, found: DataFrame, level: str = "error") -> DataFrame:
    """A finding for each year (column annee) that is to be loaded and has no archive."""
    return wanted.distinct().join(found, "annee", "left_anti").select(
        F.col("annee").cast("smallint").alias("_source_year"),
        F.lit(level).alias("niveau"),
        F.lit("no_archive").alias("regle"),
        F.lit(0).cast("bigint").alias("valeur"),
    )


def require_load(findings: DataFrame) -> None:
    """Stop when a finding is an error. All failed rules are named, each with its years (one row per rule)."""
    errors = findings.where(F.col("niveau") == "error").groupBy("regle")
    failed = errors.agg(F.array_sort(F.collect_set("_source_year")).alias("annees")).orderBy("regle").collect()
    if failed:
        raise arc.SourceError("; ".join(f"{e['regle']}: {', '.join(map(str, e['annees']))}" for e in failed))


def years_to_load(present: DataFrame, settings: Settings, today: dt.date) -> DataFrame:
    """Years to load and why: the current one, the previous one in early January, missing ones.

    ``present`` lists (entite, annee) of the partitions that exist; a year needs both entities.
    """
    spark = present.sparkSession
    complete = (
        present.groupBy("annee")
        .agg(F.countDistinct("entite").alias("n"))
        .where(F.col("n") == len(ENTITIES))
        .select(F.col("annee").cast("int"))
    )
    early = today.timetuple().tm_yday <= settings.january_days
    always = {today.year: "current_year", **({today.year - 1: "previous_year"} if early else {})}
    fixed = spark.createDataFrame(sorted(always.items()), "annee int, raison string")
    expected = spark.range(settings.first_year, today.year).select(F.col("id").cast("int").alias("annee"))
    missing = (
        expected.join(complete, "annee", "left_anti")
        .where(~F.col("annee").isin(list(always)))
        .select("annee", F.lit("missing").alias("raison"))
    )
    return fixed.unionByName(missing)


def present_years(frames: dict[str, DataFrame]) -> DataFrame:
    return raw_counts(frames).select("entite", F.col("_source_year").alias("annee"))
