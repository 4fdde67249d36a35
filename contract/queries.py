"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contract import mapping as m
from tarifa.functions.numbers import decimal_percentile, is_suspect
from tarifa.functions.text import repair_double_encoding
from tarifa.functions.time import (
    clock_day,
    clock_to_instant,
    instant_to_clock,
    read_clock,
    utc_clock,
)
from tarifa.operators import medians, retention, sampling
from tarifa.plans import exports
from tarifa.plans.lake import TABLES, PriceLake, write_tables
from tarifa.quality import defects, proofs
from tarifa.quality.checks import CHECKS, rules_by_relation
from tarifa.session import scratch_folder
from tarifa.sources import archives as arc
from tarifa.sources import raw, run_results

TODAY = dt.date(2001, 1, 10)
NOW = dt.datetime(2024, 2, 15, 12, 0, 0)
SOURCE = {"producteur": "test tables", "licence": "none"}
RULES = ["First rule of the caller.", "A \"second\" one."]

Query = Callable[[SparkSession, str], DataFrame]


def wire(frame: DataFrame) -> DataFrame:
    """Types both engines hand over alike: decimals as doubles, days and UTC clocks as ISO text."""
    columns = []
    for field in frame.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = utc_clock(column).cast("string")
        elif isinstance(field.dataType, (T.DateType, T.TimestampNTZType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


# --- sources -----------------------------------------------------------------------------------------


def parsed_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = arc.unpack_archives(m.event_archives(spark, sf_dir))
    return arc.parse_records(arc.spread_records(records))


def xml_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.station_rows(parsed_archives(spark, sf_dir)).drop("annee", "sha256", "ordinal")


def xml_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.price_rows(parsed_archives(spark, sf_dir)).drop("annee", "sha256", "ordinal")


def xml_empty_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.empty_tags(arc.price_rows(parsed_archives(spark, sf_dir)))


def archive_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = arc.unpack_archives(m.event_archives(spark, sf_dir))
    return records.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("elements"), F.max("ordinal").alias("dernier")
    )


def source_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.encode("text", "UTF-8")
    return m.table(spark, sf_dir, "documents").select("doc_id", arc.source_hash(content).alias("sha256"))


def raw_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage of the rows, and whether their hash is the one of the archive's bytes."""
    archives = m.event_archives(spark, sf_dir)
    whole = archives.select(arc.source_file(F.col("path")).alias("_source_file"), F.sha2("content", 256).alias("attendue"))
    prices = raw.raw_prices(raw.land_archives(archives, m.loaded_at(), scratch_folder(spark, "landed")))
    by_file = prices.groupBy("_source_year", "_source_file", "_source_sha256", "_loaded_at").agg(F.count(F.lit(1)).alias("lignes"))
    same = (F.col("_source_sha256") == F.col("attendue")).alias("empreinte_exacte")
    return by_file.join(whole, "_source_file", "left").select("_source_year", "_source_file", "_loaded_at", "lignes", same)


def raw_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all years, then replace one year by its reports of fuel 1: the others must stay."""
    folder = scratch_folder(spark, "raw")
    prices = m.order_prices(spark, sf_dir)
    raw.write_raw(prices, folder)
    raw.write_raw(prices.where((F.col("_source_year") == 1998) & (F.col("prix_id") == "1")), folder)
    return raw.read_raw(spark, folder)


def raw_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years written with and without a column, read back as one relation by column name."""
    folder = scratch_folder(spark, "raw")
    stations = m.yearly_stations(spark, sf_dir)
    raw.write_raw(stations.where(F.col("_source_year") <= 1996).drop("pop"), folder)
    raw.write_raw(stations.where(F.col("_source_year") > 1996), folder)
    return raw.read_raw(spark, folder, entity="stations").select("pdv_id", "cp", "pop", "ville", "_source_year")


def raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both entities written by year, and counted from the footers of their files."""
    lake, folder = m.order_lake(spark, sf_dir), scratch_folder(spark, "raw")
    raw.write_raw(lake.raw_prices, f"{folder}/prix")
    raw.write_raw(lake.raw_stations, f"{folder}/stations")
    counts = [raw.partition_counts(spark, f"{folder}/{entity}", entity) for entity in raw.ENTITIES]
    return counts[0].unionByName(counts[1]).orderBy("entite", "_source_year")


def raw_price_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.price_stats(m.event_prices(spark, sf_dir))


def raw_price_stats_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.price_stats(m.order_prices(spark, sf_dir))


def raw_price_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of a load of 2021 to 2025, with an archive for each year but 2021 and no record in that of 2022."""
    stats = raw.price_stats(m.event_prices(spark, sf_dir, days=340))
    wanted = spark.range(2021, 2026).select(F.col("id").cast("int").alias("annee"))
    found = wanted.where("annee <> 2021")
    loaded = raw.price_load_findings(stats, m.SETTINGS, dt.date(2024, 12, 31), found.where("annee in (2022, 2024)"))
    return loaded.unionByName(raw.archive_findings(wanted, found))


def damaged_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations of two towns without text or place, one of them listed twice."""
    stations = m.customer_stations(spark, sf_dir)
    blank = defects.replaced(
        stations, F.col("ville") == "BUILDING", adresse=F.lit("  "), latitude=F.lit("")
    )
    blank = defects.replaced(blank, F.col("ville") == "MACHINERY", ville=F.lit(None).cast("string"))
    return defects.with_copies(blank, blank.where(F.col("ville") == "HOUSEHOLD"))


def raw_station_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.station_stats(damaged_stations(spark, sf_dir))


def raw_station_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stations' year, and a year whose archive has no record."""
    years = spark.createDataFrame([(2024,), (2023,)], "annee int")
    return raw.station_load_findings(raw.station_stats(damaged_stations(spark, sf_dir)), years)


def missing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years without reports or without shipments, seen from early January 2001."""
    shipped = m.table(spark, sf_dir, "lineitem")
    shipped = shipped.select(F.year("l_shipdate").cast("smallint").alias("_source_year"))
    present = raw.present_years({"prix": m.order_prices(spark, sf_dir), "stations": shipped})
    return raw.years_to_load(present, m.Settings(first_year=1992), TODAY)


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "run")
    m.write_run_results(spark, sf_dir, folder)
    return run_results.status_counts(run_results.read_run_results(spark, folder, multi_line=False))


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "run")
    m.write_run_results(spark, sf_dir, folder)
    return run_results.run_summary(run_results.read_run_results(spark, folder, multi_line=False))


# --- functions ---------------------------------------------------------------------------------------


def suspect_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = m.event_lake(spark, sf_dir).reports
    fuel, price = F.col("fuel_id"), F.col("prix_litre")
    return reports.groupBy(fuel, price, is_suspect(fuel, price, m.SETTINGS).alias("est_prix_suspect")).agg(
        F.count(F.lit(1)).alias("releves")
    )


def text_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text repaired as it is, and damaged first: the damage is undone where it shows."""
    text = F.col("text")
    damaged = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return m.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(repair_double_encoding(text)).alias("repare_md5"),
        (repair_double_encoding(damaged) == text).alias("dommage_repare"),
    )


def paris_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local times around both clock changes to UTC and back."""
    events = m.table(spark, sf_dir, "events")
    texts = [m.hour_text(F.col("ts"), days) for days in (80, 280)]
    utc = clock_to_instant(F.col("local"), m.SETTINGS.zone)
    return (
        events.select("event_id", F.explode(F.array(*texts)).alias("local"))
        .withColumn("local", read_clock(F.col("local")))
        .withColumn("utc", utc)
        .withColumn("jour", clock_day(instant_to_clock(F.col("utc"), m.SETTINGS.zone)))
    )


def decimal_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of signed decimals, cut toward zero."""
    value = (F.floor(F.col("l_discount") * 1000) - F.floor(F.col("l_tax") * 1000) * 2 + F.col("l_linenumber"))
    counted = (
        m.table(spark, sf_dir, "lineitem")
        .select("l_suppkey", (value.cast("decimal(8,0)") / 1000).cast("decimal(8,3)").alias("v"))
        .groupBy("l_suppkey", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.groupBy("l_suppkey").agg(
        *[
            decimal_percentile(F.col("v"), share, F.col("n")).alias(name)
            for name, share in [("q1", 0.25), ("mediane", 0.5), ("q3", 0.75)]
        ]
    )


# --- archive rules and sample ------------------------------------------------------------------------


def snapshot_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.kept_archives(m.order_manifest(spark, sf_dir))


def snapshot_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.dropped_archives(m.order_manifest(spark, sf_dir))


def snapshot_freed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.retention_summary(m.order_manifest(spark, sf_dir))


def publish_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decided on a Wednesday of "year" 5, so that past and current years both occur."""
    return retention.publish_decisions(
        m.order_manifest(spark, sf_dir), m.published_names(spark, sf_dir), dt.date(5, 1, 5)
    )


def sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = m.order_prices(spark, sf_dir)
    nothing = F.lit(None).cast("string")
    stations = m.yearly_stations(spark, sf_dir)
    empty = stations.drop("adresse", "ville").withColumns(
        {name: nothing for name in ["prix_id", "prix_nom", "maj", "valeur"]}
    )
    silent = empty.join(prices.select("pdv_id").distinct(), "pdv_id", "left_anti")
    return sampling.sample_ids(prices.unionByName(silent), ["1", "2", "3", "4"])


def station_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_rows(m.order_prices(spark, sf_dir), sample_ids(spark, sf_dir)).select(
        "pdv_id", "prix_id", "prix_nom", "maj", "valeur", "_source_year"
    )


def station_sample_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_rows(m.yearly_stations(spark, sf_dir), sample_ids(spark, sf_dir)).select(
        "pdv_id", "adresse", "ville", "_source_year"
    )


# --- tables and exports ------------------------------------------------------------------------------


def relation(name: str, lake: Callable[..., PriceLake] = m.event_lake, **options) -> Query:
    return lambda spark, sf_dir: getattr(lake(spark, sf_dir, **options), name)


def staged(lake: Callable[..., PriceLake], **options) -> Query:
    return lambda spark, sf_dir: lake(spark, sf_dir, **options).staged_prices.drop("_source_sha256")


def stg_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.event_lake(spark, sf_dir).staged_stations.drop("_source_sha256")


def row_digests(frame: DataFrame, name: str) -> DataFrame:
    """The name and a digest of each row: all columns by name, decimals in thousandths, degrees in hundred-thousandths."""
    texts = []
    for field in sorted(frame.schema, key=lambda f: f.name):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = (column * 1000).cast("bigint")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column * 100_000).cast("bigint")
        elif isinstance(field.dataType, T.TimestampType):
            column = utc_clock(column)
        texts.append(F.coalesce(column.cast("string"), F.lit("~")))
    return frame.select(F.lit(name).alias("relation"), F.md5(F.concat_ws("|", *texts)).alias("empreinte"))


def mart_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of every row of every table, as read back from what was written."""
    lake = write_tables(m.event_lake(spark, sf_dir), scratch_folder(spark, "tables"))
    return reduce(DataFrame.unionAll, [row_digests(getattr(lake, name), name) for name in TABLES])


def export_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = m.event_lake(spark, sf_dir)
    return exports.station_lines(lake.station_attributes, lake.current_prices).orderBy("station_id")


def export_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.station_header(m.event_lake(spark, sf_dir).current_prices)


def export_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.median_series(m.event_lake(spark, sf_dir).daily_medians)


def export_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.gap_series(m.event_lake(spark, sf_dir).motorway_gap)


def export_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.volumes(m.event_lake(spark, sf_dir))


def export_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.source_files(m.yearly_stations(spark, sf_dir)).orderBy("annee")


def export_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.metadata_document(m.event_lake(spark, sf_dir), NOW, SOURCE, rules=RULES)


def broken_lake(spark: SparkSession, sf_dir: str) -> PriceLake:
    """Stations of one town without coordinates and one fuel under an unknown code."""
    lake = m.event_lake(spark, sf_dir)
    stations = defects.replaced(lake.raw_stations, F.col("ville") == "BUILDING", latitude=F.lit(""))
    prices = defects.replaced(lake.raw_prices, F.col("prix_id") == "5", prix_id=F.lit("9"))
    return lake.with_relations(raw_prices=prices, raw_stations=stations)


def export_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.export_findings(broken_lake(spark, sf_dir), NOW)


def series_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps in the series of report days per year-round fuel."""
    days = m.order_lake(spark, sf_dir).reports.select(
        "fuel_id", F.col("jour_releve").alias("jour")
    )
    return exports.series_gaps(days.distinct())


def missing_fuels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.missing_fuels(m.event_lake(spark, sf_dir).daily_medians, m.SETTINGS)


def unknown_fuels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.unknown_fuels(broken_lake(spark, sf_dir).current_prices, m.SETTINGS)


def gap_of(derive: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: derive(m.event_lake(spark, sf_dir).motorway_gap)


# --- checks on damaged input -------------------------------------------------------------------------


def on_reports(fuel: str, price: str, **values: str) -> Callable[[PriceLake], PriceLake]:
    """Change the reports of one fuel and price."""

    def change(lake: PriceLake) -> PriceLake:
        hit = (F.col("prix_id") == fuel) & (F.col("valeur") == price)
        new = {name: F.lit(value) for name, value in values.items()}
        return lake.with_relations(raw_prices=defects.replaced(lake.raw_prices, hit, **new))

    return change


def on_town(town: str, **values) -> Callable[[PriceLake], PriceLake]:
    """Change the stations of one town."""

    def change(lake: PriceLake) -> PriceLake:
        hit = F.col("ville") == town
        return lake.with_relations(raw_stations=defects.replaced(lake.raw_stations, hit, **values))

    return change


def tags_beside_prices(lake: PriceLake) -> PriceLake:
    nothing = {name: F.lit(None).cast("string") for name in ["prix_id", "prix_nom", "maj", "valeur"]}
    copies = lake.raw_prices.where((F.col("prix_id") == "5") & (F.col("pop") == "A"))
    return lake.with_relations(raw_prices=defects.with_copies(lake.raw_prices, copies, **nothing))


def town_twice(lake: PriceLake) -> PriceLake:
    copies = lake.raw_stations.where(F.col("ville") == "BUILDING")
    return lake.with_relations(raw_stations=defects.with_copies(lake.raw_stations, copies))


def town_unlisted(lake: PriceLake) -> PriceLake:
    kept = lake.raw_stations.where(F.col("ville") != "BUILDING")
    return lake.with_relations(raw_stations=kept)


def dimension_twice(lake: PriceLake) -> PriceLake:
    rows = lake.station_attributes
    copies = rows.where(F.col("ville") == "BUILDING")
    return lake.with_relations(station_attributes=rows.unionByName(copies))


def damaged_addresses(lake: PriceLake) -> PriceLake:
    damage = on_town("BUILDING", adresse=F.concat(F.lit("Ã\u0089 "), F.col("adresse")))
    return defects.repair_removed(damage(lake))


def with_nulls(lake: PriceLake) -> PriceLake:
    nothing = F.lit(None).cast("string")
    lake = on_town("BUILDING", adresse=nothing, latitude=F.lit(""))(lake)
    prices = defects.replaced(lake.raw_prices, F.col("prix_id") == "1", prix_nom=nothing)
    hit = (F.col("prix_id") == "2") & (F.col("valeur") == "1.400")
    return lake.with_relations(raw_prices=defects.replaced(prices, hit, valeur=nothing))


def unchanged(lake: PriceLake) -> PriceLake:
    return lake


BAD_TIME = "2024-02-30T08:61:00"


def swapped_towns(lake: PriceLake) -> PriceLake:
    return on_town("MACHINERY", latitude=F.col("longitude"), longitude=F.col("latitude"))(lake)


def towns_of_unknown_type(lake: PriceLake) -> PriceLake:
    return on_town("BUILDING", pop=F.lit("X"))(lake)


def zero_towns(lake: PriceLake) -> PriceLake:
    return on_town("FURNITURE", latitude=F.lit("0"), longitude=F.lit("0"))(lake)


# Check, lake options, damage.
DAMAGED = {
    "maj_parsable": (m.event_lake, {}, on_reports("5", "1.200", maj=BAD_TIME)),
    "maj_in_file_year": (m.event_lake, {}, on_reports("4", "1.300", maj="1987-11-05T07:15:00")),
    "not_in_future": (m.event_lake, {}, on_reports("4", "1.300", maj="2051-07-14T09:30:00")),
    "empty_tags_alone": (m.event_lake, {}, tags_beside_prices),
    "spring_gap_hour": (m.event_lake, {"days": 80}, unchanged),
    "conflicts_rare": (m.event_lake, {}, unchanged),
    "staging_keeps_reports": (m.event_lake, {}, defects.fuel_lost),
    "unique_staging": (m.event_lake, {}, defects.conflicts_kept),
    "price_range": (m.order_lake, {}, unchanged),
    "unique_station_year": (m.event_lake, {}, town_twice),
    "stations_in_bounds": (m.event_lake, {}, swapped_towns),
    "mart_stations_in_bounds": (m.event_lake, {}, zero_towns),
    "changes_differ": (m.event_lake, {}, defects.repeats_kept),
    "one_first_report": (m.event_lake, {}, defects.history_by_station),
    "unique_current": (m.event_lake, {}, defects.two_last_kept),
    "current_equals_last_change": (m.event_lake, {}, defects.first_price_taken),
    "age_not_negative": (m.event_lake, {}, defects.reference_at_start),
    "medians_station_bound": (m.event_lake, {}, defects.period_too_long),
    "no_mojibake": (m.event_lake, {}, damaged_addresses),
    "suspect_share": (m.event_lake, {}, defects.all_suspect),
    "not_null": (m.event_lake, {}, with_nulls),
    "accepted_values": (m.event_lake, {}, towns_of_unknown_type),
    "relationships": (m.event_lake, {}, town_unlisted),
    "unique_station": (m.event_lake, {}, dimension_twice),
}


def check_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake, options, damage = DAMAGED[name]
        damaged = damage(lake(spark, sf_dir, **options))
        if name == "not_null":
            # It looks at ten relations: write them once instead of deriving each from the raw layer.
            damaged = write_tables(damaged, scratch_folder(spark, "checked"))
        return CHECKS[name].find(damaged)

    return run


def defect_injection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each check against its counterexample, and each defect of data or derivation through all that derives from it."""
    folder, clean = scratch_folder(spark, "proofs"), m.clean_lake(spark, sf_dir)
    raws = {name: getattr(clean, name) for name in ("raw_prices", "raw_stations")}
    for name, frame in raws.items():
        frame.write.parquet(f"{folder}/{name}")
    stored = PriceLake(**{n: spark.read.schema(f.schema).parquet(f"{folder}/{n}") for n, f in raws.items()}, settings=clean.settings)
    return proofs.run_all(write_tables(stored, f"{folder}/tables", rules_by_relation(clean.settings)))


def registry() -> dict[str, Query]:
    tables = {
        "stg_prices": staged(m.event_lake),
        "stg_prices_spring": staged(m.event_lake, days=80),
        "stg_prices_autumn": staged(m.event_lake, days=280),
        "stg_prices_years": staged(m.order_lake),
        "stg_stations": stg_stations,
        "price_changes": relation("price_changes"),
        "price_changes_months": relation("price_changes", days=15),
        "price_changes_years": relation("price_changes", m.order_lake),
        "current_prices": relation("current_prices"),
        "current_prices_years": relation("current_prices", m.order_lake),
        "station_dim": relation("stations"),
        "station_dim_years": relation("stations", m.order_lake),
        "prices_in_force": relation("prices_in_force"),
        "prices_in_force_autumn": relation("prices_in_force", days=280),
        "prices_in_force_years": relation("prices_in_force", m.order_lake),
        "daily_medians": relation("daily_medians"),
        "daily_medians_years": relation("daily_medians", m.order_lake),
        "motorway_gap": relation("motorway_gap"),
        "motorway_gap_years": relation("motorway_gap", m.order_lake),
        "gap_summary": gap_of(medians.gap_summary),
        "gap_by_year": gap_of(medians.gap_by_year),
        "gap_by_day": gap_of(medians.gap_by_day),
    }
    functions = [
        xml_stations, xml_prices, xml_empty_tags, archive_unpack, source_hash, raw_lineage, raw_union,
        raw_counts, raw_write, raw_price_stats, raw_price_stats_years, raw_price_findings,
        raw_station_stats, raw_station_findings, missing_years, run_status, run_summary, mart_write,
        suspect_flag, text_repair, paris_instants, decimal_quantiles, snapshot_retention,
        snapshot_dropped, snapshot_freed, publish_decision, station_sample, station_sample_versions,
        export_stations, export_header, export_medians, export_gap, export_metadata, export_files,
        export_document, export_checks, series_gaps, missing_fuels, unknown_fuels, defect_injection,
    ]
    named = {f.__name__: f for f in functions}
    named["run_results"] = named.pop("run_status")
    checks = {f"dq_{name}": check_query(name) for name in CHECKS}
    everything = {**tables, **named, **checks}

    def wired(query: Query) -> Query:
        return lambda spark, sf_dir: wire(query(spark, sf_dir))

    return {name: wired(query) for name, query in everything.items()}
