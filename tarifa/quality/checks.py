"""The checks of the lake. A check takes a lake and returns its offending rows; none means it passes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarifa.config import ROAD_TYPES, Settings
from tarifa.functions.text import has_double_encoding
from tarifa.functions.time import try_clock
from tarifa.operators.staging import PAIR
from tarifa.operators.stations import priced_versions
from tarifa.plans.lake import PriceLake
from tarifa.quality.rules import duplicated, null_counts, orphans, outside, unexpected_values

RAW_REPORT = ["pdv_id", "prix_id", "maj", "_source_year"]


def filled(lake: PriceLake) -> DataFrame:
    return lake.raw_prices.where(F.col("prix_id").isNotNull())


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- rules on single rows ------------------------------------------------------------------------


def _placed_outside(settings: Settings) -> Column:
    return outside(F.col("latitude"), *settings.latitude_range) | outside(F.col("longitude"), *settings.longitude_range)


def _no_change(settings: Settings) -> Column:
    before = F.col("prix_precedent")
    return ~F.col("est_premier_releve") & (before.isNull() | (F.col("prix_litre") == before))


#: Checks that a row fails by itself: the relation, and the condition of an offending row. They can be counted while a relation
#: is written, and then need no scan of their own.
ROW_RULES: dict[str, tuple[str, Callable[[Settings], Column]]] = {
    "price_range": ("staged_prices", lambda s: outside(F.col("prix_litre"), F.lit(s.price_range[0]), F.lit(s.price_range[1]))),
    "not_in_future": ("staged_prices", lambda s: F.col("maj_at") > F.col("_loaded_at")),
    "no_mojibake": ("staged_stations", lambda s: has_double_encoding(F.col("adresse")) | has_double_encoding(F.col("ville"))),
    "mart_stations_in_bounds": ("stations", _placed_outside),
    "changes_differ": ("price_changes", _no_change),
    "age_not_negative": ("current_prices", lambda s: F.col("nombre_jours_depuis_maj") < 0),
}


def offending(lake: PriceLake, check: str) -> DataFrame:
    relation, offends = ROW_RULES[check]
    rows = lake.station_attributes if relation == "stations" else getattr(lake, relation)
    return rows.where(offends(lake.settings))


def rules_by_relation(settings: Settings) -> dict[str, dict[str, Column]]:
    """For each relation the conditions that ``write_tables`` can count while writing it."""
    found: dict[str, dict[str, Column]] = {}
    for check, (relation, offends) in ROW_RULES.items():
        found.setdefault(relation, {})[check] = offends(settings)
    return found


# --- raw layer -----------------------------------------------------------------------------------


def maj_parsable(lake: PriceLake) -> DataFrame:
    return filled(lake).where(try_clock(F.col("maj")).isNull()).select(*RAW_REPORT)


def maj_in_file_year(lake: PriceLake) -> DataFrame:
    year = F.year(try_clock(F.col("maj")))
    return filled(lake).where(year != F.col("_source_year")).select(*RAW_REPORT)


def spring_gap_hour(lake: PriceLake) -> DataFrame:
    """Local times that do not exist: 02:xx on the last Sunday of March."""
    clock = try_clock(F.col("maj"))
    day = F.to_date(clock)
    last_sunday = (F.month(day) == 3) & (F.dayofweek(day) == 1) & (F.dayofmonth(day) >= 25)
    return filled(lake).where(last_sunday & (F.hour(clock) == 2)).select(*RAW_REPORT)


def empty_tags_alone(lake: PriceLake) -> DataFrame:
    """A station without prices has one empty tag in its year and nothing else."""
    return (
        lake.raw_prices.groupBy("pdv_id", "_source_year")
        .agg(
            F.count_if(F.col("prix_id").isNull()).alias("balises_vides"),
            F.count("prix_id").alias("vrais_prix"),
        )
        .where(
            (F.col("balises_vides") > 0)
            & ((F.col("balises_vides") > 1) | (F.col("vrais_prix") > 0))
        )
    )


def _distinct_reports(lake: PriceLake) -> DataFrame:
    """One row: reports and distinct (station, fuel, time), a NULL inside counting as a value."""
    per_report = (
        filled(lake).groupBy("pdv_id", "prix_id", "maj").agg(F.count(F.lit(1)).alias("n"))
    )
    return per_report.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("releves"), F.count(F.lit(1)).alias("distincts")
    )


def conflicts_rare(lake: PriceLake) -> DataFrame:
    conflicts = F.col("releves") - F.col("distincts")
    return (
        _distinct_reports(lake)
        .select(conflicts.alias("releves_en_conflit"))
        .where(F.col("releves_en_conflit") > lake.settings.max_conflicts)
    )


# --- staging -------------------------------------------------------------------------------------


def staging_keeps_reports(lake: PriceLake) -> DataFrame:
    source = _distinct_reports(lake).select(F.col("distincts").alias("releves_source"))
    staged = lake.staged_prices.agg(F.count(F.lit(1)).alias("releves_staging"))
    return source.crossJoin(F.broadcast(staged)).where(
        F.col("releves_source") != F.col("releves_staging")
    )


def unique_staging(lake: PriceLake) -> DataFrame:
    return duplicated(lake.staged_prices, [*PAIR, "maj_at"], "prix")


def price_range(lake: PriceLake) -> DataFrame:
    return offending(lake, "price_range").select("station_id", "fuel", "maj_at", "prix_litre")


def not_in_future(lake: PriceLake) -> DataFrame:
    return offending(lake, "not_in_future").select("station_id", "fuel", "maj_at", "_loaded_at", "_source_file")


def unique_station_year(lake: PriceLake) -> DataFrame:
    return duplicated(lake.staged_stations, ["station_id", "_source_year"], "lignes")


def stations_in_bounds(lake: PriceLake) -> DataFrame:
    """A missing coordinate is an offence here, as a priced station must be placed."""
    latitude, longitude = F.col("latitude"), F.col("longitude")
    misplaced = (
        latitude.isNull()
        | longitude.isNull()
        | outside(latitude, *lake.settings.latitude_range)
        | outside(longitude, *lake.settings.longitude_range)
    )
    # The filter runs before the join, which then only sees misplaced stations.
    return priced_versions(lake.reports, lake.staged_stations.where(misplaced)).select(
        "station_id", "_source_year", "code_postal", "latitude", "longitude"
    )


def no_mojibake(lake: PriceLake) -> DataFrame:
    return offending(lake, "no_mojibake").select("station_id", "_source_year", "adresse", "ville")


# --- analytic tables -----------------------------------------------------------------------------


def mart_stations_in_bounds(lake: PriceLake) -> DataFrame:
    return offending(lake, "mart_stations_in_bounds").select("station_id", "code_postal", "latitude", "longitude")


def changes_differ(lake: PriceLake) -> DataFrame:
    return offending(lake, "changes_differ").select(*PAIR, "maj_at", "prix_precedent", "prix_litre")


def one_first_report(lake: PriceLake) -> DataFrame:
    """Exactly one first report per staged pair, and none for a pair staging does not know."""
    staged = lake.staged_prices.select(*PAIR).distinct().alias("c")
    first = (
        lake.price_changes.where("est_premier_releve")
        .groupBy(*PAIR)
        .agg(F.count(F.lit(1)).alias("n"))
        .alias("p")
    )
    same_pair = reduce(
        lambda a, b: a & b, [F.col(f"c.{key}").eqNullSafe(F.col(f"p.{key}")) for key in PAIR]
    )
    found = F.coalesce(F.col("p.n"), F.lit(0).cast("bigint"))
    return (
        staged.join(first, same_pair, "full")
        .where((found != 1) | F.col("c.station_id").isNull())
        .select(
            F.col("c.station_id").alias("station_id"),
            F.col("c.fuel_id").alias("fuel_id"),
            found.alias("premiers_releves"),
        )
    )


def unique_current(lake: PriceLake) -> DataFrame:
    return duplicated(lake.current_prices, PAIR, "prix")


def current_equals_last_change(lake: PriceLake) -> DataFrame:
    last = (
        lake.price_changes.groupBy(*PAIR)
        .agg(F.max(F.struct("maj_at", "prix_litre")).alias("d"))
        .select(*PAIR, F.col("d.prix_litre").alias("prix_dernier_changement"))
    )
    current = lake.current_prices.select(*PAIR, F.col("prix_litre").alias("prix_actuel"))
    change = F.col("prix_dernier_changement")
    return current.join(last, PAIR, "left").where(change.isNull() | (F.col("prix_actuel") != change))


def age_not_negative(lake: PriceLake) -> DataFrame:
    return offending(lake, "age_not_negative").select(*PAIR, "maj_at", "reference_at", "nombre_jours_depuis_maj")


def suspect_share(lake: PriceLake) -> DataFrame:
    return lake.current_prices.agg(
        F.count_if("est_prix_suspect").alias("prix_suspects"),
        F.count(F.lit(1)).alias("prix_actuels"),
    ).where(F.col("prix_suspects") > F.lit(lake.settings.max_suspect_share) * F.col("prix_actuels"))


def medians_station_bound(lake: PriceLake) -> DataFrame:
    """Stations counted on a day against stations with a report in the days in force before it.

    The range condition is turned into disjoint runs of days per pair (a report day covers the days up
    to its successor), so a plain count per day replaces a range join and a distinct count.
    """
    days = lake.settings.days_in_force
    history = Window.partitionBy(*PAIR).orderBy("jour_releve")
    covered_until = F.least(
        F.date_add("jour_releve", days), F.date_sub(F.lead("jour_releve").over(history), 1)
    )
    possible = (
        lake.reports.select(*PAIR, "jour_releve")
        .where(F.col("jour_releve").isNotNull())
        .distinct()
        .withColumn("fin", covered_until)
        .select("fuel_id", F.explode(F.sequence("jour_releve", "fin")).alias("jour"))
        .groupBy("jour", "fuel_id")
        .agg(F.count(F.lit(1)).alias("stations_possibles"))
    )
    return (
        lake.daily_medians.join(possible, ["jour", "fuel_id"])
        .where(F.col("nombre_stations") > F.col("stations_possibles"))
        .select("jour", "fuel", "nombre_stations", "stations_possibles")
    )


# --- generic checks ------------------------------------------------------------------------------

# Columns that must not be NULL, per relation.
REQUIRED = {
    "raw_prices": ["_source_year"],
    "raw_stations": ["pdv_id"],
    "staged_prices": ["station_id", "fuel_id", "fuel", "maj_at", "prix_litre"],
    "staged_stations": ["station_id", "_source_year"],
    "prices_in_force": ["station_id", "fuel_id", "jour", "prix_litre"],
    "price_changes": [
        "station_id", "fuel_id", "maj_at", "prix_litre", "est_premier_releve", "est_prix_suspect",
    ],
    "stations": ["station_id", "adresse", "ville", "latitude", "longitude", "est_autoroute"],
    "current_prices": [
        "station_id", "fuel_id", "prix_litre", "maj_at", "est_prix_suspect",
        "nombre_jours_depuis_maj",
    ],
    "daily_medians": ["jour", "fuel_id", "fuel", "prix_median", "nombre_stations"],
    "motorway_gap": [
        "jour", "departement", "fuel_id", "prix_median_autoroute", "prix_median_route",
        "nombre_stations_autoroute", "nombre_stations_route", "ecart",
    ],
}


def not_null(lake: PriceLake) -> DataFrame:
    return union([null_counts(getattr(lake, r), r, c) for r, c in REQUIRED.items()])


def accepted_values(lake: PriceLake) -> DataFrame:
    codes = list(lake.settings.fuels)
    return union(
        [
            unexpected_values(lake.raw_prices, "raw_prices", "prix_id", [str(c) for c in codes]),
            unexpected_values(lake.raw_stations, "raw_stations", "pop", list(ROAD_TYPES)),
            unexpected_values(lake.staged_prices, "staged_prices", "fuel_id", codes),
            unexpected_values(
                lake.staged_prices, "staged_prices", "fuel", list(lake.settings.fuels.values())
            ),
        ]
    )


def relationships(lake: PriceLake) -> DataFrame:
    return union(
        [
            orphans(lake.staged_prices, lake.staged_stations, "staged_prices", "station_id"),
            orphans(lake.price_changes, lake.station_attributes, "price_changes", "station_id"),
            orphans(lake.current_prices, lake.station_attributes, "current_prices", "station_id"),
        ]
    )


def unique_station(lake: PriceLake) -> DataFrame:
    return duplicated(lake.station_attributes, ["station_id"], "lignes")


@dataclass(frozen=True)
class Check:
    name: str
    find: Callable[[PriceLake], DataFrame]
    severity: str = "error"


CHECKS = {
    check.name: check
    for check in [
        Check("maj_parsable", maj_parsable),
        Check("maj_in_file_year", maj_in_file_year),
        Check("not_in_future", not_in_future),
        Check("empty_tags_alone", empty_tags_alone),
        Check("spring_gap_hour", spring_gap_hour),
        Check("conflicts_rare", conflicts_rare),
        Check("staging_keeps_reports", staging_keeps_reports),
        Check("unique_staging", unique_staging),
        Check("price_range", price_range),
        Check("unique_station_year", unique_station_year),
        Check("stations_in_bounds", stations_in_bounds),
        Check("mart_stations_in_bounds", mart_stations_in_bounds),
        Check("changes_differ", changes_differ),
        Check("one_first_report", one_first_report),
        Check("unique_current", unique_current),
        Check("current_equals_last_change", current_equals_last_change),
        Check("age_not_negative", age_not_negative),
        Check("medians_station_bound", medians_station_bound),
        Check("no_mojibake", no_mojibake),
        Check("suspect_share", suspect_share, "warn"),
        Check("not_null", not_null),
        Check("accepted_values", accepted_values),
        Check("relationships", relationships),
        Check("unique_station", unique_station),
    ]
}


def run_checks(lake: PriceLake, names: list[str] | None = None) -> DataFrame:
    """Number of offending rows and status per check, as one lazy result.

    What was counted while the lake's tables were written is taken from there.
    """
    spark = lake.raw_prices.sparkSession

    def report(check: Check) -> DataFrame:
        failed = F.when(F.col("violations") > 0, F.lit("fail" if check.severity == "error" else "warn"))
        if check.name in lake.observed:
            counted = spark.range(1).select(F.lit(lake.observed[check.name]).cast("bigint").alias("violations"))
        else:
            counted = check.find(lake).agg(F.count(F.lit(1)).alias("violations"))
        return (
            counted.select(
                F.lit(check.name).alias("controle"),
                F.lit(check.severity).alias("severite"),
                "violations",
                failed.otherwise("pass").alias("statut"),
            )
        )

    return union([report(CHECKS[name]) for name in names or CHECKS])
