"""Damage for the checks: rows changed or repeated, and relations derived in a wrong way.

A scenario changes the lake in one way, in its data or in one derived relation, and names the check that has to return rows.
What derives from the change is derived anew; the untouched lake is the control.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarifa.functions.text import trim_spaces
from tarifa.functions.time import clock_day, days_between, instant_to_clock
from tarifa.operators import staging
from tarifa.operators.in_force import validity_periods
from tarifa.operators.staging import PAIR
from tarifa.plans.lake import PriceLake


def replaced(frame: DataFrame, where: Column, **values: Column) -> DataFrame:
    """The same rows, with some columns changed where the condition holds."""
    return frame.withColumns(
        {name: F.when(where, value).otherwise(F.col(name)) for name, value in values.items()}
    )


def with_copies(frame: DataFrame, of: DataFrame, **values: Column) -> DataFrame:
    """The frame plus copies of some rows, with some columns changed in the copies."""
    return frame.unionByName(of.withColumns(values) if values else of)


class First(NamedTuple):
    """The first report in natural order (there is no stable row number to go by), and the last year with a report."""

    pdv: str | None
    fuel: str | None
    maj: str | None
    year: int | None

    def report(self) -> Column:
        keys = zip(("pdv_id", "prix_id", "maj"), self)
        return reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.lit(value).cast("string")) for name, value in keys])

    def version(self) -> Column:
        """The newest version of its station."""
        pdv, year = F.lit(self.pdv).cast("string"), F.lit(self.year).cast("smallint")
        return (F.col("pdv_id") == pdv) & (F.col("_source_year") == year)


def first_report(lake: PriceLake) -> First:
    key = F.min(F.struct("pdv_id", "prix_id", "maj"))
    found = _whole(lake).agg(key.alias("k"), F.max("_source_year").alias("y")).first()
    return First(*(found["k"] or (None, None, None)), found["y"])


def _whole(lake: PriceLake) -> DataFrame:
    """Reports of a known station, fuel and time."""
    return lake.raw_prices.where("pdv_id is not null and prix_id is not null and maj is not null")


def _in_order(lake: PriceLake) -> DataFrame:
    return _whole(lake).orderBy("pdv_id", "prix_id", "maj", F.col("valeur").asc_nulls_last())


def on_prices(**values: str) -> Callable[[PriceLake, First], PriceLake]:
    """Change the first report; columns are built late, as they need a running session."""

    def inject(lake: PriceLake, first: First) -> PriceLake:
        columns = {name: F.lit(value) for name, value in values.items()}
        return lake.rederived(raw_prices=replaced(lake.raw_prices, first.report(), **columns))

    return inject


def on_station(values: Callable[[], dict[str, Column]]) -> Callable[[PriceLake, First], PriceLake]:
    """Change the newest version of the first priced station."""

    def inject(lake: PriceLake, first: First) -> PriceLake:
        return lake.rederived(raw_stations=replaced(lake.raw_stations, first.version(), **values()))

    return inject


def always(change: Callable[[PriceLake], PriceLake]) -> Callable[[PriceLake, First], PriceLake]:
    return lambda lake, first: change(lake)


def empty_tag_added(lake: PriceLake) -> PriceLake:
    nothing = F.lit(None).cast("string")
    one = _in_order(lake).limit(1)
    changed = with_copies(lake.raw_prices, one, prix_id=nothing, prix_nom=nothing, maj=nothing, valeur=nothing)
    return lake.rederived(raw_prices=changed)


def conflicts_added(lake: PriceLake) -> PriceLake:
    dearer = (F.col("valeur").cast("decimal(8,3)") + F.lit("0.100").cast("decimal(4,3)")).cast("string")
    copies = _in_order(lake).limit(lake.settings.max_conflicts + 1)
    return lake.rederived(raw_prices=with_copies(lake.raw_prices, copies, valeur=dearer))


def station_twice(lake: PriceLake) -> PriceLake:
    first = lake.raw_stations.orderBy(F.col("pdv_id").asc_nulls_last(), "_source_year").limit(1)
    return lake.rederived(raw_stations=with_copies(lake.raw_stations, first))


def fuel_lost(lake: PriceLake) -> PriceLake:
    """Staging drops the fuel with the highest code."""
    lost = lake.raw_prices.agg(F.max("prix_id").alias("_lost"))
    kept = lake.raw_prices.crossJoin(F.broadcast(lost)).where(F.col("prix_id") != F.col("_lost"))
    return lake.rederived(staged_prices=staging.staged_prices(kept, lake.settings))


def conflicts_kept(lake: PriceLake) -> PriceLake:
    return lake.rederived(staged_prices=staging.typed_reports(lake.raw_prices, lake.settings))


def repeats_kept(lake: PriceLake) -> PriceLake:
    """Every change is followed by a report that repeats its price."""
    changes = lake.price_changes
    repeats = changes.where(~F.col("est_premier_releve")).withColumn("prix_precedent", F.col("prix_litre"))
    return lake.rederived(price_changes=changes.unionByName(repeats))


def history_by_station(lake: PriceLake) -> PriceLake:
    """Only the station's first report counts as first, not the first of each of its fuels."""
    start = lake.price_changes.groupBy("station_id").agg(
        F.min(F.struct("maj_at", "fuel_id")).alias("_debut")
    )
    is_start = F.struct("maj_at", "fuel_id") == F.col("_debut")
    changed = (
        lake.price_changes.join(start, "station_id")
        .withColumn("est_premier_releve", F.col("est_premier_releve") & is_start)
        .drop("_debut")
    )
    return lake.rederived(price_changes=changed)


def _ranked(lake: PriceLake, ascending: bool, keep: int) -> DataFrame:
    """Few reports per pair; the rank limit also applies in each map task."""
    at, price = F.col("maj_at"), F.col("prix_litre")
    order = [at.asc(), price.asc()] if ascending else [at.desc(), price.desc()]
    rank = F.row_number().over(Window.partitionBy(*PAIR).orderBy(*order))
    return lake.staged_prices.withColumn("_rank", rank).where(F.col("_rank") <= keep).drop("_rank")


def two_last_kept(lake: PriceLake) -> PriceLake:
    return lake.rederived(current_prices=_ranked(lake, ascending=False, keep=2))


def first_price_taken(lake: PriceLake) -> PriceLake:
    return lake.rederived(current_prices=_ranked(lake, ascending=True, keep=1))


def reference_at_start(lake: PriceLake) -> PriceLake:
    start = lake.reports.agg(F.min("maj_at").alias("debut"))

    def local_day(name: str) -> Column:
        return clock_day(instant_to_clock(F.col(name), lake.settings.zone))

    changed = (
        lake.current_prices.drop("reference_at", "nombre_jours_depuis_maj")
        .crossJoin(F.broadcast(start.withColumnRenamed("debut", "reference_at")))
        .withColumn("nombre_jours_depuis_maj", days_between(local_day("maj_at"), local_day("reference_at")))
    )
    return lake.rederived(current_prices=changed)


def repair_removed(lake: PriceLake) -> PriceLake:
    raw = lake.raw_stations
    changed = staging.staged_stations(raw).drop("adresse", "ville")
    texts = raw.select(
        F.col("pdv_id").cast("int").alias("station_id"),
        "_source_year",
        trim_spaces(F.col("adresse")).alias("adresse"),
        trim_spaces(F.col("ville")).alias("ville"),
    )
    return lake.rederived(staged_stations=changed.join(texts, ["station_id", "_source_year"]))


def period_too_long(lake: PriceLake) -> PriceLake:
    """A price still in force on the day of its successor: the station counts twice that day."""
    periods = validity_periods(lake.staged_prices, lake.settings, lake.reports)
    longest = F.date_add("jour", lake.settings.days_in_force)
    nxt = F.lead("jour").over(Window.partitionBy(*PAIR).orderBy("jour", "fuel"))
    longer = periods.withColumn("nxt", nxt).withColumn(
        "fin", F.when(F.col("nxt").isNotNull(), F.least("nxt", longest)).otherwise(F.col("fin"))
    )
    return lake.rederived(validity_periods=longer)


def all_suspect(lake: PriceLake) -> PriceLake:
    changed = replaced(lake.raw_prices, F.col("prix_id") == "3", valeur=F.lit("1.990"))
    return lake.rederived(raw_prices=changed)


@dataclass(frozen=True)
class Scenario:
    check: str
    defect: str
    relation: str
    inject: Callable[[PriceLake, First], PriceLake]


#: Both columns are replaced at once, so each reads the other's old value.
SWAPPED = on_station(lambda: {"latitude": F.col("longitude"), "longitude": F.col("latitude")})
ZERO = on_station(lambda: {"latitude": F.lit("0"), "longitude": F.lit("0")})
#: The repair must have something to miss: one address as the source writes it, encoded twice.
DAMAGED_ADDRESS = on_station(lambda: {"adresse": F.concat(F.lit("Ã\u0089 "), F.col("adresse"))})

SCENARIOS = [
    Scenario("maj_parsable", "unreadable time", "raw_prices", on_prices(maj="2025-13-45T25:00:00")),
    Scenario("maj_in_file_year", "report of another year", "raw_prices", on_prices(maj="1990-06-01T10:00:00")),
    Scenario("empty_tags_alone", "empty tag beside prices", "raw_prices", always(empty_tag_added)),
    Scenario("spring_gap_hour", "report in the missing hour", "raw_prices", on_prices(maj="2025-03-30T02:30:00")),
    Scenario("conflicts_rare", "too many conflicts", "raw_prices", always(conflicts_added)),
    Scenario("staging_keeps_reports", "fuel lost in staging", "staged_prices", always(fuel_lost)),
    Scenario("unique_staging", "conflicts not resolved", "staged_prices", always(conflicts_kept)),
    Scenario("price_range", "price in thousandths", "raw_prices", on_prices(valeur="1638")),
    Scenario("unique_station_year", "station listed twice", "raw_stations", always(station_twice)),
    Scenario("stations_in_bounds", "coordinates swapped", "raw_stations", SWAPPED),
    Scenario("mart_stations_in_bounds", "coordinates at zero", "raw_stations", ZERO),
    Scenario("changes_differ", "repeats kept", "price_changes", always(repeats_kept)),
    Scenario("one_first_report", "history by station only", "price_changes", always(history_by_station)),
    Scenario("unique_current", "two last prices kept", "current_prices", always(two_last_kept)),
    Scenario("current_equals_last_change", "first price taken", "current_prices", always(first_price_taken)),
    Scenario("age_not_negative", "reference at the first report", "current_prices", always(reference_at_start)),
    Scenario("not_in_future", "report after its load", "raw_prices", on_prices(maj="2099-12-31T12:00:00")),
    Scenario("no_mojibake", "repair removed", "staged_stations", lambda lake, first: repair_removed(DAMAGED_ADDRESS(lake, first))),
    Scenario("medians_station_bound", "period one day too long", "validity_periods", always(period_too_long)),
    Scenario("suspect_share", "E85 at petrol price", "raw_prices", always(all_suspect)),
]
