"""Proof that each check notices what it is for.

A check that never fires proves nothing. For every check a counterexample is made from its own limits: the rows of one victim,
the first pair of station and fuel, are moved just beyond what the check allows, in the relation that it looks at. Only that
relation changes, so on written tables nothing is derived again: a proof is one count on a stored relation. The scenarios of
``defects`` beside them change data or a derivation, and what follows from it is derived again.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.functions.time import DAY_SECONDS
from tarifa.operators.staging import PAIR
from tarifa.plans.lake import PriceLake
from tarifa.quality.checks import CHECKS, run_checks
from tarifa.quality.defects import SCENARIOS, first_report, replaced, with_copies

THOUSANDTH = Decimal("0.001")


class Victim(NamedTuple):
    station: int
    fuel: int

    def row(self) -> Column:
        return (F.col("station_id") == self.station) & (F.col("fuel_id") == self.fuel)

    def raw(self) -> Column:
        return (F.col("pdv_id").cast("int") == self.station) & (F.col("prix_id").cast("int") == self.fuel)

    def place(self) -> Column:
        return F.col("station_id") == self.station


def first_pair(lake: PriceLake) -> Victim:
    row = lake.staged_prices.agg(F.min(F.struct(*PAIR)).alias("p")).first()["p"]
    return Victim(row["station_id"], row["fuel_id"])


def altered(relation: str, where: Callable[[Victim], Column], values: Callable[[PriceLake], dict[str, Column]]):
    """The relation with some columns of the victim's rows changed."""
    return relation, lambda lake, victim: replaced(getattr(lake, relation), where(victim), **values(lake))


def repeated(relation: str, where: Callable[[Victim], Column], values: Callable[[PriceLake], dict[str, Column]] | None = None):
    """The relation with copies of the victim's rows, some of their columns changed."""

    def change(lake: PriceLake, victim: Victim) -> DataFrame:
        rows = getattr(lake, relation)
        return with_copies(rows, rows.where(where(victim)), **(values(lake) if values else {}))

    return relation, change


def missing_hour(lake: PriceLake) -> dict[str, Column]:
    """The clock goes from two to three on the last Sunday of March: the time moves into that hour of its file's year."""
    sunday = F.next_day(F.make_date(F.col("_source_year").cast("int"), F.lit(3), F.lit(24)), "SUN")
    return {"maj": F.concat(sunday.cast("string"), F.lit("T02"), F.substring("maj", 14, 6))}


def empty_tag(lake: PriceLake) -> dict[str, Column]:
    return {name: F.lit(None).cast("string") for name in ("prix_id", "prix_nom", "maj", "valeur")}


def more_conflicts(lake: PriceLake, victim: Victim) -> DataFrame:
    """As many copies of each report as conflicts are allowed, and one more."""
    rows = lake.raw_prices
    copies = F.explode(F.sequence(F.lit(0), F.lit(lake.settings.max_conflicts)))
    return rows.unionByName(rows.where(victim.raw()).withColumn("_copy", copies).drop("_copy"))


def beyond(limit: float | Decimal, step: float | Decimal) -> Column:
    return F.lit(limit + step)


#: For each check the relation that is changed, and the change.
BREAKS: dict[str, tuple[str, Callable[[PriceLake, Victim], DataFrame]]] = {
    "maj_parsable": altered("raw_prices", Victim.raw, lambda lake: {"maj": F.reverse("maj")}),
    "maj_in_file_year": altered("raw_prices", Victim.raw, lambda lake: {"_source_year": (F.col("_source_year") + 1).cast("smallint")}),
    "not_in_future": altered(
        "staged_prices", Victim.row, lambda lake: {"_loaded_at": F.timestamp_seconds(F.unix_seconds("maj_at") - DAY_SECONDS)}
    ),
    "empty_tags_alone": repeated("raw_prices", Victim.raw, empty_tag),
    "spring_gap_hour": altered("raw_prices", Victim.raw, missing_hour),
    "conflicts_rare": ("raw_prices", more_conflicts),
    "staging_keeps_reports": ("staged_prices", lambda lake, victim: lake.staged_prices.where(~victim.row())),
    "unique_staging": repeated("staged_prices", Victim.row),
    "price_range": altered("staged_prices", Victim.row, lambda lake: {"prix_litre": beyond(lake.settings.price_range[1], THOUSANDTH)}),
    "unique_station_year": repeated("staged_stations", Victim.place),
    "stations_in_bounds": altered("staged_stations", Victim.place, lambda lake: {"latitude": beyond(lake.settings.latitude_range[1], 1.0)}),
    "mart_stations_in_bounds": altered("stations", Victim.place, lambda lake: {"longitude": beyond(lake.settings.longitude_range[0], -1.0)}),
    "changes_differ": altered(
        "price_changes", Victim.row, lambda lake: {"prix_precedent": F.col("prix_litre"), "est_premier_releve": F.lit(False)}
    ),
    "one_first_report": altered("price_changes", Victim.row, lambda lake: {"est_premier_releve": F.lit(False)}),
    "unique_current": repeated("current_prices", Victim.row),
    "current_equals_last_change": altered("current_prices", Victim.row, lambda lake: {"prix_litre": F.col("prix_litre") + F.lit(THOUSANDTH)}),
    "age_not_negative": altered("current_prices", Victim.row, lambda lake: {"nombre_jours_depuis_maj": -1 - F.col("nombre_jours_depuis_maj")}),
    "medians_station_bound": altered(
        "daily_medians", lambda victim: F.col("fuel_id") == victim.fuel, lambda lake: {"nombre_stations": F.col("nombre_stations") + (1 << 40)}
    ),
    "no_mojibake": altered(
        "staged_stations", Victim.place, lambda lake: {"adresse": F.decode(F.encode(F.concat(F.lit("é"), "adresse"), "UTF-8"), "ISO-8859-1")}
    ),
    "suspect_share": altered("current_prices", lambda victim: F.col("fuel_id") == victim.fuel, lambda lake: {"est_prix_suspect": F.lit(True)}),
    "not_null": altered("staged_prices", Victim.row, lambda lake: {"fuel": F.lit(None).cast("string")}),
    "accepted_values": altered("staged_prices", Victim.row, lambda lake: {"fuel_id": F.lit(max(lake.settings.fuels) + 1).cast("smallint")}),
    "relationships": altered("current_prices", Victim.place, lambda lake: {"station_id": -F.col("station_id")}),
    "unique_station": repeated("stations", Victim.place),
}


def _counted(frame: DataFrame, check: str, defect: str, relation: str) -> DataFrame:
    found = frame.agg(F.count(F.lit(1)).alias("violations"))
    return found.select(F.lit(check).alias("controle"), F.lit(defect).alias("defaut"), F.lit(relation).alias("relation"), "violations")


def _judged(lake: PriceLake, broken: list[DataFrame], names: list[str]) -> DataFrame:
    """The counts on broken lakes beside those on the untouched one, each of which is taken once."""
    control = run_checks(lake, names).select("controle", "severite", F.col("violations").alias("temoin"))
    rows = reduce(DataFrame.unionByName, broken).join(F.broadcast(control), "controle")
    status = F.when(F.col("violations") == 0, "pass").when(F.col("severite") == "error", "fail").otherwise("warn")
    noticed = (F.col("violations") > F.col("temoin")).alias("detecte")
    return rows.select("controle", "defaut", "relation", "temoin", "violations", status.alias("statut"), noticed)


def _counterexamples(lake: PriceLake, names: list[str]) -> list[DataFrame]:
    victim = first_pair(lake)

    def row(name: str) -> DataFrame:
        relation, change = BREAKS[name]
        broken = CHECKS[name].find(lake.with_relations(**{relation: change(lake, victim)}))
        return _counted(broken, name, "beyond the limit", relation)

    return [row(name) for name in names]


def _scenarios(lake: PriceLake, names: list[str]) -> list[DataFrame]:
    first = first_report(lake)
    wanted = [s for s in SCENARIOS if s.check in names]
    return [_counted(CHECKS[s.check].find(s.inject(lake, first)), s.check, s.defect, s.relation) for s in wanted]


def run_proofs(lake: PriceLake, names: list[str] | None = None) -> DataFrame:
    """One row per check: the changed relation, what the check counts before and after, and whether it noticed.

    ``lake`` should read written tables. All proofs are one lazy result, a union of counts.
    """
    names = list(names or CHECKS)
    return _judged(lake, _counterexamples(lake, names), names)


def run_scenarios(lake: PriceLake, names: list[str] | None = None) -> DataFrame:
    """One row per scenario of ``defects``: its defect goes through everything that derives from the changed relation."""
    names = [s.check for s in SCENARIOS if not names or s.check in names]
    return _judged(lake, _scenarios(lake, names), names)


def run_all(lake: PriceLake) -> DataFrame:
    """Counterexamples and scenarios together, against one control."""
    names = list(CHECKS)
    return _judged(lake, _counterexamples(lake, names) + _scenarios(lake, names), names)
