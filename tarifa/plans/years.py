"""Tables by year: only what a replaced year touches is derived again.

What a year hands to the next one is small and stored beside it: the state of each pair (last price, last change), the daily
prices of its last days, the last report and the activity of each pair. A part of a table keeps a key, which names everything it
was derived from: the folder of the raw year, and digests of what earlier years and the stations gave. A part whose key has not
changed is named again by the new snapshot and not read.

Reports of a file lie in its year (a check of the raw layer), so conflicts, months and days never mix two files' reports.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.config import Settings
from tarifa.operators import changes, current, in_force, medians, staging, stations
from tarifa.plans.lake import TABLES, PriceLake
from tarifa.plans.snapshots import Snapshot, SnapshotLog
from tarifa.schemas import RAW_PRICES, RAW_STATIONS


def digest(frame: DataFrame) -> str:
    """A digest of the rows, whatever their order."""
    row = frame.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*frame.columns).cast("decimal(38,0)")).alias("h")).first()
    return f"{row['n']}:{row['h']}"


class Parts:
    """Parts of tables of a new snapshot: kept where their key is the one of the base, else derived and written."""

    def __init__(self, log: SnapshotLog, base: Snapshot) -> None:
        self.log, self.base, self.run = log, base, log.new_run(base)
        self.tables: dict[str, dict[str, str]] = {}
        self.keys: dict[str, str] = {}
        self.written: list[str] = []

    def part(self, relation: str, name: str, key: str, derive: Callable[[], DataFrame]) -> None:
        full = f"{relation}/{name}"
        folder = self.base.tables.get(relation, {}).get(name)
        if folder is None or self.base.keys.get(full) != key:
            folder = f"{self.run}/{full}"
            derive().write.parquet(f"{self.log.folder}/{folder}")
            self.written.append(full)
        self.tables.setdefault(relation, {})[name] = folder
        self.keys[full] = key

    def read(self, relation: str, name: str) -> DataFrame:
        return self.log.frame({name: self.tables[relation][name]})

    def whole(self, relation: str) -> DataFrame:
        return self.log.frame(self.tables[relation])


def last_reports(staged: DataFrame, settings: Settings) -> DataFrame:
    """The last report of each pair, in the columns of reports that ``current_prices`` reads."""
    return current.current_prices(staged, settings).select("station_id", "fuel_id", "fuel", "maj_at", "prix_litre")


def year_activity(staged: DataFrame, year: int) -> DataFrame:
    """Activity of the pairs of a year, which also tells that their stations have a price in it."""
    return stations.pair_activity(staged).withColumn("_source_year", F.lit(year).cast("smallint"))


def last_days(staged: DataFrame, year: int, settings: Settings) -> DataFrame:
    """Daily last prices that may still be in force when the next year begins."""
    late = dt.date(year + 1, 1, 1) - dt.timedelta(days=settings.days_in_force)
    return in_force.daily_last_prices(staged.where(F.col("jour_releve") >= late))


def derive_years(log: SnapshotLog, base: Snapshot, settings: Settings) -> Parts:
    """All tables of the base's raw years; parts that nothing has touched are taken over."""
    spark, parts = log.spark, Parts(log, base)
    years = base.years("prix")
    folder = {year: base.raw["prix"][str(year)] for year in years}
    window = dt.timedelta(days=settings.days_in_force)
    first: dict[int, dt.date] = {}
    last: dict[int, dt.date] = {}

    def reports(year: int) -> DataFrame:
        return parts.read("staged_prices", str(year))

    for year in base.years("stations"):
        path = base.raw["stations"][str(year)]
        parts.part(
            "staged_stations", str(year), path, lambda path=path: staging.staged_stations(log.frame({"": path}, RAW_STATIONS))
        )
    for year in years:
        name, key = str(year), folder[year]
        parts.part("staged_prices", name, key, lambda key=key: staging.staged_prices(log.frame({"": key}, RAW_PRICES), settings))
        parts.part("last_reports", name, key, lambda year=year: last_reports(reports(year), settings))
        parts.part("activity", name, key, lambda year=year: year_activity(reports(year), year))
        parts.part("last_days", name, key, lambda year=year: last_days(reports(year), year, settings))
        parts.part("report_days", name, key, lambda year=year: in_force.report_days(reports(year)))
        days = parts.read("report_days", name).first()
        first[year], last[year] = days["premier_jour"], days["dernier_jour"]

    # the history, in the order of the years
    state, before = None, "none"
    for year in years:
        name, key = str(year), f"{folder[year]}|{before}"
        parts.part("price_changes", name, key, lambda year=year, state=state: changes.price_changes(reports(year), settings, state))
        parts.part("states", name, key, lambda year=year, state=state: changes.end_state(reports(year), state))
        state = parts.read("states", name)
        before = digest(state)

    everything = json.dumps(sorted(folder.items()))
    activity = parts.whole("activity")
    versions = stations.latest_versions(activity, parts.whole("staged_stations"))
    towns = json.dumps(sorted(base.raw["stations"].items()))
    parts.part("stations", "all", everything + towns, lambda: stations.dimension_of(stations.merged_activity(activity), versions))
    dimension = parts.read("stations", "all")
    parts.part("current_prices", "all", everything, lambda: current.current_prices(parts.whole("last_reports"), settings))

    # medians of the days of a year, from its reports and the last days of the year before
    places = digest(dimension.select("station_id", "est_autoroute", "code_postal"))
    start, end = min(first.values()), max(last.values())
    for year in years:
        name, opening, closing = str(year), dt.date(year, 1, 1), dt.date(year, 12, 31)
        earlier = digest(parts.read("last_days", str(year - 1))) if year - 1 in folder else "none"
        from_day, to_day = max(start, opening - window), min(end, closing)
        days = spark.createDataFrame([(from_day, to_day)], "premier_jour date, dernier_jour date")

        def periods(year: int = year, days: DataFrame = days) -> DataFrame:
            daily = in_force.daily_last_prices(reports(year))
            if year - 1 in folder:
                daily = daily.unionByName(parts.read("last_days", str(year - 1)))
            return in_force.periods_of(daily, settings, days)

        key = f"{folder[year]}|{earlier}|{from_day}|{to_day}"
        parts.part("daily_medians", name, key, lambda periods=periods, days=days: medians.daily_medians(periods(), days, settings))
        parts.part(
            "motorway_gap",
            name,
            f"{key}|{places}",
            lambda periods=periods, days=days: medians.motorway_gap(periods(), dimension, days, settings),
        )
    return parts


def stored_lake(spark: SparkSession, log: SnapshotLog, snapshot: Snapshot, settings: Settings | None = None) -> PriceLake:
    """The raw years of a snapshot, with its tables where it has them."""
    raw = [log.frame(snapshot.raw.get(entity, {}), schema) for entity, schema in (("prix", RAW_PRICES), ("stations", RAW_STATIONS))]
    names = ["staged_prices", "staged_stations", *TABLES]
    given = {name: log.frame(snapshot.tables[name]) for name in names if name in snapshot.tables}
    return PriceLake(*raw, settings, **given)
