"""The relations of the lake and how each is derived from the raw layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tarifa.config import Settings
from tarifa.operators import changes, current, in_force, medians, staging, stations


class PriceLake:
    """Lazy relations over two raw frames.

    Every relation is a DataFrame derived on first use. ``with_relations`` returns a lake in which some
    relations are given (tables written before, or a variant under test); what depends on them follows.
    """

    def __init__(
        self,
        raw_prices: DataFrame,
        raw_stations: DataFrame,
        settings: Settings | None = None,
        **given: DataFrame,
    ):
        self.raw_prices = raw_prices
        self.raw_stations = raw_stations
        self.settings = settings or Settings()
        self._given = dict(given)
        self._derived: dict[str, DataFrame] = {}
        #: Counts by name, observed while the given relations were written (``write_tables``).
        self.observed: dict[str, int] = {}

    def with_relations(self, **given: DataFrame) -> PriceLake:
        raw_prices = given.pop("raw_prices", self.raw_prices)
        raw_stations = given.pop("raw_stations", self.raw_stations)
        return PriceLake(raw_prices, raw_stations, self.settings, **{**self._given, **given})

    def rederived(self, **changed: DataFrame) -> PriceLake:
        """Like ``with_relations``, and given relations that derive from the changed ones are derived anew."""
        stale, todo = set(), list(changed)
        while todo:
            name = todo.pop()
            found = [n for n, sources in SOURCES.items() if name in sources and n not in stale]
            stale.update(found)
            todo += found
        kept = {name: frame for name, frame in self._given.items() if name not in stale}
        raw = {name: changed.get(name, getattr(self, name)) for name in ("raw_prices", "raw_stations")}
        return PriceLake(**raw, settings=self.settings, **{**kept, **{n: f for n, f in changed.items() if n not in raw}})

    def _get(self, name: str, derive) -> DataFrame:
        if name in self._given:
            return self._given[name]
        if name not in self._derived:
            self._derived[name] = derive()
        return self._derived[name]

    @property
    def reports(self) -> DataFrame:
        """Typed reports before conflict resolution, or the staged table once it is materialised."""
        if "staged_prices" in self._given:
            return self._given["staged_prices"]
        return self._get("reports", lambda: staging.typed_reports(self.raw_prices, self.settings))

    @property
    def staged_prices(self) -> DataFrame:
        return self._get(
            "staged_prices", lambda: staging.staged_prices(self.raw_prices, self.settings)
        )

    @property
    def staged_stations(self) -> DataFrame:
        return self._get("staged_stations", lambda: staging.staged_stations(self.raw_stations))

    @property
    def validity_periods(self) -> DataFrame:
        return self._get(
            "validity_periods",
            lambda: in_force.validity_periods(self.staged_prices, self.settings, self.reports),
        )

    @property
    def prices_in_force(self) -> DataFrame:
        return self._get(
            "prices_in_force",
            lambda: in_force.expand_periods(self.validity_periods, self.settings),
        )

    @property
    def price_changes(self) -> DataFrame:
        return self._get(
            "price_changes", lambda: changes.price_changes(self.staged_prices, self.settings)
        )

    @property
    def stations(self) -> DataFrame:
        return self._get(
            "stations",
            lambda: stations.station_dimension(
                self.staged_prices, self.staged_stations, self.reports
            ),
        )

    @property
    def station_attributes(self) -> DataFrame:
        """Station rows without their activity: the same stations, without counting reports."""
        if "stations" in self._given:
            return self._given["stations"]
        return self._get(
            "station_attributes",
            lambda: stations.latest_versions(self.reports, self.staged_stations),
        )

    @property
    def current_prices(self) -> DataFrame:
        return self._get(
            "current_prices", lambda: current.current_prices(self.reports, self.settings)
        )

    @property
    def daily_medians(self) -> DataFrame:
        return self._get(
            "daily_medians",
            lambda: medians.daily_medians(self.validity_periods, in_force.report_days(self.reports), self.settings),
        )

    @property
    def motorway_gap(self) -> DataFrame:
        return self._get(
            "motorway_gap",
            lambda: medians.motorway_gap(
                self.validity_periods, self.station_attributes, in_force.report_days(self.reports), self.settings
            ),
        )


# What each relation is derived from.
SOURCES = {
    "staged_prices": ["raw_prices"],
    "reports": ["raw_prices", "staged_prices"],
    "staged_stations": ["raw_stations"],
    "validity_periods": ["staged_prices"],
    "prices_in_force": ["validity_periods"],
    "price_changes": ["staged_prices"],
    "stations": ["staged_prices", "staged_stations"],
    "station_attributes": ["staged_prices", "staged_stations"],
    "current_prices": ["staged_prices"],
    "daily_medians": ["validity_periods"],
    "motorway_gap": ["validity_periods", "station_attributes"],
}

# Relations stored as tables, in the order in which they are written.
TABLES = ["stations", "price_changes", "current_prices", "daily_medians", "motorway_gap"]


def write_tables(lake: PriceLake, folder: str, rules: dict[str, dict[str, Column]] | None = None) -> PriceLake:
    """Materialise staging once, then each analytic table; returns the lake that reads them.

    Conflict resolution is the one shuffle all tables share, so its result is written first and the
    tables read it back. Written tables also survive the loss of executors. ``rules`` has for a relation the conditions whose
    rows are counted while it is written; the counts are the lake's ``observed``.
    """
    spark = lake.raw_prices.sparkSession
    observed: dict[str, int] = {}

    def store(name: str, frame: DataFrame) -> DataFrame:
        target = f"{folder}/{name}"
        conditions = (rules or {}).get(name, {})
        seen = Observation(f"rows of {name}")
        if conditions:
            counts = [F.count_if(condition).alias(rule) for rule, condition in conditions.items()]
            frame = frame.observe(seen, *counts)
        frame.write.mode("overwrite").parquet(target)
        if conditions:
            observed.update(seen.get)
        return spark.read.parquet(target)

    lake = lake.with_relations(
        staged_prices=store("staged_prices", lake.staged_prices),
        staged_stations=store("staged_stations", lake.staged_stations),
    )
    for name in TABLES:
        lake = lake.with_relations(**{name: store(name, getattr(lake, name))})
    lake.observed = observed
    return lake
