"""Small lakes built from literal rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from tarifa.config import FUELS, Settings
from tarifa.plans.lake import PriceLake
from tarifa.schemas import RAW_PRICES, RAW_STATIONS

LOADED = dt.datetime(2026, 9, 28, 10, 37, 30, tzinfo=dt.timezone.utc)


def lineage(year: int) -> tuple:
    return (year, f"x_annuel_{year}_telecharge_20260928.zip", "ab" * 32, LOADED)


def report(pdv, fuel, maj, price, year=None, name=None) -> tuple:
    """One raw price row; a fuel of None is an empty tag."""
    name = name or (FUELS.get(int(fuel)) if fuel else None)
    year = year or int(maj[:4])
    return (str(pdv), "4620100", "519800", "01000", "R", fuel and str(fuel), name, maj, price, *lineage(year))


def station(pdv, year, pop="R", cp="01000", adresse="1 RUE A", ville="V", lat="4620100", lon="519800"):
    return (str(pdv), lat, lon, cp, pop, adresse, ville, *lineage(year))


def prices(spark: SparkSession, rows: list[tuple]):
    return spark.createDataFrame(rows, RAW_PRICES)


def stations(spark: SparkSession, rows: list[tuple]):
    return spark.createDataFrame(rows, RAW_STATIONS)


def lake(spark: SparkSession, price_rows: list[tuple], station_rows: list[tuple] | None = None) -> PriceLake:
    known = sorted({(r[0], r[9]) for r in price_rows})
    rows = station_rows or [station(pdv, year) for pdv, year in known]
    return PriceLake(prices(spark, price_rows), stations(spark, rows), Settings())


def sample_lake(spark: SparkSession) -> PriceLake:
    """Two years of weekly reports of 12 stations for all fuels, with repeats, two conflicts and an
    address encoded twice: every check passes."""
    rows, places = [], []
    for pdv in range(1, 13):
        for year in (2025, 2026):
            kind = "A" if pdv % 3 == 0 else "R"
            text = "77 Avenue Ã\u0089douard" if pdv == 1 else f"{pdv} RUE"
            places.append(station(pdv, year, kind, "01000" if pdv % 2 else "02000", adresse=text))
            for fuel in FUELS:
                for step in range(20):
                    day = dt.datetime(year, 1, 1, 8) + dt.timedelta(days=3 * step, minutes=pdv)
                    price = 0.80 + (fuel not in (3, 4)) + 0.01 * ((pdv + step // 2 * fuel) % 9)
                    rows.append(report(pdv, fuel, day.isoformat(), f"{price:.3f}", year))
    for pdv in (1, 2):
        first = next(r for r in rows if r[0] == str(pdv))
        rows.append((*first[:8], "1.990", *first[9:]))
    rows.append(report(13, None, None, None, 2026))
    places.append(station(13, 2026, lat="", lon=""))
    return PriceLake(prices(spark, rows), stations(spark, places), Settings())
