"""Daily medians and the motorway gap, on the periods in which prices are in force.

Days are taken in blocks as long as the longest period. A period adds one to the count of its price on a run of days of a block;
a row holds the counts of a price on all days of a block, side by side. Reports are therefore never multiplied by their days:
what is shuffled is a price of a block, and the exact percentiles of all days of a block are taken in one pass over its prices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.config import Settings
from tarifa.functions.numbers import cut_thousandths, decimal_percentile, is_suspect
from tarifa.operators.in_force import block_day, day_blocks


def usable_periods(periods: DataFrame, days: DataFrame, settings: Settings) -> DataFrame:
    """Periods without suspect prices, from the first day whose window of past reports is complete.

    ``days`` is one row with the first day of all reports (``premier_jour``).
    """
    start = days.select(F.date_add("premier_jour", settings.days_in_force).alias("debut"))
    trusted = periods.where(~is_suspect(F.col("fuel_id"), F.col("prix_litre"), settings))
    return trusted.crossJoin(F.broadcast(start)).withColumn("jour", F.greatest("jour", "debut")).drop("debut")


def counted_prices(blocks: DataFrame, keys: list[str], length: int) -> DataFrame:
    """Per key and price in thousandths, the number of stations on each day of the block (n0, n1, ...)."""
    days = [F.expr(f"count_if(du <= {k} AND au >= {k}) AS n{k}") for k in range(length)]
    return blocks.groupBy("bloc", *keys, F.expr("CAST(prix_litre * 1000 AS BIGINT) AS milliemes")).agg(*days)


def per_day(counted: DataFrame, keys: list[str], length: int, sides: dict[str, str]) -> DataFrame:
    """Median (``<name>``) and number of stations (``n_<name>``) of each day and key.

    ``sides`` gives for each name the condition under which a row counts. The expressions of all days are texts: built column by
    column they would take longer than the query on a small table.
    """
    found, days = [], []
    for k in range(length):
        for name, condition in sides.items():
            found.append(F.expr(f"percentile(CASE WHEN {condition} THEN milliemes END, 0.5D, n{k}) AS {name}_{k}"))
            found.append(F.expr(f"sum(CASE WHEN {condition} THEN n{k} ELSE 0 END) AS n_{name}_{k}"))
        days.append(f"struct({k} AS rang, {', '.join(f'{name}_{k} AS {name}, n_{name}_{k} AS n_{name}' for name in sides)})")
    blocks = counted.groupBy("bloc", *keys).agg(*found)
    by_day = blocks.select("bloc", *keys, F.expr(f"inline(array({', '.join(days)}))"))
    medians = [cut_thousandths(F.col(name)).alias(name) for name in sides]
    return by_day.select(block_day(length).alias("jour"), *keys, *medians, *[f"n_{name}" for name in sides])


def daily_medians(periods: DataFrame, days: DataFrame, settings: Settings) -> DataFrame:
    """Median price and number of stations per day and fuel; each station counts once a day."""
    length, keys = settings.days_in_force + 1, ["fuel_id", "fuel"]
    blocks = day_blocks(usable_periods(periods, days, settings), length)
    found = per_day(counted_prices(blocks, keys, length), keys, length, {"prix": "TRUE"})
    return found.where("n_prix > 0").select(
        "jour", *keys, F.col("prix").alias("prix_median"), F.col("n_prix").alias("nombre_stations")
    )


def motorway_gap(periods: DataFrame, stations: DataFrame, days: DataFrame, settings: Settings) -> DataFrame:
    """Median on motorways minus median on roads, per day, area and fuel, where both exist.

    ``stations`` joins by station id; Spark broadcasts it while its size is below the session's
    threshold and shuffles both sides beyond it.
    """
    dimension = stations.select(
        "station_id",
        "est_autoroute",
        F.left(F.col("code_postal"), F.lit(2)).alias("departement"),
    )
    length, cell = settings.days_in_force + 1, ["departement", "fuel_id", "fuel"]
    blocks = day_blocks(usable_periods(periods, days, settings).join(dimension, "station_id"), length)
    counted = counted_prices(blocks, [*cell, "est_autoroute"], length)

    sides = {"autoroute": "est_autoroute", "route": "NOT est_autoroute"}
    found = per_day(counted, cell, length, sides)
    return found.where((F.col("n_autoroute") > 0) & (F.col("n_route") > 0)).select(
        "jour",
        *cell,
        F.col("autoroute").alias("prix_median_autoroute"),
        F.col("route").alias("prix_median_route"),
        F.col("n_autoroute").alias("nombre_stations_autoroute"),
        F.col("n_route").alias("nombre_stations_route"),
        (F.col("autoroute") - F.col("route")).alias("ecart"),
    )


def gap_summary(gap: DataFrame) -> DataFrame:
    """Per fuel: median and quartiles of the gap, its share of the road price, how often it is positive."""
    ratio = F.col("ecart").cast("double") / F.col("prix_median_route").cast("double")
    dearer = F.when(F.col("ecart") > 0, 1).otherwise(0)

    def gap_at(share: float) -> Column:
        return decimal_percentile(F.col("ecart"), share, precision=9).cast("double")

    return gap.groupBy("fuel_id").agg(
        gap_at(0.5).alias("ecart_median"),
        gap_at(0.25).alias("ecart_q1"),
        gap_at(0.75).alias("ecart_q3"),
        F.round(F.percentile(ratio, F.lit(0.5)), 4).alias("ecart_median_part"),
        F.round(F.avg(dearer), 4).alias("part_cas_autoroute_plus_chere"),
        F.count(F.lit(1)).alias("cas"),
        F.countDistinct("departement").alias("departements"),
    )


def gap_by_year(gap: DataFrame) -> DataFrame:
    return gap.groupBy("fuel_id", F.year("jour").cast("bigint").alias("annee")).agg(
        decimal_percentile(F.col("ecart"), 0.5, precision=9).cast("double").alias("ecart_median")
    )


def gap_by_day(gap: DataFrame) -> DataFrame:
    """Per fuel and day: median over the areas that can be compared, and how many there are."""
    return gap.groupBy("fuel_id", "jour").agg(
        decimal_percentile(F.col("ecart"), 0.5, precision=9).cast("double").alias("ecart_median"),
        F.count(F.lit(1)).alias("departements"),
    )
