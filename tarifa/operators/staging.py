"""Typed price reports and typed station versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarifa.config import Settings
from tarifa.functions.text import repair_double_encoding, trim_spaces
from tarifa.functions.time import clock_day, clock_to_instant, read_clock
from tarifa.schemas import LINEAGE_COLUMNS

PAIR = ["station_id", "fuel_id"]


def typed_reports(raw_prices: DataFrame, settings: Settings) -> DataFrame:
    """Every non-empty report with its types, conflicts still in place.

    A narrow projection over the scan. Readers that are not disturbed by conflicting reports
    (a maximum, a set of days) use it and save the shuffle of ``staged_prices``.
    """
    clock = F.col("_clock")
    read = raw_prices.where(F.col("prix_id").isNotNull()).withColumn("_clock", read_clock(F.col("maj")))
    return read.select(
        F.col("pdv_id").cast("int").alias("station_id"),
        F.col("prix_id").cast("smallint").alias("fuel_id"),
        F.col("prix_nom").alias("fuel"),
        clock_to_instant(clock, settings.zone).alias("maj_at"),
        clock_day(clock).alias("jour_releve"),
        F.col("valeur").cast("decimal(8,3)").alias("prix_litre"),
        *LINEAGE_COLUMNS,
        F.col("pdv_id").alias("_pdv_id"),
        F.col("prix_id").alias("_prix_id"),
        F.col("maj").alias("_maj"),
    )


def staged_prices(raw_prices: DataFrame, settings: Settings) -> DataFrame:
    """One report per raw (station, fuel, time): the highest price wins a conflict.

    The rank limit is applied in each map task before the shuffle, so copies of one report, however
    many, reach the shuffle at most once per task. The key spreads a busy station over all tasks.
    ``maj_at`` follows from the raw time and changes no group; as the first key it lets the sort decide
    almost every order by one number. Equal prices are settled by name and lineage, the file as a hash:
    tables that do not use the file then need not shuffle its name.
    """
    same_report = Window.partitionBy("maj_at", "_pdv_id", "_prix_id", "_maj").orderBy(
        F.col("prix_litre").desc_nulls_last(),
        F.col("fuel").desc_nulls_last(),
        F.col("_source_year").desc_nulls_last(),
        F.col("_file"),
    )
    return (
        typed_reports(raw_prices, settings)
        .withColumn("_file", F.xxhash64("_source_file"))
        .withColumn("_rank", F.row_number().over(same_report))
        .where(F.col("_rank") == 1)
        .select(*PAIR, "fuel", "maj_at", "jour_releve", "prix_litre", *LINEAGE_COLUMNS)
    )


def staged_stations(raw_stations: DataFrame) -> DataFrame:
    """Typed station versions: cleaned text, coordinates in degrees, road type as a flag."""

    def degrees(name: str):
        return F.nullif(F.col(name), F.lit("")).cast("double") / 100000

    return raw_stations.select(
        F.col("pdv_id").cast("int").alias("station_id"),
        repair_double_encoding(trim_spaces(F.col("adresse"))).alias("adresse"),
        repair_double_encoding(trim_spaces(F.col("ville"))).alias("ville"),
        F.col("cp").alias("code_postal"),
        degrees("latitude").alias("latitude"),
        degrees("longitude").alias("longitude"),
        (F.col("pop") == "A").alias("est_autoroute"),
        *LINEAGE_COLUMNS,
    )
