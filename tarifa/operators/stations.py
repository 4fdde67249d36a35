"""Station dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ATTRIBUTES = [
    "station_id",
    "adresse",
    "ville",
    "code_postal",
    "latitude",
    "longitude",
    "est_autoroute",
]


def priced_versions(reports: DataFrame, stations: DataFrame) -> DataFrame:
    """Station versions of the years in which the station reported a price."""
    years = reports.select("station_id", "_source_year").distinct()
    return stations.join(years, ["station_id", "_source_year"], "left_semi")


def latest_versions(reports: DataFrame, stations: DataFrame) -> DataFrame:
    """The newest priced version of each station (a version without a price may be misplaced)."""
    newest = Window.partitionBy("station_id").orderBy(
        F.col("_source_year").desc_nulls_last(),
        F.col("_source_file").desc_nulls_last(),
        F.col("adresse").asc_nulls_last(),
    )
    return (
        priced_versions(reports, stations)
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") == 1)
        .select(*ATTRIBUTES, F.col("_source_year").alias("annee_version"))
    )


def pair_activity(staged: DataFrame) -> DataFrame:
    """First and last report and number of reports of each (station, fuel), reduced in the map tasks."""
    return staged.groupBy("station_id", "fuel_id").agg(
        F.min("maj_at").alias("premier"),
        F.max("maj_at").alias("dernier"),
        F.count(F.lit(1)).alias("releves"),
    )


def merged_activity(parts: DataFrame) -> DataFrame:
    """The activity of several parts of the history as one."""
    return parts.groupBy("station_id", "fuel_id").agg(
        F.min("premier").alias("premier"), F.max("dernier").alias("dernier"), F.sum("releves").alias("releves")
    )


def dimension_of(activity: DataFrame, versions: DataFrame) -> DataFrame:
    """The versions with the activity of their station. One row per (station, fuel) makes the number of fuels a plain count."""
    by_station = activity.groupBy("station_id").agg(
        F.min("premier").alias("premier_releve_at"),
        F.max("dernier").alias("dernier_releve_at"),
        F.count("fuel_id").alias("nombre_fuels"),
        F.sum("releves").alias("nombre_releves"),
    )
    return versions.join(by_station, "station_id").select(
        *ATTRIBUTES,
        "premier_releve_at",
        "dernier_releve_at",
        "nombre_fuels",
        "nombre_releves",
        "annee_version",
    )


def station_dimension(staged: DataFrame, stations: DataFrame, reports: DataFrame | None = None) -> DataFrame:
    """One row per station with at least one price, with its activity."""
    versions = latest_versions(staged if reports is None else reports, stations)
    return dimension_of(pair_activity(staged), versions)
