"""Price in force of each (station, fuel) on each day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarifa.config import Settings
from tarifa.functions.numbers import is_suspect
from tarifa.operators.staging import PAIR


def report_days(reports: DataFrame) -> DataFrame:
    """One row: first and last day with a report."""
    return reports.agg(
        F.min("jour_releve").alias("premier_jour"), F.max("jour_releve").alias("dernier_jour")
    )


def daily_last_prices(staged: DataFrame) -> DataFrame:
    """Price of the day's last report. NULL prices only count when the day has no other.

    Price and time are both fixed-width, so this maximum is combined in hash tables without sorting.
    """
    priced_at = F.when(F.col("prix_litre").isNotNull(), F.col("maj_at"))
    return staged.groupBy(*PAIR, "fuel", F.col("jour_releve").alias("jour")).agg(
        F.max_by("prix_litre", priced_at).alias("prix_litre")
    )


def periods_of(daily: DataFrame, settings: Settings, bounds: DataFrame) -> DataFrame:
    """Periods of daily last prices; ``bounds`` is one row with the last day of all reports (``dernier_jour``).

    The window runs over days, not reports: a pair has at most one row per day and fuel name there, however often it reports.
    """
    history = Window.partitionBy(*PAIR).orderBy("jour", "fuel")
    return (
        daily.withColumn("suivant", F.lead("jour").over(history))
        .crossJoin(F.broadcast(bounds.select("dernier_jour")))
        .withColumn(
            "fin",
            F.least(
                F.coalesce(F.date_sub("suivant", 1), F.col("dernier_jour")),
                F.date_add("jour", settings.days_in_force),
                F.col("dernier_jour"),
            ),
        )
        .drop("suivant", "dernier_jour")
    )


def validity_periods(
    staged: DataFrame, settings: Settings, reports: DataFrame | None = None
) -> DataFrame:
    """From the report's day to the day before the next report, at most the days in force.

    ``reports`` gives the bounds without the conflict-resolution shuffle.
    """
    return periods_of(daily_last_prices(staged), settings, report_days(staged if reports is None else reports))


def expand_periods(periods: DataFrame, settings: Settings) -> DataFrame:
    """One row per day of each period; a period that ends before it starts gives none."""
    days = F.when(F.col("fin") >= F.col("jour"), F.sequence("jour", "fin"))
    return periods.select(
        *PAIR,
        "fuel",
        F.explode(days).alias("jour"),
        "prix_litre",
        F.col("jour").alias("releve_le"),
    ).withColumn("est_prix_suspect", is_suspect(F.col("fuel_id"), F.col("prix_litre"), settings))


def day_blocks(periods: DataFrame, length: int) -> DataFrame:
    """Each period with the block of ``length`` days it lies in (``bloc``) and its first and last day there, counted from 0.

    A period over the border of two blocks is a row of both. Periods are at most ``length`` days long, unless a defect makes
    them longer, so a report gives two rows at most, where a row per day would be up to ``length``.
    """
    first, last = F.unix_date("jour"), F.unix_date("fin")
    blocks = F.sequence(F.floor(first / length), F.floor(last / length))
    start = F.col("bloc") * length
    return (
        periods.where(F.col("fin") >= F.col("jour"))
        .withColumn("bloc", F.explode(blocks))
        .withColumn("du", F.greatest(first - start, F.lit(0)).cast("int"))
        .withColumn("au", F.least(last - start, F.lit(length - 1)).cast("int"))
    )


def block_day(length: int) -> Column:
    """The day of a block, counted from 0 (``rang``)."""
    return F.date_from_unix_date((F.col("bloc") * length + F.col("rang")).cast("int"))


def prices_in_force(
    staged: DataFrame, settings: Settings, reports: DataFrame | None = None
) -> DataFrame:
    return expand_periods(validity_periods(staged, settings, reports), settings)
