"""History of price changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarifa.config import Settings
from tarifa.functions.numbers import is_suspect
from tarifa.functions.time import clock_day
from tarifa.operators.staging import PAIR

#: Month of a pair. The keys are never NULL, so that rows and carried values meet by plain equality, on one partitioning.
MONTH = ["_station", "_fuel", "_mois"]
NO_STATION, NO_FUEL = -1 << 31, -1 << 15
STATE = [*PAIR, "prix_litre", "changement_at"]


def month_keys(station: Column, fuel: Column, at: Column) -> list[Column]:
    month = F.coalesce(F.trunc(clock_day(at), "month"), F.lit("9999-12-01").cast("date"))
    return [
        F.coalesce(station, F.lit(NO_STATION)).alias("_station"),
        F.coalesce(fuel, F.lit(NO_FUEL).cast("smallint")).alias("_fuel"),
        month.alias("_mois"),
    ]


def pair_of_keys() -> list[Column]:
    return [
        F.nullif(F.col("_station"), F.lit(NO_STATION)).alias("station_id"),
        F.nullif(F.col("_fuel"), F.lit(NO_FUEL).cast("smallint")).alias("fuel_id"),
    ]


def month_rows(staged: DataFrame) -> DataFrame:
    """The first report of each month of a pair and the changes inside the month, numbered from 1 (``place``).

    ``avant`` and ``avant_at`` are the price and the time of the row before in the month.
    """
    by_month = Window.partitionBy(*MONTH).orderBy(F.col("maj_at").asc_nulls_last(), F.col("prix_litre").asc_nulls_last())
    return (
        staged.select("fuel", "maj_at", "prix_litre", *month_keys(F.col("station_id"), F.col("fuel_id"), F.col("maj_at")))
        .withColumn("avant", F.lag("prix_litre").over(by_month))
        .withColumn("rang", F.row_number().over(by_month))
        .where((F.col("rang") == 1) | ~F.col("prix_litre").eqNullSafe(F.col("avant")))
        .withColumn("place", F.row_number().over(by_month))
        .withColumn("avant_at", F.lag("maj_at").over(by_month))
    )


def month_summaries(rows: DataFrame) -> DataFrame:
    """One row per month of a pair: its first and last price, and when the last one began.

    The grouping follows the partitioning of the rows, so nothing is exchanged. A row has one name at most, so the names only
    confirm the number of rows; counting them keeps the columns below the exchange the same as those of the rows themselves,
    and Spark then reads one exchange twice instead of making two.
    """
    at = F.col("place")
    return rows.groupBy(*MONTH).agg(
        F.max(F.when(at == 1, F.col("prix_litre"))).alias("premier_prix"),
        F.max_by("prix_litre", at).alias("dernier_prix"),
        F.max_by("maj_at", at).alias("dernier_at"),
        F.greatest(F.max(at).cast("long"), F.count("fuel")).alias("lignes"),
    )


def carried(summaries: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The summaries with what each month finds: the price before it and the time of the last change before it.

    Only summaries move to the task of their pair, whatever the number of reports. ``state`` (``STATE``) is what an earlier
    part of the history left; it comes before all months.
    """
    if state is not None:
        keys = month_keys(F.col("station_id"), F.col("fuel_id"), F.lit(None).cast("timestamp"))[:2]
        opening = state.select(
            *keys, F.lit("0001-01-01").cast("date").alias("_mois"), F.col("prix_litre").alias("premier_prix"),
            F.col("prix_litre").alias("dernier_prix"), F.col("changement_at").alias("dernier_at"), F.lit(0).cast("long").alias("lignes"),
        )
        summaries = opening.unionByName(summaries)
    by_pair = Window.partitionBy("_station", "_fuel").orderBy("_mois")
    found = summaries.withColumn("prix_avant", F.lag("dernier_prix").over(by_pair))
    opens = ~F.col("premier_prix").eqNullSafe(F.col("prix_avant")) & (F.col("lignes") > 0)
    changed = F.when((F.col("lignes") != 1) | opens, F.col("dernier_at"))
    earlier = by_pair.rowsBetween(Window.unboundedPreceding, -1)
    return (
        found.withColumn("ouvre", opens)
        .withColumn("change_at", changed)
        .withColumn("change_avant", F.last("change_at", ignorenulls=True).over(earlier))
    )


def end_state(staged: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """(station_id, fuel_id, prix_litre, changement_at): last price of each pair and since when it holds, for a later part."""
    summaries = carried(month_summaries(month_rows(staged)), state)
    last = F.struct("_mois", "dernier_prix", F.coalesce("change_at", "change_avant").alias("depuis"))
    found = summaries.groupBy("_station", "_fuel").agg(F.max_by(last, "_mois").alias("s"))
    return found.select(
        *pair_of_keys(),
        F.col("s.dernier_prix").alias("prix_litre"),
        F.col("s.depuis").alias("changement_at"),
    )


def price_changes(staged: DataFrame, settings: Settings, state: DataFrame | None = None) -> DataFrame:
    """Reports whose price differs from the previous report of the same (station, fuel).

    The history of one pair is not sorted in one task. The reports of one month of a pair are sorted together and lose their
    repeats. A summary of each month then tells the others what they need to know of it: its last price, and since when that
    holds. Summaries are carried along the pair and come back to the rows of their month, of which only the first two depend on
    earlier months. A pair that holds a third of all rows is thus split by month, and its timeline has one row a month.

    ``state`` is the ``end_state`` of an earlier part of the history; reports are then those after it.
    """
    rows = month_rows(staged)
    carry = carried(month_summaries(rows), state).where("lignes > 0")
    met = rows.join(carry.select(*MONTH, "prix_avant", "change_avant", "ouvre"), MONTH)
    first = F.col("place") == 1
    before = F.when(first, F.col("prix_avant")).otherwise(F.col("avant"))
    # A row after the first of its month is a change already; the first one is judged by the months before.
    since = F.when(first | ((F.col("place") == 2) & ~F.col("ouvre")), F.col("change_avant")).otherwise(F.col("avant_at"))
    kept = met.where(~first | F.col("ouvre")).select(*pair_of_keys(), "fuel", "maj_at", "prix_litre", before.alias("avant"), since.alias("depuis"))
    return kept.select(
        *PAIR,
        "fuel",
        "maj_at",
        "prix_litre",
        F.col("avant").alias("prix_precedent"),
        (F.col("prix_litre") - F.col("avant")).alias("variation"),
        F.col("avant").isNull().alias("est_premier_releve"),
        is_suspect(F.col("fuel_id"), F.col("prix_litre"), settings).alias("est_prix_suspect"),
        F.col("depuis").alias("changement_precedent_at"),
    )
