"""Last known price of each (station, fuel) and its age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.config import Settings
from tarifa.functions.numbers import is_suspect
from tarifa.functions.time import clock_day, days_between, instant_to_clock
from tarifa.operators.staging import PAIR

#: Time and price as one whole number: microseconds from year 1 on, then thousandths above ``NO_PRICE``, which stands for NULL.
YEAR_ONE, NO_PRICE, PRICES = 62_135_596_800_000_000, 0, 1_000_000_000


def packed(at: Column, price: Column) -> Column:
    """A number in the order of (time, price), which hash tables hold; a NULL price is below all prices."""
    thousandths = F.coalesce((price * 1000).cast("bigint") + PRICES // 2, F.lit(NO_PRICE))
    wide = (F.unix_micros(at) + YEAR_ONE).cast("decimal(20,0)") * F.lit(PRICES).cast("decimal(10,0)")
    return (wide + thousandths.cast("decimal(10,0)")).cast("decimal(38,0)")


def unpacked(key: str) -> tuple[Column, Column]:
    """Time and price of a packed number."""
    micros = F.expr(f"{key} div {PRICES}BD")
    rest = (F.col(key) - micros.cast("decimal(20,0)") * F.lit(PRICES).cast("decimal(10,0)")).cast("bigint")
    price = F.when(rest != NO_PRICE, ((rest - PRICES // 2).cast("decimal(12,0)") / 1000).cast("decimal(8,3)"))
    return F.timestamp_micros(micros - YEAR_ONE), price


def current_prices(reports: DataFrame, settings: Settings) -> DataFrame:
    """Latest report per pair, dated against the latest report of all data.

    Ages are relative to the data, so a rerun gives the same result. ``reports`` may be the typed
    reports before conflict resolution: the maximum of (time, price, name) is the winner of its conflict.
    Reports are read once. Their maximum per pair and name of the fuel is taken in hash tables in the map tasks, so a busy pair
    sends one row per name and task; of the few names of a pair the latest one stays.
    """
    latest = reports.groupBy(*PAIR, "fuel").agg(F.max(packed(F.col("maj_at"), F.col("prix_litre"))).alias("cle"))
    at, price = unpacked("cle")
    named = latest.groupBy(*PAIR).agg(F.max(F.struct("cle", "fuel")).alias("dernier"))
    last = named.select(*PAIR, "dernier.cle", "dernier.fuel").select(*PAIR, "fuel", price.alias("prix_litre"), at.alias("maj_at"))
    reference = latest.agg(F.max("cle").alias("cle")).select(at.alias("reference_at"))

    def local_day(instant):
        return clock_day(instant_to_clock(instant, settings.zone))

    return last.crossJoin(F.broadcast(reference)).select(
        *PAIR,
        "fuel",
        "prix_litre",
        "maj_at",
        is_suspect(F.col("fuel_id"), F.col("prix_litre"), settings).alias("est_prix_suspect"),
        days_between(local_day(F.col("maj_at")), local_day(F.col("reference_at"))).alias("nombre_jours_depuis_maj"),
        "reference_at",
    )
