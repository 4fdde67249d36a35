"""A small repeatable sample of whole stations, for trying out checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRICED_STATIONS = 60
UNPRICED_STATIONS = 5


def sample_ids(raw_prices: DataFrame, imposed: list[str], years: int = 2) -> DataFrame:
    """Stations priced in exactly ``years`` years, some never priced, and the imposed ones.

    The order of the md5 makes the draw repeatable; each top-n keeps n rows per task. Rows are reduced to
    one per (station, year) in the map tasks before anything is counted.
    """
    per_year = raw_prices.groupBy("pdv_id", "_source_year").agg(F.count("prix_id").alias("n"))
    stations = per_year.groupBy("pdv_id").agg(
        F.count_if((F.col("n") > 0) & F.col("_source_year").isNotNull()).alias("annees"),
        F.sum("n").alias("n"),
    )

    def draw(condition, size: int) -> DataFrame:
        order = [F.md5("pdv_id"), F.col("pdv_id")]
        return stations.where(condition).orderBy(*order).limit(size).select("pdv_id")

    chosen = draw(F.col("annees") == years, PRICED_STATIONS).union(
        draw(F.col("n") == 0, UNPRICED_STATIONS)
    )
    if imposed:
        ids = F.explode(F.array(*[F.lit(i) for i in imposed])).alias("pdv_id")
        chosen = chosen.union(raw_prices.sparkSession.range(1).select(ids))
    return chosen.distinct()


def sample_rows(raw: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of the sampled stations. The caller's list may be long, so Spark judges the size of the ids."""
    return raw.join(ids, "pdv_id", "left_semi")
