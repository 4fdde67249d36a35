"""Generic rules: each returns the offending rows of one frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outside(value: Column, low, high) -> Column:
    """``not between``: NULL when the value is NULL."""
    return ~value.between(low, high)


def duplicated(frame: DataFrame, keys: list[str], name: str) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def null_counts(frame: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row per column that holds NULLs, from a single pass over the frame."""
    counts = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    found = F.explode(
        F.array(*[F.struct(F.lit(c).alias("colonne"), F.col(c).alias("lignes")) for c in columns])
    )
    return (
        counts.select(found.alias("r"))
        .select(F.lit(table).alias("relation"), "r.colonne", "r.lignes")
        .where(F.col("lignes") > 0)
    )


def unexpected_values(frame: DataFrame, table: str, column: str, accepted: list) -> DataFrame:
    """Values outside the list with their number of rows; NULL passes."""
    return (
        frame.where(~F.col(column).isin(accepted))
        .groupBy(F.col(column).cast("string").alias("valeur"))
        .agg(F.count(F.lit(1)).alias("lignes"))
        .select(F.lit(table).alias("relation"), F.lit(column).alias("colonne"), "valeur", "lignes")
    )


def orphans(child: DataFrame, parent: DataFrame, table: str, column: str) -> DataFrame:
    """Keys of the child without a parent, with their number of rows; NULL keys pass.

    Child rows are counted per key before the join, so a busy key is one row in it.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("lignes"))
    return keys.join(parent.select(column), column, "left_anti").select(
        F.lit(table).alias("relation"), F.col(column).cast("bigint").alias("cle"), "lignes"
    )
