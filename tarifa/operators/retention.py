"""Which archive copies to keep and which to publish."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.functions.time import iso_year

# Fixed value: hash characters at the end of a published name "<stem>_<hash>.zip".
HASH_CHARS = 12


def kept_archives(manifest: DataFrame) -> DataFrame:
    """The last copy of each ISO week, and of these the newest per content.

    Going back in time, a copy stays if it is the last of its week and its content is not kept yet. A
    kept content can only come from a newer last-of-week copy, so two maxima give the same result; both
    are combined in the map tasks.
    """
    copy = F.struct("jour", "sha256", "octets")
    last_of_week = (
        manifest.groupBy("annee", iso_year(F.col("jour")).alias("an"), F.weekofyear("jour").alias("se"))
        .agg(F.max(copy).alias("c"))
        .select("annee", "c.*")
    )
    return (
        last_of_week.groupBy("annee", "sha256")
        .agg(F.max(F.struct("jour", "octets")).alias("c"))
        .select("annee", "c.jour", "sha256", "c.octets")
    )


def dropped_archives(manifest: DataFrame) -> DataFrame:
    copy = ["annee", "jour", "sha256"]
    return manifest.join(kept_archives(manifest).select(*copy), copy, "left_anti")


def retention_summary(manifest: DataFrame) -> DataFrame:
    """Copies kept and dropped and bytes freed, per year."""

    def totals(frame: DataFrame, copies: str, size: str) -> DataFrame:
        return frame.groupBy("annee").agg(
            F.count(F.lit(1)).alias(copies), F.sum("octets").alias(size)
        )

    everything = totals(manifest, "copies", "octets")
    kept = totals(kept_archives(manifest), "gardes", "octets_gardes")
    return everything.join(kept, "annee").select(
        "annee",
        "gardes",
        (F.col("copies") - F.col("gardes")).alias("supprimes"),
        (F.col("octets") - F.col("octets_gardes")).alias("octets_liberes"),
    )


def publish_decisions(
    manifest: DataFrame, published: DataFrame, today: dt.date, force: bool = False, of_day: dt.date | None = None
) -> DataFrame:
    """Publish each archive or not, and why: the copies of one day, or the newest copy of each content.

    ``published`` holds (annee, nom). The hash at the end of a name is its key, so the match is an
    equality join on a deduplicated side instead of a suffix comparison of all pairs.
    """
    suffix = rf"_([0-9a-f]{{{HASH_CHARS}}})\.zip$"
    known = (
        published.select("annee", F.regexp_extract("nom", suffix, 1).alias("cle"))
        .where(F.col("cle") != "")
        .distinct()
        .withColumn("connu", F.lit(True))
    )
    sunday = today.isoweekday() == 7
    reason = (
        F.when(F.col("connu"), "already_published")
        .when(F.col("annee") < today.year, "past_year")
        .when(F.lit(force), "forced")
        .when(F.lit(sunday), "end_of_week")
        .otherwise("not_sunday")
    )
    copies = manifest if of_day is None else manifest.where(F.col("jour") == F.lit(of_day))
    copies = copies.groupBy("annee", "sha256").agg(F.max("jour").alias("jour"))
    return (
        copies.withColumn("cle", F.substring("sha256", 1, HASH_CHARS))
        .join(known, ["annee", "cle"], "left")
        .withColumn("raison", reason)
        .select(
            "annee",
            "jour",
            "sha256",
            (~F.col("raison").isin("already_published", "not_sunday")).alias("publier"),
            "raison",
        )
    )
