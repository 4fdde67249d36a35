"""Result files of a build run (JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.functions.text import json_integer, json_number, json_object, json_string
from tarifa.schemas import RUN_RESULTS

# Fixed value: the selection of a run over everything.
WHOLE_PROJECT = "tout le projet"


def read_run_results(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(RUN_RESULTS).option("multiLine", multi_line).json(path)


def run_summary(results: DataFrame) -> DataFrame:
    """Command, selection, time and duration of each run."""
    everything = F.array(F.lit(WHOLE_PROJECT))
    selection = F.when(F.size(F.coalesce("args.select", F.array())) > 0, F.col("args.select"))
    return results.select(
        F.col("args.which").alias("commande"),
        F.array_join(F.coalesce(selection, everything), " ").alias("selection"),
        F.col("metadata.generated_at").alias("genere_le"),
        F.round("elapsed_time", 1).alias("duree_s"),
    )


def status_counts(results: DataFrame) -> DataFrame:
    """Nodes per type and status, counted in the map tasks first."""
    node = results.select(F.explode("results").alias("r"))
    kind = F.split("r.unique_id", r"\.").getItem(0)
    return node.groupBy(kind.alias("type_noeud"), F.col("r.status").alias("statut")).agg(
        F.count(F.lit(1)).alias("noeuds")
    )


def execution_document(results: DataFrame) -> DataFrame:
    """Each run as the JSON object of the metadata export: (genere_le, execution), one row per run.

    A run is told by its time and command; its statuses are few, so the lists gathered here are small.
    """
    run = [F.col("metadata.generated_at").alias("genere_le"), F.col("args.which").alias("commande")]
    nodes = results.select(*run, F.explode_outer("results").alias("r"))
    kind = F.split("r.unique_id", r"\.").getItem(0)
    counts = nodes.groupBy("genere_le", "commande", kind.alias("type_noeud"), F.col("r.status").alias("statut")).agg(
        F.count("r").alias("noeuds")
    )
    member = F.concat(json_string(F.col("statut")), F.lit(":"), json_integer(F.col("noeuds")))
    by_type = counts.groupBy("genere_le", "commande", "type_noeud").agg(
        F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list(member)), ","), F.lit("}")).alias("o")
    )

    def statuses(kind: str):
        return F.coalesce(F.max(F.when(F.col("type_noeud") == kind, F.col("o"))), F.lit("{}"))

    by_run = by_type.groupBy("genere_le", "commande").agg(
        statuses("model").alias("modeles"), statuses("test").alias("tests")
    )
    chosen = F.size(F.coalesce("args.select", F.array())) > 0
    selection = F.when(chosen, F.to_json("args.select")).otherwise(json_string(F.lit(WHOLE_PROJECT)))
    runs = results.select(*run, selection.alias("selection"), "elapsed_time").alias("x")
    same = F.col("x.genere_le").eqNullSafe(F.col("y.genere_le")) & F.col("x.commande").eqNullSafe(F.col("y.commande"))
    return runs.join(by_run.alias("y"), same).select(
        "x.genere_le",
        json_object(
            commande=json_string(F.col("x.commande")),
            selection=F.col("selection"),
            genere_le=json_string(F.col("x.genere_le")),
            duree_s=json_number(F.round("elapsed_time", 1), 1),
            modeles=F.col("modeles"),
            tests=F.col("tests"),
        ).alias("execution"),
    )
