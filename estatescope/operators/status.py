"""Status of runs, phases and scripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rolled_up(child: Column) -> Column:
    """Status of a parent from its children's: running, error and cancelled prevail in this order, all
    finished is finished, anything else is failed; null without children."""
    has = lambda s: F.bool_or(child == s)
    return (
        F.when(F.count(child) == 0, F.lit(None).cast("string"))
        .when(has("running"), "running").when(has("error"), "error").when(has("cancelled"), "cancelled")
        .when(F.every(child == "finished"), "finished").otherwise("failed")
    )


def status_rollup(children: DataFrame, parent: str, status: str = "status") -> DataFrame:
    """(parent, status) of every parent of the children given."""
    return children.groupBy(parent).agg(rolled_up(F.col(status)).alias("status"))


def update_status(parents: DataFrame, children: DataFrame, parent: str) -> DataFrame:
    """Parents with the rolled-up status; cancelled stays, and so does the status of a parent without children."""
    new = status_rollup(children, parent).withColumnRenamed("status", "__new")
    kept = F.when((F.col("status") == "cancelled") | F.col("__new").isNull(), F.col("status")).otherwise(F.col("__new"))
    return parents.join(new, parent, "left").withColumn("status", kept).drop("__new")


def run_status_tree(runs: DataFrame, phases: DataFrame, scripts: DataFrame) -> DataFrame:
    """(run_id, status, phases): each run with its phases, each phase with its scripts, in order."""
    own = scripts.groupBy("phase_id").agg(F.array_sort(F.collect_list(F.struct("script_id", "script_name", F.col("status").alias("script_status")))).alias("scripts"))
    with_scripts = phases.join(own, "phase_id", "left").withColumn("scripts", F.coalesce("scripts", F.array().cast(own.schema["scripts"].dataType)))
    nested = with_scripts.groupBy("run_id").agg(
        F.array_sort(F.collect_list(F.struct("phase_number", "phase_id", F.col("status").alias("phase_status"), "scripts"))).alias("phases")
    )
    return runs.select("run_id", "status").join(nested, "run_id", "left")
