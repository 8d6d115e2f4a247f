"""Sending tasks batch by batch, with the map of what is under way."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estatescope import workspace
from estatescope.operators import merge, messages, pending
from estatescope.streaming.queues import write_queue


def dispatch(waiting: DataFrame, task_map: DataFrame, model: str, source: str, folder: str, now: Column, size: int = 500) -> tuple[DataFrame, DataFrame]:
    """Send the next ``size`` waiting files; returns (messages sent, task map with them entered).

    Messages are made once and written down before they are queued, since their ids
    are random.
    """
    batch = pending.next_batch(waiting.select("id", "full_path"), size)
    made = workspace.materialize(messages.build_tasks(batch, model, source, now=now), "tasks")
    write_queue(made, f"{folder}/{messages.QUEUES[model.lower()]}")
    rows = made.select(
        "file_id", "correlation_id", F.lit("pending").alias("status"), F.lit(0).alias("attempts"), F.lit(None).cast("string").alias("last_error"),
        now.alias("created_at"), now.alias("updated_at"),
    )
    return made, merge.insert_if_absent(task_map.select(*rows.columns), rows, "correlation_id", "file_id")


@dataclass
class AutoBatch:
    """Sends the next batch while results come in: after every ``size`` answers, and whenever fewer than ``size`` files wait.

    waiting: the files still to be sent, given the task map; tasks: folder of the task map, one table per batch sent,
    numbered by the batch of results that led to it, so that a batch worked through again sends nothing twice.
    """

    waiting: Callable[[DataFrame], DataFrame]
    tasks: str
    model: str
    source: str
    folder: str
    schema: str
    now: Column
    size: int = 500
    processed: int = 0

    def task_map(self, spark: SparkSession) -> DataFrame:
        """Every task entered so far."""
        try:
            return spark.read.schema(self.schema).parquet(f"{self.tasks}/*")
        except AnalysisException:
            return spark.createDataFrame([], self.schema)

    def send(self, spark: SparkSession, number: int) -> int:
        """Send one batch under a number of its own; returns how many tasks it has."""
        known = self.task_map(spark)
        made, after = dispatch(self.waiting(known), known, self.model, self.source, self.folder, self.now, self.size)
        # written beside what is read: only the new rows
        fresh = after.join(made.select("correlation_id"), "correlation_id", "left_semi")
        fresh.write.mode("overwrite").parquet(f"{self.tasks}/sent={number}")
        return made.count()

    def after_batch(self, spark: SparkSession) -> Callable[[int, int], None]:
        """What a :class:`Reconciler` calls after each batch of results."""

        def run(number: int, handled: int) -> None:
            before, self.processed = self.processed, self.processed + handled
            if not handled:
                return
            left = self.waiting(self.task_map(spark)).limit(self.size).count()
            if left and (self.processed // self.size > before // self.size or left < self.size):
                self.send(spark, number)

        return run
