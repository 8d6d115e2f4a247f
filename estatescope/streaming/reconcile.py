"""Request and reply: results come in as a stream, files and open tasks are brought up to date."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from estatescope.operators import merge, messages
from estatescope.streaming.queues import run_available


@dataclass
class Reconciler:
    """Turns result messages into text updates.

    updates: Parquet folder of (correlation_key, file_id, text, at), one folder per
    batch number, so that a batch run again overwrites its own rows; rejects: folder
    of dead letters; tasks: the task map; after: called with the number of every batch worked through and how many
    answers to known tasks it held.
    """

    spark: SparkSession
    tasks: DataFrame
    worker: str
    updates: str
    rejects: str
    after: Callable[[int, int], None] | None = None

    def _batch(self, batch: DataFrame, number: int) -> None:
        # the place of a message within its batch
        parsed = messages.validate_results(messages.parse_results(batch)).withColumn("place", F.monotonically_increasing_id()).persist()
        try:
            answers = messages.reconcile_results(parsed.drop("problem"), self.tasks, self.worker).persist()
            firsts = messages.first_answers(answers, "place")
            firsts.withColumn("at", F.col("at.p01")).write.mode("overwrite").parquet(f"{self.updates}/batch={number}")
            bad = parsed.where("problem is not null").select("raw", "problem")
            bad.write.mode("overwrite").json(f"{self.rejects}/batch={number}")
            handled = answers.count()
            answers.unpersist()
        finally:
            parsed.unpersist()
        if self.after is not None:
            self.after(number, handled)

    def run(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Work through the messages available; redelivered ones change nothing."""
        return run_available(stream, checkpoint, self._batch)

    def apply(self, files: DataFrame, now) -> tuple[DataFrame, DataFrame]:
        """(files with the texts put in, tasks still open)."""
        got = self.spark.read.parquet(self.updates).withColumn("done", F.lit(True))
        firsts = messages.first_answers(got, "batch", "at")
        texts = messages.answered_files(firsts).select(F.col("file_id").alias("id"), F.col("text").alias("text_excerpt"), F.col("chars").alias("text_chars_extracted"))
        return merge.apply_delta(files, texts, last_seen=now), messages.open_tasks(self.tasks, firsts)


def deduplicated(stream: DataFrame, delay: str = "1 day", key: str = "correlation_id", time: str = "received_at") -> DataFrame:
    """Stream without redeliveries of a key within ``delay``; needs an event-time column."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def answer_rates(stream: DataFrame, width: str = "1 hour", delay: str = "1 day", time: str = "received_at") -> DataFrame:
    """Results per model, status and event-time window; late ones count until the watermark passes."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), "model", "status").agg(F.count("*").alias("n"))
