"""Queues as Structured Streaming sources and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from estatescope import workspace


def read_queue(spark: SparkSession, folder: str, per_trigger: int = 100) -> DataFrame:
    """Messages of a file queue, one JSON document per line, as ``value``; ``per_trigger`` files at a time."""
    return spark.readStream.option("maxFilesPerTrigger", per_trigger).text(folder)


def read_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Messages of a Kafka topic as ``value`` (needs the Kafka connector on the class path)."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def write_queue(messages: DataFrame, folder: str) -> None:
    """Append messages (column ``value``) to a file queue."""
    messages.select("value").write.mode("append").text(folder)


def write_by_id(messages: DataFrame, folder: str, key: str = "message_id") -> None:
    """Append messages as JSON, in a folder of its own for every message id."""
    messages.write.mode("append").partitionBy(key).json(folder)


def send_listing(walked: DataFrame, model: str, source: str, folder: str) -> DataFrame:
    """Queue a task for every file of a walk (path); returns the messages sent."""
    from estatescope.operators.messages import QUEUES, build_tasks

    files = walked.select(F.xxhash64("path").alias("id"), F.col("path").alias("full_path"))
    made = workspace.materialize(build_tasks(files, model, source), "tasks")
    write_queue(made, f"{folder}/{QUEUES[model.lower()]}")
    return made


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what is there in micro-batches and stop; the checkpoint acknowledges a batch once ``each`` returned."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
