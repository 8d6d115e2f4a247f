"""Tasks to outside services and their results, as relations (batch or stream)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatescope.functions.cleaning import result_text
from estatescope.functions.identifiers import uuid_key
from estatescope.schemas import RESULT_MESSAGE

#: Models and the queues they are served by, and the workers that answer.
QUEUES = {"ocr": "cola_modelo_ocr", "moondream": "cola_modelo_moondream", "embeddings": "cola_modelo_embeddings"}
WORKERS = {"ocr": "OCRWorker", "moondream": "MoondreamWorker", "embeddings": "EmbeddingsWorker"}
STATUSES = ("success", "error")


def normal_model(model: Column) -> Column:
    """Lower-case name of a known model, else null."""
    name = F.lower(model)
    return F.when(name.isin(*QUEUES), name)


def queue_of(model: Column) -> Column:
    """Queue that serves a model; null for an unknown one."""
    table = F.create_map(*[F.lit(x) for pair in QUEUES.items() for x in pair])
    return table[normal_model(model)]


def route_tasks(tasks: DataFrame) -> DataFrame:
    """Tasks with the queue they go to."""
    return tasks.withColumn("queue", queue_of(F.col("target_model")))


def build_tasks(files: DataFrame, model: str, source: str, prompt: str | None = None, message_id: Column | None = None,
                correlation_id: Column | None = None, now: Column | None = None) -> DataFrame:
    """Task messages for files (id, full_path), as a row and as the JSON put on the queue.

    Ids are random unless given; messages are made when the frame runs, so write it once.
    """
    if model.lower() not in QUEUES:
        raise ValueError(f"unknown model {model!r}")
    payload = {"file_path": F.col("full_path"), "file_id": F.col("id").cast("string")}
    if prompt is not None:
        payload["prompt"] = F.lit(prompt)
    made = files.select(
        F.col("id").alias("file_id"), (F.uuid() if message_id is None else message_id).alias("message_id"),
        (F.uuid() if correlation_id is None else correlation_id).alias("correlation_id"), F.lit("1.0").alias("schema_version"),
        F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("timestamp"), F.lit(source).alias("source"),
        F.lit(model.lower()).alias("target_model"), F.lit(0).alias("retry_count"), F.lit(3).alias("max_retries"),
        F.create_map(*[x for k, v in payload.items() for x in (F.lit(k), v)]).alias("payload"),
    )
    fields = [c for c in made.columns if c != "file_id"]
    return made.withColumn("queue", F.lit(QUEUES[model.lower()])).withColumn("value", F.to_json(F.struct(*fields)))


def parse_results(raw: DataFrame, column: str = "value") -> DataFrame:
    """JSON result messages as columns; an unreadable one gives nulls and keeps its text in ``raw``."""
    return raw.select(F.col(column).alias("raw"), F.from_json(column, RESULT_MESSAGE).alias("m")).select("raw", "m.*")


def problem(status: str = "status") -> Column:
    """Why a result message is invalid, null if it is valid."""
    return (
        F.when(F.coalesce(F.trim("message_id"), F.lit("")) == "", "message_id")
        .when(F.coalesce(F.trim("correlation_id"), F.lit("")) == "", "correlation_id")
        .when(F.coalesce(F.trim("model"), F.lit("")) == "", "model")
        .when(~F.coalesce(F.col(status).isin(*STATUSES), F.lit(False)), "status")
    )


def validate_results(results: DataFrame) -> DataFrame:
    """Results with defaults filled in and ``problem``: null where valid, else the first field at fault."""
    return results.withColumn("schema_version", F.coalesce("schema_version", F.lit("1.0"))).withColumn("problem", problem())


def extract_result_text(results: DataFrame) -> DataFrame:
    """Results with the ``text`` they carry."""
    return results.withColumn("text", result_text(F.col("status"), F.col("result")))


def reconcile_results(results: DataFrame, tasks: DataFrame, worker: str, key: str = "correlation_id") -> DataFrame:
    """Answers of one worker joined to the file their task was for.

    tasks: (correlation_id, file_id); ids are compared however written, and ``correlation_key`` is what equal ones
    share. A result of no known task is dropped. ``done`` is false for errors and empty answers, whose task
    stays open.
    """
    known = keyed_tasks(tasks, key)
    mine = validate_results(results).where((F.col("model") == worker) & F.col("problem").isNull())
    answered = extract_result_text(mine.withColumn("correlation_key", uuid_key(F.col(key))))
    return answered.join(known, "correlation_key").withColumn("done", F.col("text").isNotNull())


def keyed_tasks(tasks: DataFrame, key: str = "correlation_id") -> DataFrame:
    """(correlation_key, file_id) of every task; of several files under one id the least counts."""
    keyed = tasks.select(uuid_key(F.col(key)).alias("correlation_key"), "file_id").where("correlation_key is not null")
    return keyed.groupBy("correlation_key").agg(F.min("file_id").alias("file_id"))


def first_answers(answers: DataFrame, *order: str) -> DataFrame:
    """(correlation_key, file_id, text, at) of the first answer of every task, by the columns ``order`` (nulls last)."""
    place = F.struct(*[x.alias(f"p{i}{j}") for i, c in enumerate(order) for j, x in enumerate((F.col(c).isNull(), F.col(c)))])
    one = answers.where("done").groupBy("correlation_key").agg(F.min(F.struct(place.alias("at"), "file_id", "text")).alias("r"))
    return one.select("correlation_key", "r.file_id", "r.text", "r.at")


def answered_files(firsts: DataFrame) -> DataFrame:
    """(file_id, text, chars): of several tasks of one file the one answered last writes last."""
    last = firsts.groupBy("file_id").agg(F.max(F.struct("at", "correlation_key", "text"))["text"].alias("text"))
    return last.select("file_id", "text", F.length("text").alias("chars"))


def open_tasks(tasks: DataFrame, firsts: DataFrame, key: str = "correlation_id") -> DataFrame:
    """Tasks none of whose answers, however the id is written, has been stored."""
    done = firsts.select("correlation_key").distinct()
    marked = tasks.withColumn("__k", uuid_key(F.col(key)))
    return marked.join(done, marked["__k"] == done["correlation_key"], "left_anti").drop("__k")


def retry_state(results: DataFrame, most: int = 3) -> DataFrame:
    """(correlation_id key, attempts, errors, retry): whether a task that failed may be sent again."""
    key = uuid_key(F.col("correlation_id"))
    g = results.groupBy(key.alias("correlation_key")).agg(
        F.count("*").alias("attempts"), F.count_if(F.col("status") == "error").alias("errors"),
        F.bool_or(F.col("status") == "success").alias("__ok"), F.every(F.coalesce("error.retryable", F.lit(True))).alias("__may"),
    )
    return g.where("correlation_key is not null").withColumn("retry", ~F.coalesce("__ok", F.lit(False)) & F.col("__may") & (F.col("errors") < most)).drop("__ok", "__may")
