"""Queries on tasks, results and run status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatescope.functions import cleaning
from estatescope.operators import messages, status
from estatescope.plans.delivery import _key
from estatescope.sources.tables import load


def route_tasks(spark, sf_dir):
    return messages.route_tasks(load(spark, sf_dir, "task_messages")).groupBy("target_model", "queue").agg(F.count("*").alias("n"))


def build_tasks(spark, sf_dir):
    """OCR tasks of the files that wait, with ids that follow from the file's."""
    from estatescope.operators.pending import pending_ocr

    waiting = pending_ocr(load(spark, sf_dir, "files"))
    made = messages.build_tasks(
        waiting, "ocr", "audit", message_id=F.concat(F.lit("m"), F.col("id").cast("string")), correlation_id=F.concat(F.lit("c"), F.col("id").cast("string")),
        now=F.lit("2025-01-01 00:00:00").cast("timestamp"),
    )
    return made.select("file_id", "queue", F.get_json_object("value", "$.correlation_id").alias("correlation_id"), F.get_json_object("value", "$.payload.file_path").alias("file_path"))


def validate_results(spark, sf_dir):
    return messages.validate_results(load(spark, sf_dir, "result_messages")).select("delivery_id", "schema_version", "problem")


def extract_result_text(spark, sf_dir):
    return messages.extract_result_text(load(spark, sf_dir, "result_messages")).select("delivery_id", "text")


def reconcile_results(spark, sf_dir):
    """Answers of the picture service joined to their files."""
    return messages.reconcile_results(load(spark, sf_dir, "result_messages"), load(spark, sf_dir, "moondream_task_map"), "MoondreamWorker").select("delivery_id", "file_id", "done")


def _tasks(spark, sf_dir, worker):
    """Tasks of a worker: its map for pictures, the messages sent for OCR."""
    if worker == "MoondreamWorker":
        return load(spark, sf_dir, "moondream_task_map").select("correlation_id", "file_id")
    sent = load(spark, sf_dir, "task_messages").where(messages.normal_model(F.col("target_model")) == "ocr")
    return sent.select("correlation_id", F.get_json_object("payload", "$.file_id").try_cast("long").alias("file_id")).where("file_id is not null")


def _after_results(spark, sf_dir, each):
    out = []
    for worker in ("MoondreamWorker", "OCRWorker"):
        tasks = _tasks(spark, sf_dir, worker)
        answers = messages.reconcile_results(load(spark, sf_dir, "result_messages"), tasks, worker)
        out.append(each(tasks, messages.first_answers(answers, "received_at", "delivery_id")).withColumn("worker", F.lit(worker)))
    return out[0].unionByName(out[1])


def reconcile_apply(spark, sf_dir):
    """Texts the answers of both workers put into files."""
    return _after_results(spark, sf_dir, lambda tasks, firsts: messages.answered_files(firsts))


def open_tasks(spark, sf_dir):
    """Tasks of both workers that no answer has closed."""
    return _after_results(spark, sf_dir, lambda tasks, firsts: messages.open_tasks(tasks, firsts))


def retry_state(spark, sf_dir):
    return messages.retry_state(load(spark, sf_dir, "result_messages"))


def strip_json_fence(spark, sf_dir):
    """Replies read: fenced with and without a language, bare, fenced twice, cut off, with text around, and none."""
    body = F.to_json(F.struct("categoria", "anio", "proyecto"))
    shapes = (
        F.concat(F.lit("\n```json\n"), body, F.lit("\n```  \n")), F.concat(F.lit("```\n"), body, F.lit("\n```")), F.concat(F.lit("  "), body, F.lit("\n")),
        F.concat(F.lit("```json\n```json\n"), body, F.lit("\n```\n```")), F.concat(F.lit("```json\n"), F.expr("substring(to_json(struct(id, 'x')), 1, 5)")),
        F.concat(F.lit("Here it is: "), body), F.lit("no JSON"), F.lit(None).cast("string"),
    )
    shape = F.pmod(F.col("id"), F.lit(len(shapes)))
    reply = F.coalesce(*[F.when(shape == i, r) for i, r in enumerate(shapes)])
    c = cleaning.classification(reply)
    return load(spark, sf_dir, "files").select("id", c["categoria"].alias("categoria"), c["anio"].alias("anio"), c["proyecto"].alias("proyecto"))


_STATUS = """case event_type when 'click' then 'finished' when 'view' then 'finished' when 'purchase' then 'finished'
    when 'signup' then case when user_id % 5 = 0 then 'cancelled' else 'finished' end
    else case user_id % 4 when 0 then 'error' when 1 then 'running' when 2 then 'pending' else 'finished' end end"""
#: Runs, phases and scripts out of the event log: a user is a run, an hour of the day a phase, an event a script.
_SCRIPTS = f"select event_id as script_id, user_id * 24 + hour(ts) as phase_id, event_type as script_name, {_STATUS} as status from events"


def _scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_SCRIPTS.replace("from events", "from {events}"), events=load(spark, sf_dir, "events"))


def _phases(scripts: DataFrame) -> DataFrame:
    return status.status_rollup(scripts, "phase_id").select(
        "phase_id", F.floor(F.col("phase_id") / 24).alias("run_id"), (F.col("phase_id") % 24).cast("int").alias("phase_number"), "status"
    )


def status_rollup(spark, sf_dir):
    """Status of every run from its phases', of every phase from its scripts'."""
    return status.status_rollup(_phases(_scripts(spark, sf_dir)), "run_id")


def run_status_tree(spark, sf_dir):
    """Every script of every phase of every run, read back from the documents of the runs."""
    scripts = _scripts(spark, sf_dir)
    phases = _phases(scripts)
    tree = status.run_status_tree(status.status_rollup(phases, "run_id"), phases, scripts)
    each = tree.select("run_id", "status", F.size("phases").alias("phases"), F.posexplode("phases").alias("place", "p"))
    names = F.array_join(F.transform("p.scripts", lambda s: F.concat_ws("=", s["script_name"], s["script_status"])), ",")
    return each.select("run_id", "status", "phases", "place", "p.phase_id", "p.phase_number", "p.phase_status", names.alias("scripts"))


QUERIES = {
    "route_tasks": route_tasks, "build_tasks": build_tasks, "validate_results": validate_results, "extract_result_text": extract_result_text,
    "reconcile_results": reconcile_results, "reconcile_apply": reconcile_apply, "open_tasks": open_tasks, "retry_state": retry_state, "strip_json_fence": strip_json_fence, "status_rollup": status_rollup,
    "run_status_tree": run_status_tree,
}

_PROBLEM = """case when coalesce(trim(message_id), '') = '' then 'message_id' when coalesce(trim(correlation_id), '') = '' then 'correlation_id'
    when coalesce(trim(model), '') = '' then 'model' when not coalesce(status in ('success', 'error'), false) then 'status' end"""
_J = "try_cast(result as json)"
_OBJ = f"coalesce(json_type({_J}) = 'OBJECT', false)"
_TEXT = "coalesce(" + ", ".join(f"case when json_type({_J}, '$.{k}') = 'VARCHAR' then json_extract_string({_J}, '$.{k}') end" for k in cleaning.TEXT_KEYS) + ")"
_EXTRACT = f"case when status = 'success' then case when {_OBJ} then coalesce({_TEXT}, result) else result end end"
_ROLL = """case when bool_or(status = 'running') then 'running' when bool_or(status = 'error') then 'error' when bool_or(status = 'cancelled') then 'cancelled'
    when bool_and(status = 'finished') then 'finished' else 'failed' end"""
_PHASES = f"(select phase_id, phase_id // 24 as run_id, cast(phase_id % 24 as integer) as phase_number, {_ROLL} as status from ({_SCRIPTS}) group by phase_id)"

_TASKS = f"""(select 'MoondreamWorker' as worker, correlation_id, file_id, {_key("correlation_id")} as k from moondream_task_map union all
        select * from (select 'OCRWorker', correlation_id, try_cast(json_extract_string(try_cast(payload as json), '$.file_id') as bigint) as file_id, {_key("correlation_id")}
          from task_messages where lower(target_model) = 'ocr') where file_id is not null)"""
_FIRSTS = f"""(select worker, k, file_id, text, received_at, delivery_id from (
          select t.worker, t.k, t.file_id, {_EXTRACT} as text, received_at, delivery_id, row_number() over (partition by t.worker, t.k order by received_at nulls last, delivery_id nulls last) as rn
          from (select *, {_key("correlation_id")} as k from result_messages where {_PROBLEM} is null) r
          join (select worker, k, min(file_id) as file_id from {_TASKS} where k is not null group by 1, 2) t on t.k = r.k and t.worker = r.model
          where {_EXTRACT} is not null) where rn = 1)"""

SQL = {
    "reconcile_apply": f"""select worker, file_id, text, cast(length(text) as integer) as chars from (select *, row_number() over (partition by worker, file_id
        order by received_at is null desc, received_at desc, delivery_id desc, k desc) as rn from {_FIRSTS}) where rn = 1""",
    "open_tasks": f"select worker, correlation_id, file_id from {_TASKS} t where not exists (select 1 from {_FIRSTS} f where f.worker = t.worker and f.k = t.k)",
    "route_tasks": """select target_model, case lower(target_model) when 'ocr' then 'cola_modelo_ocr' when 'moondream' then 'cola_modelo_moondream'
        when 'embeddings' then 'cola_modelo_embeddings' end as queue, cast(count(*) as bigint) as n from task_messages group by 1, 2""",
    "build_tasks": """select id as file_id, 'cola_modelo_ocr' as queue, 'c' || cast(id as varchar) as correlation_id, full_path as file_path from files
        where ocr_needed and (text_excerpt is null or text_excerpt = '') and canonical_id is null""",
    "validate_results": f"select delivery_id, coalesce(schema_version, '1.0') as schema_version, {_PROBLEM} as problem from result_messages",
    "extract_result_text": f"select delivery_id, {_EXTRACT} as text from result_messages",
    "reconcile_results": f"""select r.delivery_id, m.file_id, {_EXTRACT} is not null as done from (select *, {_key("correlation_id")} as k from result_messages
        where model = 'MoondreamWorker' and {_PROBLEM} is null) r
        join (select {_key("correlation_id")} as k, min(file_id) as file_id from moondream_task_map group by 1) m on m.k = r.k""",
    "retry_state": f"""select k as correlation_key, cast(count(*) as bigint) as attempts, cast(count(*) filter (where status = 'error') as bigint) as errors,
        not coalesce(bool_or(status = 'success'), false) and bool_and(coalesce(error.retryable, true)) and count(*) filter (where status = 'error') < 3 as retry
        from (select *, {_key("correlation_id")} as k from result_messages) where k is not null group by k""",
    "strip_json_fence": "select id, " + ", ".join(f"case when id % 8 in (0, 1, 2) then coalesce({c}, 'Desconocido') else 'Desconocido' end as {c}" for c in ("categoria", "anio", "proyecto")) + " from files",
    "status_rollup": f"select run_id, {_ROLL} as status from {_PHASES} group by run_id",
    "run_status_tree": f"""with p as (select * from {_PHASES}), r as (select run_id, cast(count(*) as integer) as n, {_ROLL} as status from p group by run_id),
          s as (select phase_id, string_agg(script_name || '=' || status, ',' order by script_id) as scripts from ({_SCRIPTS}) group by phase_id)
        select r.run_id, r.status, r.n as phases, cast(row_number() over (partition by r.run_id order by p.phase_number, p.phase_id) - 1 as integer) as place,
          p.phase_id, p.phase_number, p.status as phase_status, s.scripts from r join p using (run_id) join s using (phase_id)""",
}
