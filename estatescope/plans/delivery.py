"""Queries on repeated deliveries (p6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatescope.operators.delivery import Spec, dropped_deliveries, first_rows
from estatescope.sources.tables import load

SPECS = {
    "task_messages": Spec("message_id", "delivery_id", "received_at"),
    "result_messages": Spec("correlation_id", "delivery_id", "received_at"),
    "moondream_task_map": Spec("correlation_id", "id", "created_at"),
}


#: The three tables in one store, told apart by name.
TOGETHER = Spec("identifier", "row_id", "received", scope="table_name")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries to drop: every row but the first with its identifier in its table."""
    parts = [
        load(spark, sf_dir, name).select(
            F.lit(name).alias("table_name"), F.col(s.identifier).alias("identifier"), F.col(s.row_id).cast("long").alias("row_id"),
            F.col(s.received).cast("timestamp_ntz").alias("received"),
        )
        for name, s in SPECS.items()
    ]
    return dropped_deliveries(reduce(DataFrame.unionByName, parts), TOGETHER, partitions=16)


def p6_delivery_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table: rows delivered, distinct identifiers, rows without one."""
    out = []
    for name, spec in SPECS.items():
        df = load(spark, sf_dir, name)
        firsts = first_rows(df, spec).agg(F.count("*").alias("identifiers"))
        rows = df.agg(
            F.count("*").alias("deliveries"),
            F.count_if(F.coalesce(F.trim(spec.identifier), F.lit("")) == "").alias("without_identifier"),
        )
        # both sides are single rows
        out.append(rows.join(F.broadcast(firsts), F.lit(True)).select(F.lit(name).alias("table_name"), "deliveries", "identifiers", "without_identifier"))
    return reduce(DataFrame.unionByName, out)


def _key(column: str) -> str:
    bare = rf"regexp_replace({column}, '^\s+|\s+$', '', 'g')"
    digits = rf"regexp_replace(regexp_replace(lower({bare}), '^urn:uuid:', ''), '[{{}}()\-\s]', '', 'g')"
    return f"case when {bare} = '' then null when regexp_full_match({digits}, '[0-9a-f]{{32}}') then {digits} else '=' || {bare} end"


_RANKED = " union all ".join(
    f"select '{t}' as table_name, {s.row_id} as row_id, {_key(s.identifier)} as k, {s.received} as received from {t}" for t, s in SPECS.items()
)

QUERIES = {"p6_found": p6_found, "p6_delivery_counts": p6_delivery_counts}
SQL = {
    "p6_found": f"""
        select table_name, cast(row_id as bigint) as row_id from (
          select table_name, row_id, row_number() over (partition by table_name, k order by received nulls last, row_id) as rn
          from ({_RANKED}) where k is not null) where rn > 1""",
    "p6_delivery_counts": f"""
        select table_name, cast(count(*) as bigint) as deliveries, cast(count(distinct k) as bigint) as identifiers,
               cast(sum(case when k is null then 1 else 0 end) as bigint) as without_identifier
        from ({_RANKED}) group by table_name""",
}
