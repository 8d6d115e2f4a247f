"""At-least-once delivery: a store that keeps exactly one row per identifier.

History lies in partitions by the time a row was received. An *identifier index*,
stored in buckets of the identifier's key, names for every identifier its winner and the partition that
holds it. A batch of incoming rows first keeps one row per key; these are looked up in the index
buckets they fall into. Only partitions that gain a row, or whose winner is beaten by an earlier copy, are
combined with the incoming rows and replaced, and so are the index buckets of those keys.

Replacement is atomic: every version of a partition is a folder of its own, and a
version becomes visible when its manifest, a single file, is renamed into place. The rename
fails if another writer has published that version meanwhile, so no batch is lost.
Folders no longer named by the manifests kept are removed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from estatescope import workspace
from estatescope.functions.identifiers import uuid_key

_KEY, _PART, _AT, _ROW, _BUCKET = "__key", "__part", "__at", "__row", "__bucket"
#: Versions that stay readable after a newer one is published.
KEPT_VERSIONS = 2


class ConcurrentMerge(RuntimeError):
    """Another writer published first; merge the batch again."""


@dataclass(frozen=True)
class Spec:
    """Which columns identify a delivery.

    identifier: the message identifier, compared by :func:`uuid_key`
    row_id:     unique number of the delivered row, the tie-break
    received:   time of delivery; the earliest wins, a null time comes last
    scope:      column that keeps identifiers and row ids of different kinds apart, if any
    period:     unit of time of a history partition
    """

    identifier: str
    row_id: str
    received: str
    scope: str | None = None
    period: str = "DAY"

    def key(self) -> Column:
        key = uuid_key(F.col(self.identifier))
        return key if self.scope is None else F.when(key.isNotNull(), F.concat(F.coalesce(F.col(self.scope), F.lit("")), F.lit("|"), key))

    def partition(self) -> Column:
        """Name of the history partition of a row."""
        day = F.coalesce(F.date_format(F.date_trunc(self.period, F.col(self.received).cast("timestamp_ntz")), "yyyy-MM-dd"), F.lit("none"))
        return day if self.scope is None else F.concat(F.coalesce(F.col(self.scope), F.lit("")), F.lit("."), day)


def _order(spec: Spec) -> Column:
    far = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    return F.struct(F.coalesce(F.col(spec.received).cast("timestamp_ntz"), far).alias(_AT), F.col(spec.row_id).alias(_ROW))


def first_rows(df: DataFrame, spec: Spec, key: Column | None = None) -> DataFrame:
    """One ``(__key, __at, __row)`` per identifier: the smallest time, then row id.

    An aggregate with map-side combine, so an identifier holding any share of the
    rows reaches its reducer as one row per map task.
    """
    rows = df.select((spec.key() if key is None else key).alias(_KEY), _order(spec).alias("__best"))
    rows = rows.where(F.col(_KEY).isNotNull() & F.col(f"__best.{_ROW}").isNotNull())
    best = rows.groupBy(_KEY).agg(F.min("__best").alias("__best"))
    return best.select(_KEY, f"__best.{_AT}", f"__best.{_ROW}")


class DeliveryStore:
    """Partitioned store of deliveries with one row per identifier.

    partitions: number of index buckets; keys are spread over them by hash
    """

    def __init__(self, spark: SparkSession, path: str, spec: Spec, partitions: int = 64):
        self.spark, self.path, self.spec, self.partitions = spark, path.rstrip("/"), spec, partitions

    # -- manifest -----------------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        target, fs = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    def _manifests(self) -> list[str]:
        return sorted(n for n in self._names(self.path) if n.startswith("manifest-") and n.endswith(".json"))

    def _load(self, name: str) -> dict:
        target, fs = self._fs(f"{self.path}/{name}")
        stream = fs.open(target)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def manifest(self) -> dict:
        """The visible state: version, folder of every history partition (empty where it has no rows left) and of
        every index bucket."""
        names = self._manifests()
        return self._load(names[-1]) if names else {"version": 0, "parts": {}, "index": {}}

    def _publish(self, state: dict) -> None:
        temp, fs = self._fs(f"{self.path}/manifest-{uuid.uuid4().hex}.tmp")
        out = fs.create(temp, True)
        out.write(json.dumps(state).encode())
        out.close()
        target, _ = self._fs(f"{self.path}/manifest-{state['version']:012d}.json")
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        never = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        never[0] = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename").getEnumConstants()[0]
        try:
            context.rename(temp, target, never)
        except Exception as e:
            fs.delete(temp, False)
            if not fs.exists(target):
                raise
            raise ConcurrentMerge(f"version {state['version']} was published by another writer") from e

    def _clean(self) -> None:
        """Remove manifests beyond those kept and the folders that only they name."""
        names = self._manifests()
        gone, kept = names[:-KEPT_VERSIONS], names[-KEPT_VERSIONS:]
        used = {f.split("/")[0] for n in kept for kind in ("parts", "index") for f in self._load(n)[kind].values()}
        for n in gone:
            old = {f.split("/")[0] for kind in ("parts", "index") for f in self._load(n)[kind].values()}
            for folder in sorted(x for x in old - used if x):
                workspace.remove(self.spark, f"{self.path}/{folder}")
            workspace.remove(self.spark, f"{self.path}/{n}")

    # -- reading ------------------------------------------------------------
    def _read(self, state: dict, kind: str, names: list[str] | None = None) -> DataFrame | None:
        folders = [f for n, f in sorted(state[kind].items()) if f and (names is None or n in names)]
        return self.spark.read.option("mergeSchema", False).parquet(*[f"{self.path}/{f}" for f in folders]) if folders else None

    def index(self) -> DataFrame | None:
        """The identifier index: ``(__key, __part, __at, __row)`` of every stored identifier."""
        return self._read(self.manifest(), "index")

    def rows(self) -> DataFrame | None:
        """All kept rows with the columns they were delivered with."""
        kept = self._read(self.manifest(), "parts")
        return None if kept is None else kept.drop(_KEY)

    # -- merging ------------------------------------------------------------
    def _write(self, df: DataFrame, by: str, label: str) -> dict[str, str]:
        """Folder of every value of ``by``. A large partition is written by several tasks, small ones share a task."""
        folder = f"{label}-{uuid.uuid4().hex[:12]}"
        df.withColumn("__dir", F.col(by).cast("string")).drop(by).hint("rebalance", "__dir").write.partitionBy("__dir").parquet(f"{self.path}/{folder}")
        names = [n for n in self._names(f"{self.path}/{folder}") if n.startswith("__dir=")]
        return {unquote(n[len("__dir=") :]): f"{folder}/{n}" for n in names}

    def merge(self, batch: DataFrame) -> dict:
        """Merge a batch, rewriting only the partitions whose rows change and the index buckets of its keys.

        Rows without an identifier are all kept. A row id delivered again as the very same row counts once.
        Columns are those of the first batch; later ones are fitted to them by name, with nulls where missing.
        Returns the new manifest. Raises :class:`ConcurrentMerge` if another writer published first.
        """
        spec, state = self.spec, self.manifest()
        keyed = batch.select("*", spec.key().alias(_KEY))
        named = keyed.where(F.col(_KEY).isNotNull() & F.col(spec.row_id).isNotNull())
        whole = F.struct(*[F.col(c) for c in batch.columns])
        firsts = named.groupBy(_KEY).agg(F.min_by(whole, _order(spec)).alias("__r")).select("__r.*", _KEY)
        unnamed = keyed.where(F.col(_KEY).isNull() | F.col(spec.row_id).isNull()).withColumn(_KEY, F.lit(None).cast("string"))
        bucket = F.pmod(F.xxhash64(_KEY), F.lit(self.partitions)).cast("string")
        best = _order(spec)
        incoming = firsts.unionByName(unnamed).select("*", spec.partition().alias(_PART), bucket.alias(_BUCKET), best[_AT].alias(_AT), best[_ROW].alias(_ROW))
        incoming = workspace.materialize(incoming, "incoming")
        own = [_KEY, _PART, _BUCKET, _AT, _ROW]
        if not state["index"]:
            placed, beaten = incoming, None
            touched, buckets = [], []
        else:
            # at most one name per bucket reaches the driver
            buckets = [r[0] for r in incoming.where(F.col(_KEY).isNotNull()).select(_BUCKET).distinct().collect()]
            held = self._read(state, "index", buckets)
            if held is None:
                held = self.spark.createDataFrame([], incoming.select(_KEY, _PART, _AT, _ROW).schema)
            held = held.select(_KEY, F.col(_PART).alias("__held"), F.col(_AT).alias("__held_at"), F.col(_ROW).alias("__held_row"))
            earlier = F.struct(_AT, _ROW) < F.struct("__held_at", "__held_row")
            # keys that are new, or whose copy comes before the one held; all others change nothing
            found = incoming.join(held, _KEY, "left").where(F.col(_KEY).isNull() | F.col("__held").isNull() | earlier)
            placed = workspace.materialize(found.drop("__held_at", "__held_row"), "placed")
            beaten = placed.where("__held is not null").select(_KEY)
            # one row per partition of the history
            ends = placed.select(F.explode(F.array(_PART, "__held")).alias("p")).where("p is not null").distinct()
            touched = [r[0] for r in ends.collect()]
            buckets = [r[0] for r in placed.where(F.col(_KEY).isNotNull()).select(_BUCKET).distinct().collect()]
            placed = placed.drop("__held")

        def renewed(kind: str, names: list[str], new: DataFrame, part: str | None) -> dict[str, str]:
            """New folders of what is named: what it held, without what is beaten, and the new rows."""
            old = self._read(state, kind, names)
            if old is not None:
                where = spec.partition() if part is None else F.pmod(F.xxhash64(_KEY), F.lit(self.partitions)).cast("string")
                old = old.withColumn("__to", where)
                if beaten is not None:
                    old = old.join(beaten, _KEY, "left_anti")
                if part is None:
                    wide = [c for c in old.columns if c in new.columns]
                    new = new.select(*wide, *[F.lit(None).cast(old.schema[c].dataType).alias(c) for c in old.columns if c not in new.columns])
                new = old.unionByName(new)
            written = self._write(new, "__to", kind)
            return {**dict.fromkeys(names, ""), **written}

        rows = placed.drop(_BUCKET, _AT, _ROW).withColumnRenamed(_PART, "__to")
        parts = renewed("parts", touched, rows, None)
        entries = placed.where(F.col(_KEY).isNotNull()).select(_KEY, _PART, _AT, _ROW, F.col(_BUCKET).alias("__to"))
        index = renewed("index", buckets, entries, _BUCKET) if beaten is None or buckets else {}
        new = {"version": state["version"] + 1, "parts": state["parts"] | parts, "index": state["index"] | index}
        self._publish(new)
        self._clean()
        workspace.discard(incoming)
        return new


def dropped_deliveries(df: DataFrame, spec: Spec, cutoff: Column | None = None, partitions: int = 64) -> DataFrame:
    """Row ids to drop so that one row per identifier remains, by two merges; with a scope, (scope, row_id).

    Rows received before ``cutoff`` (default: the last received day, of every scope) are the
    history; the rest arrives as one further batch, late copies included, and is
    merged through the identifier index. What is no longer in the store was a
    repeated delivery. Rows without identifier are never dropped; rows with a null
    row id cannot be named and are left out.
    """
    spark = df.sparkSession
    store = DeliveryStore(spark, workspace.new_path(spark, "deliveries"), spec, partitions)
    scope = [spec.scope] if spec.scope else []
    narrow = df.select(spec.identifier, spec.row_id, spec.received, *scope)
    if cutoff is None:
        received = F.col(spec.received).cast("timestamp_ntz")
        last = narrow.groupBy(*scope).agg(F.date_trunc("DAY", F.max(received)).alias("t")).collect()  # one row per scope
        ends = [(F.lit(True) if not scope else F.col(scope[0]).eqNullSafe(F.lit(r[scope[0]])), r["t"]) for r in last if r["t"] is not None]
        cutoff = F.lit(None).cast("timestamp_ntz")
        for same, t in ends:
            cutoff = F.when(same, F.lit(t).cast("timestamp_ntz")).otherwise(cutoff)
    early = F.coalesce(F.col(spec.received).cast("timestamp_ntz") < cutoff, F.lit(False))
    store.merge(narrow.where(early))
    store.merge(narrow.where(~early))
    kept = store.rows()
    ids = narrow.select(*scope, F.col(spec.row_id).alias("row_id")).where("row_id is not null").distinct()
    if kept is None:
        return ids
    own = kept.select(F.col(spec.row_id).alias("__row"), *[F.col(c).alias("__scope") for c in scope])
    same = F.col("row_id") == F.col("__row")
    for c in scope:
        same &= F.col(c).eqNullSafe(F.col("__scope"))
    return ids.join(own, same, "left_anti")
