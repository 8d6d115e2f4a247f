"""Shared-folder tables that cut lineage.

Intermediate results are written as Parquet below the folder named in
``spark.checkpoint.dir`` (one that all executors share), so a lost executor
costs a re-read and never a recomputation of earlier iterations. Only where the
setting is absent, as in local tests, a private folder is chosen and recorded in
the session.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a private one where it is unset."""
    base = spark.conf.get(_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_KEY} to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="estatescope-")
        spark.conf.set(_KEY, base)
    return base.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/estatescope/{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, label: str, codec: str = "zstd", free: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the written table; with ``free`` Spark removes the shuffle
    files of the write at once."""
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(_FREE, None)
    if free:
        spark.conf.set(_FREE, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        if free:
            spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._workspace_path = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder; missing paths are no error."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file at once: a reader sees the old text or the new one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, temp = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = target.getFileSystem(conf).create(temp, True)
    out.write(text.encode())
    out.close()
    option = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename").getEnumConstants()[1]
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = option  # OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(temp, target, options)


def read_texts(spark: SparkSession, folder: str, suffix: str) -> dict[str, str]:
    """Small files of a folder by name."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return {}
    out = {}
    for s in fs.listStatus(target):
        name = s.getPath().getName()
        if name.endswith(suffix):
            stream = fs.open(s.getPath())
            try:
                out[name] = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
    return out


def discard(df: DataFrame | None) -> None:
    """Delete the table behind a frame made by :func:`materialize`, once it is superseded."""
    path = getattr(df, "_workspace_path", None)
    if path:
        remove(df.sparkSession, path)
        _written[:] = [x for x in _written if x[1] != path]


def clear() -> None:
    """Delete every table written so far (also runs at driver exit)."""
    while _written:
        spark, path = _written.pop()
        try:
            remove(spark, path)
        except Exception:  # the JVM may be gone already
            pass


atexit.register(clear)
