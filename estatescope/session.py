"""Session factory with the settings every stage relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Runtime settings; cluster sizing (executors, memory) is left to the launcher.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(app_name: str = "estatescope", **conf: str) -> SparkSession:
    """Return a session with UTC, AQE and Arrow on; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application.

    Python workers import the operators' functions by name, wherever the driver was
    started from. Spark's own file server distributes the archive.
    """
    context = spark.sparkContext
    if getattr(context, "_estatescope_shipped", False):
        return
    root = Path(__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="estatescope-src-"), "estatescope.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(Path(root.name) / source.relative_to(root)))
    context.addPyFile(archive)
    context._estatescope_shipped = True
