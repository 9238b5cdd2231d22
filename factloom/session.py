"""Session settings and code shipping."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the semantics depend on (UTC, ANSI as Spark has it)."""
    b = SparkSession.builder.master(f"local[{cores}]").config("spark.sql.session.timeZone", "UTC")
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).config("spark.ui.enabled", "false")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a Spark application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="factloom-code-"), "factloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
