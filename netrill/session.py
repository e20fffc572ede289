"""Sessions and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("netrill")
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return (
        builder.config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``.

    Only a local session may go without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="netrill-")
    return os.path.join(base, f"netrill-{name}-{uuid.uuid4().hex}")
