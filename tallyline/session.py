"""Session settings the operators are tuned for, and the shared folder of a session."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the Python line of every column expression costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tallyline")
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_scratch() -> tempfile.TemporaryDirectory:
    """A folder of this process, removed when it ends."""
    return tempfile.TemporaryDirectory(prefix="tallyline-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder named in ``spark.checkpoint.dir``, which all executors share.

    Only a local session without that setting falls back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = _local_scratch().name
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
