"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Joins on person_id may meet a person with very many rows. With these settings
# Spark splits such a partition at run time, also where that costs a shuffle.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tuned(spark: SparkSession) -> SparkSession:
    """Switch on adaptive execution with skew splitting for this session."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    A checkpoint folder set on the context serves as well. Only a local master
    (one JVM, no executors elsewhere) may do without both and uses a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="epiloom-")
    return _LOCAL[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"

