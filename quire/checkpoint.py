"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def _ensure_dir(spark: SparkSession) -> None:
    """Uses ``spark.checkpoint.dir`` of the session; a folder of its own only where that is unset and the master is local."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="quire-checkpoint-")
    context.setCheckpointDir(shared)


#: Lets Spark delete the shuffle files of a query when it ends.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it from there, so that a lost executor costs no recomputation.

    The shuffle files behind it, which nothing reads again, go when it is written. ``df`` without rows stays without rows; the schema is
    kept, nulls included.
    """
    _ensure_dir(df.sparkSession)
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN_UP, "false")
    conf.set(_CLEAN_UP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a plan of its own, which is run with this setting
    finally:
        conf.set(_CLEAN_UP, before)
