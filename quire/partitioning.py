"""Spreading few input splits over the cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores.

    Only a scan with fewer splits than cores, thus a small one, is shuffled; any other is returned as it is. So is a plan
    that shuffles already, as its partitions are not known before it runs.
    """
    plan = df._jdf.queryExecution().executedPlan()
    if "Exchange" in plan.toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
