"""The quality gate over a stream of parsed documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quire.operators import quality


def arriving(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Contracts as their files arrive in a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def measured(contracts: DataFrame) -> DataFrame:
    """What the gate needs, by expressions over one row, so that a stream carries no state."""
    from quire.plans.quality import contract_measures

    return contract_measures(contracts)


def gate_stream(contracts: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Decides on each arriving contract once and writes the decisions; ends when all present files are done."""
    decided = quality.gate(measured(contracts))
    return decided.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
