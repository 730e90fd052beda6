"""Writing packages of tables.

A package is a folder of versions, each with all its tables. A version is written beside the published one, read again and checked, and only
then entered in the package's register, so its tables appear together, and a reader never meets a half-written package.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.checkpoint import checkpoint

REGISTER = "register"
#: Parts of a table of runs; a run lies in one of them by the hash of its id.
RUN_PARTS = 64


def _versions(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema("version STRING, published_at TIMESTAMP").json(f"{folder}/{REGISTER}")
    except AnalysisException:
        return None


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table of the version that was published last."""
    versions = _versions(spark, folder)
    last = versions.orderBy(F.desc("published_at"), "version").first() if versions is not None else None  # one row for each publication
    if last is None:
        raise FileNotFoundError(f"nothing is published in {folder}")
    return spark.read.parquet(f"{folder}/{last['version']}/{name}")


def publish(tables: dict[str, DataFrame], folder: str, replace: bool = False, checks: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> str:
    """Writes all tables as one version below ``folder`` and returns its name; where something is published it is refused, unless ``replace`` is true.

    ``checks`` give the violations of a table as it is read again; a version with any is not published.
    """
    spark = next(iter(tables.values())).sparkSession
    versions = _versions(spark, folder)
    if not replace and versions is not None and versions.limit(1).count():
        raise FileExistsError(f"a published version exists in {folder}")
    version = uuid.uuid4().hex
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{folder}/{version}/{name}")
    for name, check in (checks or {}).items():
        if check(spark.read.parquet(f"{folder}/{version}/{name}")).limit(1).count():
            raise ValueError(f"table {name} has violations and is not published")
    spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at")).write.mode("append").json(f"{folder}/{REGISTER}")
    return version


def replace_runs(spark: SparkSession, df: DataFrame, folder: str, key: str = "run_id", parts: int = RUN_PARTS) -> None:
    """Replaces the rows of the given runs only; those of other runs stay.

    The table lies in ``parts`` parts by the hash of the run, of which only those of the given runs are written anew.
    """
    rows = df.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    try:
        old = spark.read.parquet(folder)
    except AnalysisException:
        old = None
    if old is not None:
        rows = checkpoint(rows)
        touched = F.broadcast(rows.select("part").distinct())  # as many as parts at most
        kept = old.join(touched, "part", "left_semi").join(rows.select(key).distinct(), key, "left_anti")
        rows = checkpoint(rows.unionByName(kept.select(*rows.columns)))  # read before it is overwritten
    rows.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(folder)


def publish_text(df: DataFrame, folder: str, column: str = "text") -> None:
    """Writes one text per row as JSON lines, with its other columns."""
    df.write.mode("errorifexists").json(folder)


def table_csv(cells: DataFrame, *table: str) -> DataFrame:
    """Each table (by the columns ``table``) of ``row_no, column_no, cell`` as CSV text with a byte-order mark; a cell with a comma, quote or line break is quoted."""
    cell = F.coalesce("cell", F.lit(""))
    quoted = F.when(cell.rlike('[,"\\r\\n]'), F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(cell)
    lines = cells.groupBy(*table, "row_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("column_no", quoted.alias("q")))), lambda x: x["q"]), ",").alias("line"))
    texts = lines.groupBy(*table).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_no", "line"))), lambda x: x["line"]), "\n").alias("csv"))
    return texts.withColumn("csv", F.concat(F.lit("\ufeff"), F.col("csv"), F.lit("\n")))


def markdown(texts: DataFrame, key: str = "document_id") -> DataFrame:
    """``key, markdown, problem`` of ``key, text``: a document without text is ``empty_text``."""
    return texts.select(key, F.col("text").alias("markdown"), F.when(F.length(F.trim(F.coalesce("text", F.lit("")))) == 0, "empty_text").alias("problem"))
