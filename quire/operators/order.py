"""Reading order and ordinals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tree_order(edges: DataFrame, roots: DataFrame, deepest: int | None = None) -> DataFrame:
    """``root, node, reading_order``: depth-first order of each root's tree.

    ``edges`` are ``parent, ord, child``, ``roots`` are ``root, node``. A node met again later is skipped; the order is
    dense and starts at 0; the root itself has no place. A branch ends where it would come to a node on its own path, as in a cycle,
    and otherwise goes to any depth; if ``deepest`` is given, it ends at so many levels.
    """
    spark = edges.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    spark.conf.set("spark.sql.cteRecursionLevelLimit", "-1")
    bound = "" if deepest is None else f"AND w.depth < {int(deepest) - 1}"
    walked = spark.sql(
        f"""
        WITH RECURSIVE walk(root, node, path, met, depth) AS (
          SELECT root, node, CAST(array() AS ARRAY<BIGINT>), array(node), 0 FROM {{roots}}
          UNION ALL
          SELECT w.root, e.child, concat(w.path, array(CAST(e.ord AS BIGINT))), concat(w.met, array(e.child)), w.depth + 1
          FROM walk w JOIN {{edges}} e ON w.node = e.parent WHERE NOT array_contains(w.met, e.child) {bound}
        )
        SELECT root, node, path FROM walk WHERE depth > 0
        """,
        edges=edges,
        roots=roots,
    )
    first = walked.groupBy("root", "node").agg(F.min("path").alias("path"))
    return first.withColumn("reading_order", F.row_number().over(Window.partitionBy("root").orderBy("path")) - 1).drop("path")


def block_order(blocks: DataFrame, document: str = "run_id") -> DataFrame:
    """``blocks`` with a dense ``reading_order`` from 0 per document.

    Pages go up; blocks keep their place in the list where any block of the page has no order, and go by their order, then their
    place, where all have one.
    """
    page = Window.partitionBy(document, "page_number")
    unnumbered = F.max(F.col("block_order").isNull()).over(page)
    key = F.when(unnumbered, F.col("block_no").cast("bigint")).otherwise(F.col("block_order"))
    order = Window.partitionBy(document).orderBy("page_number", "place", "block_no")
    return blocks.withColumn("place", key).withColumn("reading_order", F.row_number().over(order) - 1).drop("place")


def item_ordinals(items: DataFrame, document: str = "run_id") -> DataFrame:
    """Global item ids, which advance with every block, and page-wise image and table names, which advance with exported ones only."""
    page = Window.partitionBy(document, "page_number").orderBy("block_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(document).orderBy("page_number", "block_no")
    nth = F.sum(F.col("exported").cast("int")).over(page)
    return items.withColumn("item_id", F.concat(F.lit("item-"), (F.row_number().over(whole) - 1).cast("string"))).withColumn(
        "export_name", F.when(F.col("exported"), F.format_string("page-%04d-%s-%03d", F.col("page_number"), F.col("block_label"), nth))
    )


def label_order(labels: DataFrame, document: str = "document_id") -> DataFrame:
    """Labels numbered from 1 by page, from top to bottom, then left to right, type and number."""
    order = Window.partitionBy(document).orderBy("page_number", F.desc("y"), "x", "object_type", "label_number")
    return labels.withColumn("label_no", F.row_number().over(order))


def first_errors(errors: DataFrame, document: str, shown: int = 10) -> DataFrame:
    """The first ``shown`` errors of each document, and how many more there are."""
    order = Window.partitionBy(document).orderBy("error_no")
    numbered = errors.withColumn("nth", F.row_number().over(order)).withColumn("total", F.count("*").over(Window.partitionBy(document)))
    return numbered.where(F.col("nth") <= shown).withColumn("more", F.greatest(F.col("total") - shown, F.lit(0)).cast("bigint")).drop("nth", "total")


def artifact_ids(files: DataFrame, document: str = "document_id") -> DataFrame:
    """``files`` (with ``collection, path``) with ids ``table-0``, ``image-0`` and so on, by file name within a document."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.withColumn("artifact_id", F.concat(F.col("collection"), F.lit("-"), (F.row_number().over(Window.partitionBy(document, "collection").orderBy(name, "path")) - 1).cast("string")))


def page_artifact_ids(bindings: DataFrame, run: str = "run_id") -> DataFrame:
    """Bindings with ids counted over the pages of a run, tables and images apart, each page's in their order (``place``)."""
    order = Window.partitionBy(run, "collection").orderBy("page_number", "place", "artifact_path")
    return bindings.withColumn("artifact_id", F.concat(F.regexp_replace("collection", "s$", ""), F.lit("-"), (F.row_number().over(order) - 1).cast("string")))
