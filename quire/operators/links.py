"""Joins of elements with pages, artifacts, captions and boxes.

Sides are joined by document keys and never broadcast by hint; a page's boxes are the only pairs formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.geometry import MATCH_OVERLAP, overlap

ARTIFACT_KINDS = ("table", "picture")


def bind_artifacts(blocks: DataFrame, bindings: DataFrame) -> DataFrame:
    """Blocks with the artifact of their page and id; a table or picture without one becomes ``other`` and is counted as missing.

    ``bindings`` are ``run_id, page_number, block_id, artifact_path``; of several for one block the least path is taken.
    """
    keys = ["run_id", "page_number", "block_id"]
    one = bindings.groupBy(*keys).agg(F.min("artifact_path").alias("artifact_path"))
    bearing = F.col("kind").isin(*ARTIFACT_KINDS)
    joined = blocks.join(one, keys, "left")
    missing = bearing & F.col("artifact_path").isNull()
    return joined.select(
        *[c for c in blocks.columns if c != "kind"],
        F.when(missing, "other").otherwise(F.col("kind")).alias("kind"),
        F.when(bearing, F.col("artifact_path")).alias("artifact_path"),
        missing.alias("artifact_missing"),
    )


def caption_texts(references: DataFrame, texts: DataFrame) -> DataFrame:
    """``document_id, element_id, caption``: the referred texts joined by line breaks in their order; missing ones are skipped.

    ``references`` are ``document_id, element_id, ord, ref``, ``texts`` are ``document_id, ref, text``.
    """
    found = references.join(texts, ["document_id", "ref"])
    return found.groupBy("document_id", "element_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n").alias("caption")
    )


def match_boxes(boxes: DataFrame, blocks: DataFrame, least: float = MATCH_OVERLAP) -> DataFrame:
    """``boxes`` with the block of their page and label they overlap most, by ``least`` or more; equal best overlaps match nothing.

    Both have ``run_id, page_number, label, x0, y0, x1, y1``; boxes have ``box_no``, blocks have ``block_no``.
    """
    sides = ("x0", "y0", "x1", "y1")
    a = boxes.select("run_id", "page_number", "label", "box_no", *[F.col(s).alias(f"a_{s}") for s in sides])
    b = blocks.select("run_id", "page_number", "label", "block_no", *[F.col(s).alias(f"b_{s}") for s in sides])
    pairs = a.join(b, ["run_id", "page_number", "label"]).withColumn(
        "overlap", overlap([F.col(f"a_{s}") for s in sides], [F.col(f"b_{s}") for s in sides])
    )
    best = (
        pairs.where(F.col("overlap") >= least)
        .groupBy("run_id", "page_number", "label", "box_no")
        .agg(F.max_by("block_no", "overlap").alias("block_no"), F.max("overlap").alias("overlap"), F.collect_list("overlap").alias("all"))
        .where(F.size(F.filter("all", lambda x: x == F.col("overlap"))) == 1)
        .drop("all")
    )
    keys = ["run_id", "page_number", "label", "box_no"]
    return boxes.select(*keys).join(best, keys, "left")


def missing_references(references: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    """References that nothing known answers to."""
    return references.join(known, list(keys), "left_anti")


def repeated_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def set_difference(expected: DataFrame, actual: DataFrame, keys: list[str], compared: list[str]) -> DataFrame:
    """Keys of two tables with ``missing``, ``untracked`` or ``changed``; equal ones are left out. Comparison treats nulls as equal."""
    e = expected.select(*keys, F.struct(*compared).alias("e"))
    a = actual.select(*keys, F.struct(*compared).alias("a"))
    return (
        e.join(a, keys, "full_outer")
        .withColumn("difference", F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "untracked").when(~F.col("e").eqNullSafe(F.col("a")), "changed"))
        .where("difference IS NOT NULL")
        .select(*keys, "difference")
    )


# Suffixes of artifact files.
IMAGE_SUFFIXES, TABLE_SUFFIXES = (".png", ".jpg", ".jpeg", ".webp"), (".csv",)


def binding_problems(bindings: DataFrame) -> DataFrame:
    """Bindings (``run_id, page_number, collection, block_id, artifact_path``) with ``problem``: a block bound twice, a path used twice, or a wrong suffix; null if sound."""
    block = Window.partitionBy("run_id", "page_number", "block_id")
    path = Window.partitionBy("run_id", "artifact_path")
    suffix = F.lower(F.regexp_extract("artifact_path", r"(\.[^./]+)$", 1))
    fits = F.when(F.col("collection") == "tables", suffix.isin(*TABLE_SUFFIXES)).otherwise(suffix.isin(*IMAGE_SUFFIXES))
    return bindings.withColumn("problem", F.when(F.count("*").over(block) > 1, "duplicate_binding").when(F.count("*").over(path) > 1, "destination_conflict").when(~F.coalesce(fits, F.lit(False)), "suffix"))


def latest(rows: DataFrame, *keys: str, by: str) -> DataFrame:
    """One row per key: the one with the greatest ``by``; of equal ones the least row by its other columns."""
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(by), *[c for c in rows.columns if c not in keys and c != by])
    return rows.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")
