"""Comparing two views of a text, and labels in native text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import text as T

# Patterns of table and figure labels; the least agreement of two views.
TABLE_LABEL = r"(?i)^\s*table\s+(\d+)(?:(\s*[.:])|(\s+(?:continued|cont\.?)(?:\s+on\s+(?:the\s+)?next\s+page)?\s*$)|(\s*$))"
FIGURE_LABEL = r"(?i)^\s*fig(?:ure)?\.?\s*(\d+)\s*[.:]"
AGREEMENT = 0.98


def character_counts(views: DataFrame, column: str) -> DataFrame:
    """``document_id, c, n``: how often each character occurs in a compact text."""
    return views.select("document_id", F.explode(F.split(column, "")).alias("c")).where("c <> ''").groupBy("document_id", "c").agg(F.count("*").alias("n"))


def compare_views(views: DataFrame) -> DataFrame:
    """Character agreement of ``parsed`` and ``native``, two compact texts per ``document_id``: sizes, shared characters, equality and shares (null for an empty text)."""
    a = character_counts(views, "parsed").withColumnRenamed("n", "a")
    b = character_counts(views, "native").withColumnRenamed("n", "b")
    shared = a.join(b, ["document_id", "c"]).groupBy("document_id").agg(F.sum(F.least("a", "b")).alias("shared"))
    return views.join(shared, "document_id", "left").select(
        "document_id", F.length("parsed").cast("bigint").alias("parsed_characters"), F.length("native").cast("bigint").alias("native_characters"),
        F.coalesce("shared", F.lit(0)).alias("shared_characters"), (F.col("parsed") == F.col("native")).alias("same"),
    ).selectExpr("*", "shared_characters / nullif(parsed_characters, 0) AS parsed_coverage", "shared_characters / nullif(native_characters, 0) AS native_coverage")


def text_route(compared: DataFrame, rounded: bool = True) -> DataFrame:
    """Which view to trust. Coverages are rounded to six places before they are held against the threshold, unless ``rounded`` is false."""
    r = T.python_round(6) if rounded else (lambda c: c)
    agree = (r(F.col("parsed_coverage")) >= AGREEMENT) & (r(F.col("native_coverage")) >= AGREEMENT)
    decision = (
        F.when(F.col("native_characters") == 0, "visual_primary").when(F.col("parsed_characters") == 0, "native_primary").when(agree, "native_primary").otherwise("unresolved")
    )
    reason = (
        F.when(F.col("native_characters") == 0, "native_text_layer_empty").when(F.col("parsed_characters") == 0, "native_text_only_nonempty_view")
        .when(agree, "cross_view_character_agreement_at_least_0_98").otherwise("native_and_parsed_views_materially_disagree")
    )
    return compared.select("document_id", decision.alias("decision"), reason.alias("reason"), (decision == "unresolved").alias("requires_reconciliation"))


def compact_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def label_fields(text: Column) -> dict[str, Column]:
    """Type, number, matched text and form of the label at the start of a compact line; nulls where there is none."""
    table, figure = text.rlike(TABLE_LABEL), text.rlike(FIGURE_LABEL)
    part = lambda p, i: F.regexp_extract(text, p, i)
    return {
        "object_type": F.when(table, "table").when(figure, "figure"),
        "label_number": F.when(table, part(TABLE_LABEL, 1)).when(figure, part(FIGURE_LABEL, 1)).try_cast("bigint"),
        "matched_text": F.when(table, part(TABLE_LABEL, 0)).when(figure, part(FIGURE_LABEL, 0)),
        "label_form": F.when(table, F.when(part(TABLE_LABEL, 2) != "", "punctuated").when(part(TABLE_LABEL, 3) != "", "continued").otherwise("bare")),
    }


def labels(chunks: DataFrame) -> DataFrame:
    """Labels of text chunks (``document_id, page_number, page_width, page_height, x, y, font_size, text``) with their places as shares of the page."""
    lines = chunks.withColumn("line", compact_line(F.col("text")))
    found = lines.withColumns(label_fields(F.col("line"))).where("object_type IS NOT NULL")
    c = F.col
    box = G.label_box(c("x"), c("y"), c("font_size"), F.length("matched_text"), c("page_width"), c("page_height"))
    return found.withColumns({"x_normalized": c("x") / c("page_width"), "y_normalized": (c("page_height") - c("y")) / c("page_height"), **box}).drop("line", "text")
