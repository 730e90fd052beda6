"""Mapping parser output to contract fields: kinds, texts, captions, flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of the parsers with the element kinds they stand for.
ELEMENT_KINDS = {
    "caption": "caption", "code": "other", "footnote": "paragraph", "formula": "formula", "list_item": "list_item", "page_footer": "footer",
    "page_header": "header", "page_number": "page_number", "section_header": "heading", "text": "paragraph",
}
BLOCK_KINDS = {
    "caption": "caption", "chart": "picture", "doc_title": "heading", "figure_title": "caption", "footer": "footer", "formula": "formula", "header": "header",
    "image": "picture", "list_item": "list_item", "number": "page_number", "paragraph_title": "heading", "table": "table", "table_title": "caption", "text": "paragraph",
}
ITEM_LABELS = {
    "title": "paragraph_title", "paragraph": "text", "list": "list_item", "list_item": "list_item", "table": "table", "image": "image", "figure": "image", "chart": "chart",
    "equation": "formula", "formula": "formula", "header": "header", "page_header": "header", "footer": "footer", "page_footer": "footer", "number": "number", "page_number": "number",
}


def mapped(value: Column, table: dict[str, str], default: str = "other") -> Column:
    """The value's entry in a fixed table."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), value), F.lit(default))


def element_kind(label: Column) -> Column:
    return mapped(label, ELEMENT_KINDS)


def block_kind(label: Column) -> Column:
    return mapped(label, BLOCK_KINDS)


def item_label(kind: Column, level: Column) -> Column:
    """The block label of a content item; a text of level 1 is the title, of a deeper one a heading."""
    return (
        F.when((kind == "text") & (level == 1), "doc_title").when((kind == "text") & (level > 1), "paragraph_title")
        .when(kind == "text", "text").otherwise(mapped(kind, ITEM_LABELS))
    )


def item_text(kind: Column, text: Column, content: Column, code: Column, items: Column, table_body: Column) -> Column:
    """The first filled text of an item, else its list entries by line, else a table's body, else the empty text."""
    filled = [F.nullif(x, F.lit("")) for x in (text, content, code)]
    return F.coalesce(*filled, F.array_join(F.filter(items, lambda x: x.isNotNull()), "\n"), F.when(kind == "table", table_body), F.lit(""))


def with_captions(items: DataFrame) -> DataFrame:
    """Items (``kind, captions, footnotes`` and others) followed by a row for each filled caption, then each filled footnote, of an image, chart or table."""
    entry = lambda kind, text: F.struct(kind.alias("label"), text.alias("caption"))
    bearing = F.col("kind").isin("image", "chart", "table")
    title = F.when(F.col("kind") == "table", "table_title").otherwise("figure_title")
    filled = lambda column, label: F.coalesce(
        F.when(bearing, F.transform(F.filter(column, lambda c: F.length(F.trim(c)) > 0), lambda c: entry(label, c))), F.array())
    own = entry(mapped(F.col("kind"), ITEM_LABELS), F.lit(None).cast("string"))
    rows = F.concat(F.array(own), filled("captions", title), filled("footnotes", F.lit("caption")))
    rest = [c for c in items.columns if c not in ("kind", "captions", "footnotes")]
    return items.select(*rest, F.posexplode(rows).alias("row_no", "row")).select(*rest, "row_no", "row.label", "row.caption")


def formula_text(kind: Column, text: Column, original: Column) -> Column:
    """A formula without text takes its original."""
    blank = lambda x: F.length(F.trim(F.coalesce(x, F.lit("")))) == 0
    return F.when((kind == "formula") & blank(text) & ~blank(original), original).otherwise(text)


def first_true(*values: Column) -> Column:
    """Whether any value is true; nulls are not."""
    out = F.lit(False)
    for v in values:
        out = out | F.coalesce(v, F.lit(False))
    return out


def first_filled(*values: Column, default: str = "unknown") -> Column:
    """The first value that is not blank."""
    return F.coalesce(*[F.when(F.length(F.trim(v)) > 0, v) for v in values], F.lit(default))


def ocr_language(language: Column) -> Column:
    return F.when(F.lower(language).startswith("zh"), "ch").otherwise("en")


def engine_pair(backend: Column) -> Column:
    """``name/version`` of the engine behind a backend."""
    return F.when(backend == "pipeline", "PDF-Extract-Kit/1.0").otherwise("MinerU2.5-Pro/2605-1.2B")


def quality_flags(conditions: list[tuple[str, Column]]) -> Column:
    """Names whose condition holds, in the order given."""
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in conditions]), lambda x: x.isNotNull())


def evidence_status(unreadable: Column, errors: Column) -> Column:
    return F.when(unreadable, "failed").when(errors > 0, "partial").otherwise("succeeded")


def zipped_lines(texts: Column, scores: Column, boxes: Column) -> Column:
    """Three arrays as one of structs ``text, score, bbox``, as long as the shortest, so empty if one is empty; null if one is null."""
    n = F.least(F.size(texts), F.size(scores), F.size(boxes))
    entry = lambda i: F.struct(F.get(texts, i).alias("text"), F.get(scores, i).alias("score"), F.get(boxes, i).alias("bbox"))
    whole = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), entry)
    return F.when(texts.isNotNull() & scores.isNotNull() & boxes.isNotNull(), F.slice(whole, 1, F.greatest(n, F.lit(0))))


def normalized_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks whose id is their place unless it is a whole number, and whose order is their place; the parser's order is kept beside it."""
    whole = F.col("block_id").rlike("^-?[0-9]+$")
    return blocks.withColumns({
        "parser_block_order": F.col("block_order"), "block_id": F.when(whole, F.col("block_id")).otherwise((F.col("block_no") - 1).cast("string")), "block_order": (F.col("block_no") - 1).cast("bigint"),
    })


def page_texts(blocks: DataFrame, document: str = "run_id") -> DataFrame:
    """The filled contents of each page in order, parted by blank lines."""
    kept = blocks.where("block_content <> ''")
    return kept.groupBy(document, "page_number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "block_content"))), lambda x: x["block_content"]), "\n\n").alias("text")
    )


def best_attempt(attempts: DataFrame) -> DataFrame:
    """One attempt per document: the first that succeeded, else the first partial one with a document; others have none.

    ``attempts`` are ``document_id, attempt_no, status, has_document, errors``; the errors of all attempts are kept for a partial
    result, and are diagnostics only for one that succeeded. Partial errors take the code of a partial parse, timeouts excepted.
    """
    usable = F.when(F.col("status") == "succeeded", 1).when((F.col("status") == "partial") & F.col("has_document"), 2)
    ranked = attempts.withColumn("rank", usable)
    picked = ranked.groupBy("document_id").agg(
        F.min(F.when(F.col("rank").isNotNull(), F.struct("rank", "attempt_no"))).alias("best"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("attempt_no", "errors"))), lambda x: F.coalesce(x["errors"], F.array()))).alias("all_errors"),
    )
    recoded = F.transform("all_errors", lambda e: F.when(e == "PARSE_TIMEOUT", e).otherwise(F.lit("PDF_PARTIAL_PARSE")))
    status = F.when(F.col("best.rank") == 1, "succeeded").when(F.col("best.rank") == 2, "partial").otherwise("failed")
    return picked.select(
        "document_id", F.col("best.attempt_no").alias("attempt_no"), status.alias("status"),
        F.when(status == "partial", recoded).when(status == "failed", F.col("all_errors")).otherwise(F.array().cast("array<string>")).alias("errors"),
        F.when(status == "succeeded", F.col("all_errors")).otherwise(F.array().cast("array<string>")).alias("diagnostics"),
    )
