"""Flat tables of nested parse records, with their parents' keys.

Each target table is one projection: nested ``transform`` calls attach the ancestors' keys and
places, ``flatten`` joins the arrays, and a single ``inline`` emits the rows. Nothing is shuffled
before the final ``distinct`` of the link table.

Defined results: a null or empty array gives no row; a null member of an array gives no row, but
its place counts; a null key column stays null; repeated rows stay repeated in the flat tables and
count once in ``parent_child_links``; unreadable, null or non-object JSON gives no block, nor does a
member of a list that is no object, but a field of another type than usual costs no page and no block. Extra
columns of the inputs are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fields of a page record, of its blocks and of its OCR lines. Each is read as its text, so that no value of another type spoils the
#: record; casts follow, and what cannot be cast is null.
PAGE_FIELDS = "page_index STRING, page_count STRING, width STRING, height STRING, parsing_res_list STRING, ocr_lines STRING, _unreadable STRING"
BLOCK_FIELDS = "block_label STRING, block_content STRING, block_bbox STRING, block_id STRING, block_order STRING, _unreadable STRING"
LINE_FIELDS = "text STRING, score STRING, bbox STRING, _unreadable STRING"
_OPTIONS = "map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '_unreadable')"


def _members(array: str, fields: str) -> str:
    """SQL of an array's members as structs of texts, null where a member is no object; ``array`` is SQL of its JSON text."""
    return (
        f"transform(from_json(IF(ltrim({array}) LIKE '[%', {array}, NULL), 'ARRAY<STRING>'), "
        f"m -> IF(ltrim(m) LIKE '{{%', from_json(m, '{fields}', {_OPTIONS}), NULL))"
    )


def _numbers(box: str) -> str:
    """SQL of a box as an array of numbers: a list in its order, an object as ``x0, y0, x1, y1``; null if it is neither."""
    return (
        f"CASE WHEN ltrim({box}) LIKE '[%' THEN transform(from_json({box}, 'ARRAY<STRING>'), n -> try_cast(n AS DOUBLE)) "
        f"WHEN ltrim({box}) LIKE '{{%' THEN transform(array('x0', 'y0', 'x1', 'y1'), k -> try_cast(from_json({box}, 'MAP<STRING, STRING>')[k] AS DOUBLE)) END"
    )


def _whole(number: str) -> str:
    """SQL of a whole number written in any way (``1``, ``1.0``, ``"1"``); null if it is none."""
    return f"coalesce(try_cast({number} AS BIGINT), IF(try_cast({number} AS DOUBLE) = floor(try_cast({number} AS DOUBLE)), try_cast(try_cast({number} AS DOUBLE) AS BIGINT), NULL))"


def parsed_pages(run_pages: DataFrame, *kept: str) -> DataFrame:
    """``run_id, document_id, page_number``, the columns ``kept``, and ``page``, the page record of ``page_json``, null where it is unreadable.

    ``page`` has ``page_index, page_count, width, height, parsing_res_list`` (label, content, box, id and order of each block) and
    ``ocr_lines`` (text, score, box). Only text that is no JSON object is unreadable: a field of another type is cast if it can be, else null.
    """
    raw = F.from_json(F.col("page_json"), PAGE_FIELDS, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unreadable"})
    blocks = _members("raw.parsing_res_list", BLOCK_FIELDS)
    lines = _members("raw.ocr_lines", LINE_FIELDS)
    return run_pages.select("run_id", "document_id", "page_number", *kept, raw.alias("raw")).selectExpr(
        "run_id", "document_id", "page_number", *kept,
        f"""IF(raw IS NULL OR raw._unreadable IS NOT NULL, NULL, named_struct('page_index', {_whole("raw.page_index")}, 'page_count', {_whole("raw.page_count")},
        'width', try_cast(raw.width AS DOUBLE), 'height', try_cast(raw.height AS DOUBLE),
        'parsing_res_list', transform({blocks}, b -> IF(b IS NULL, NULL, named_struct('block_label', b.block_label, 'block_content', b.block_content,
            'block_bbox', {_numbers("b.block_bbox")}, 'block_id', b.block_id, 'block_order', {_whole("b.block_order")}))),
        'ocr_lines', transform({lines}, l -> IF(l IS NULL, NULL, named_struct('text', l.text, 'score', try_cast(l.score AS DOUBLE),
            'bbox', {_numbers("l.bbox")}))))) AS page""",
    )


def read_pages(run_pages: DataFrame) -> DataFrame:
    """``parsed_pages`` of readable records; others are left out."""
    return parsed_pages(run_pages).where("page IS NOT NULL")


def elements(documents: DataFrame) -> DataFrame:
    """One row per element: ``document_id, element_no`` (from 1) and the element's own fields."""
    return documents.selectExpr(
        """inline(filter(transform(elements, (e, i) -> IF(e IS NULL, NULL, named_struct(
            'document_id', document_id, 'element_no', i + 1, 'element_id', e.element_id, 'kind', e.kind,
            'reading_order', e.reading_order, 'text', e.text))), x -> x IS NOT NULL))"""
    )


def provenance(documents: DataFrame) -> DataFrame:
    """One row per place of an element: ``document_id, element_id, provenance_no`` (from 1), page, box and parser reference."""
    return documents.selectExpr(
        """inline(filter(flatten(filter(transform(elements, e -> transform(e.provenance, (p, i) -> IF(p IS NULL, NULL, named_struct(
            'document_id', document_id, 'element_id', e.element_id, 'provenance_no', i + 1, 'page_number', p.page_number,
            'x0', p.bbox.x0, 'y0', p.bbox.y0, 'x1', p.bbox.x1, 'y1', p.bbox.y1, 'unit', p.bbox.unit, 'origin', p.bbox.origin,
            'parser_element_ref', p.parser_element_ref)))), a -> a IS NOT NULL)), x -> x IS NOT NULL))"""
    )


def artifacts(documents: DataFrame) -> DataFrame:
    """One row per artifact of a document: ``document_id, artifact_no`` (from 1) and the artifact's own fields."""
    return documents.selectExpr(
        """inline(filter(transform(artifacts, (a, i) -> IF(a IS NULL, NULL, named_struct(
            'document_id', document_id, 'artifact_no', i + 1, 'artifact_id', a.artifact_id, 'kind', a.kind,
            'path', a.path, 'media_type', a.media_type, 'content_sha256', a.content_sha256))), x -> x IS NOT NULL))"""
    )


def artifact_links(documents: DataFrame) -> DataFrame:
    """One row per artifact an element names: ``document_id, element_id, artifact_id, link_no, resolved``.

    ``resolved`` tells whether the document has such an artifact. A null name gives no row.
    """
    return documents.selectExpr(
        "document_id", "elements", "coalesce(array_distinct(filter(transform(artifacts, a -> a.artifact_id), a -> a IS NOT NULL)), array()) AS known",
    ).selectExpr(
        # the names in parts by their hash, of about 16 each, so that a look-up takes as long in a large document
        "document_id", "elements", "transform(sequence(0, size(known) div 16), i -> filter(known, k -> pmod(hash(k), size(known) div 16 + 1) = i)) AS parts",
    ).selectExpr(
        """inline(filter(flatten(filter(transform(elements, e -> transform(e.artifact_ids, (a, i) -> IF(a IS NULL, NULL, named_struct(
            'document_id', document_id, 'element_id', e.element_id, 'artifact_id', a, 'link_no', i + 1,
            'resolved', array_contains(parts[pmod(hash(a), size(parts))], a))))), a -> a IS NOT NULL)), x -> x IS NOT NULL))"""
    )


def blocks(run_pages: DataFrame) -> DataFrame:
    """One row per block of a readable page record: ``run_id, document_id, page_number, block_no`` (from 1) and its fields."""
    return read_pages(run_pages).selectExpr(
        """inline(filter(transform(page.parsing_res_list, (b, i) -> IF(b IS NULL, NULL, named_struct(
            'run_id', run_id, 'document_id', document_id, 'page_number', page_number, 'block_no', i + 1,
            'block_id', b.block_id, 'block_label', b.block_label, 'block_content', b.block_content,
            'block_bbox', b.block_bbox, 'block_order', b.block_order))), x -> x IS NOT NULL))"""
    )


def parent_child_links(documents: DataFrame, run_pages: DataFrame) -> DataFrame:
    """Distinct ``record_kind, root_id, parent_id, child_id`` of places, resolved artifacts and blocks."""
    places = provenance(documents).selectExpr(
        "'provenance' AS record_kind", "document_id AS root_id", "element_id AS parent_id", "CAST(provenance_no AS STRING) AS child_id"
    )
    links = artifact_links(documents).where("resolved").selectExpr(
        "'artifact' AS record_kind", "document_id AS root_id", "element_id AS parent_id", "artifact_id AS child_id"
    )
    parts = blocks(run_pages).selectExpr(
        "'block' AS record_kind", "run_id AS root_id", "CAST(page_number AS STRING) AS parent_id", "block_id AS child_id"
    )
    return places.unionByName(links).unionByName(parts).distinct()
