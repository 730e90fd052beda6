"""Queries of the nested-record operators."""

from __future__ import annotations

from quire.operators import nested
from quire.sources.tables import table


def p4_found(spark, sf_dir):
    return nested.parent_child_links(table(spark, sf_dir, "parsed_documents"), table(spark, sf_dir, "run_pages"))


def p4_elements(spark, sf_dir):
    return nested.elements(table(spark, sf_dir, "parsed_documents"))


def p4_provenance(spark, sf_dir):
    return nested.provenance(table(spark, sf_dir, "parsed_documents"))


def p4_artifacts(spark, sf_dir):
    return nested.artifacts(table(spark, sf_dir, "parsed_documents"))


def p4_artifact_links(spark, sf_dir):
    return nested.artifact_links(table(spark, sf_dir, "parsed_documents"))


def p4_blocks(spark, sf_dir):
    return nested.blocks(table(spark, sf_dir, "run_pages")).selectExpr(
        "run_id", "document_id", "page_number", "block_no", "block_id", "block_label", "block_content", "block_order"
    )


QUERIES = {f.__name__: f for f in (p4_found, p4_elements, p4_provenance, p4_artifacts, p4_artifact_links, p4_blocks)}

_BLOCKS = """
  SELECT r.run_id, r.document_id, r.page_number, CAST(i.i AS INTEGER) AS block_no,
         json_extract(r.page_json, '$.parsing_res_list[' || (i.i - 1) || ']') AS b
  FROM (SELECT * FROM run_pages WHERE json_valid(page_json)) r,
       LATERAL (SELECT unnest(range(1, 1 + CAST(coalesce(json_array_length(r.page_json, '$.parsing_res_list'), 0) AS BIGINT))) AS i) i
"""

SQL = {
    "p4_found": f"""
WITH e AS (SELECT document_id, artifacts, unnest(elements) AS e FROM parsed_documents),
p AS (SELECT 'provenance' AS record_kind, document_id AS root_id, e.element_id AS parent_id,
             CAST(unnest(range(1, 1 + len(e.provenance))) AS VARCHAR) AS child_id FROM e),
a AS (SELECT document_id, e.element_id AS element_id, artifacts, unnest(e.artifact_ids) AS artifact_id FROM e),
l AS (SELECT 'artifact' AS record_kind, document_id AS root_id, element_id AS parent_id, artifact_id AS child_id
      FROM a WHERE list_contains(list_transform(artifacts, lambda x: x.artifact_id), artifact_id)),
b AS (SELECT 'block' AS record_kind, run_id AS root_id, CAST(page_number AS VARCHAR) AS parent_id, b->>'$.block_id' AS child_id
      FROM ({_BLOCKS}) s)
SELECT DISTINCT * FROM (SELECT * FROM p UNION ALL SELECT * FROM l UNION ALL SELECT * FROM b) u
""",
    "p4_elements": """
SELECT document_id, CAST(i AS INTEGER) AS element_no, e.element_id AS element_id, e.kind AS kind, e.reading_order AS reading_order, e.text AS text
FROM (SELECT document_id, unnest(elements) AS e, unnest(range(1, 1 + len(elements))) AS i FROM parsed_documents) s
""",
    "p4_provenance": """
WITH e AS (SELECT document_id, unnest(elements) AS e FROM parsed_documents),
p AS (SELECT document_id, e.element_id AS element_id, unnest(e.provenance) AS p, unnest(range(1, 1 + len(e.provenance))) AS i FROM e)
SELECT document_id, element_id, CAST(i AS INTEGER) AS provenance_no, p.page_number AS page_number, p.bbox.x0 AS x0, p.bbox.y0 AS y0,
       p.bbox.x1 AS x1, p.bbox.y1 AS y1, p.bbox.unit AS unit, p.bbox.origin AS origin, p.parser_element_ref AS parser_element_ref FROM p
""",
    "p4_artifacts": """
SELECT document_id, CAST(i AS INTEGER) AS artifact_no, a.artifact_id AS artifact_id, a.kind AS kind, a.path AS path,
       a.media_type AS media_type, a.content_sha256 AS content_sha256
FROM (SELECT document_id, unnest(artifacts) AS a, unnest(range(1, 1 + len(artifacts))) AS i FROM parsed_documents) s
""",
    "p4_artifact_links": """
WITH e AS (SELECT document_id, artifacts, unnest(elements) AS e FROM parsed_documents),
a AS (SELECT document_id, e.element_id AS element_id, artifacts, unnest(e.artifact_ids) AS artifact_id,
             unnest(range(1, 1 + len(e.artifact_ids))) AS i FROM e)
SELECT document_id, element_id, artifact_id, CAST(i AS INTEGER) AS link_no,
       coalesce(list_contains(list_transform(artifacts, lambda x: x.artifact_id), artifact_id), false) AS resolved FROM a
""",
    "p4_blocks": f"""
SELECT run_id, document_id, page_number, block_no, b->>'$.block_id' AS block_id, b->>'$.block_label' AS block_label,
       b->>'$.block_content' AS block_content, CAST(b->>'$.block_order' AS BIGINT) AS block_order FROM ({_BLOCKS}) s
""",
}
