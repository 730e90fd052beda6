"""Queries of the text operators, and the SQL they are compared with."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.checkpoint import checkpoint
from quire.llm import encoding, language, lookalikes, packing, scans, spans, tokens
from quire.operators import nested
from quire.sources.tables import table


def records(spark, sf_dir):
    """``tab, document_id, page_number, text`` of all pages and contracts."""
    pages = table(spark, sf_dir, "native_text_pages").select(F.lit("native_text_pages").alias("tab"), "document_id", "page_number", "text")
    contracts = table(spark, sf_dir, "parsed_documents").select(
        F.lit("parsed_documents").alias("tab"), "document_id", F.lit(0).alias("page_number"), F.col("text.content").alias("text")
    )
    return pages.unionByName(contracts)


def p1_found(spark, sf_dir):
    return encoding.found(records(spark, sf_dir))


def p1_restored(spark, sf_dir):
    return encoding.restored(records(spark, sf_dir))


def _scanned(spark, sf_dir):
    """``tab, document_id, page_number, part_no, label, text`` of all pages, contracts and blocks."""
    texts = records(spark, sf_dir).select(
        "tab", "document_id", "page_number", F.lit(0).alias("part_no"), F.lit(None).cast("string").alias("label"), "text"
    )
    blocks = nested.blocks(table(spark, sf_dir, "run_pages")).select(
        F.lit("run_pages").alias("tab"), "document_id", "page_number", F.col("block_no").alias("part_no"), F.col("block_label").alias("label"), F.col("block_content").alias("text")
    )
    return texts.unionByName(blocks)


def _publishers(spark, sf_dir):
    return [r[0] for r in table(spark, sf_dir, "sources").select("publisher").distinct().collect()]  # a table of fixed size


def p2_found(spark, sf_dir):
    return scans.found(_scanned(spark, sf_dir), _publishers(spark, sf_dir))


def p2_repaired(spark, sf_dir):
    return scans.repaired(_scanned(spark, sf_dir), _publishers(spark, sf_dir))


def p3_found(spark, sf_dir):
    return lookalikes.alike_pairs(records(spark, sf_dir))


def p3_classes(spark, sf_dir):
    """Each record that reads like one stored differently, with its form and spelling."""
    _, members = lookalikes.alike(records(spark, sf_dir))
    return members.select("tab", "document_id", "page_number", F.hex("form").alias("form"), F.hex("stored").alias("spelling"))


def p3_forms(spark, sf_dir):
    return lookalikes.normalized(records(spark, sf_dir)).select("tab", "document_id", "page_number", "form")


def _contracts(spark, sf_dir):
    return table(spark, sf_dir, "parsed_documents").select("document_id", F.col("text.language").alias("label"), F.col("text.content").alias("text"))


def p5_found(spark, sf_dir):
    return language.found(_contracts(spark, sf_dir), table(spark, sf_dir, "language_samples"))


def p5_languages(spark, sf_dir):
    """Language and confidence of every contract (``para_no`` 0) and of every paragraph."""
    rows = language.paragraphs(_contracts(spark, sf_dir), table(spark, sf_dir, "language_samples"))
    return rows.select("document_id", "label", "para_no", "lang", "confidence")


def p6_ids(spark, sf_dir):
    return tokens.encode(table(spark, sf_dir, "documents"))


def p6_decoded(spark, sf_dir):
    return tokens.decode(tokens.encode(table(spark, sf_dir, "documents")))


def p7_containers(spark, sf_dir):
    sizes = checkpoint(tokens.sizes(table(spark, sf_dir, "documents")))
    return packing.fill(sizes, packing.capacities_of(table(spark, sf_dir, "container_specs")))


def p7_use(spark, sf_dir):
    """Containers, used and unused tokens by capacity."""
    filled = p7_containers(spark, sf_dir).where("container_id IS NOT NULL").groupBy("container_id", "capacity").agg(F.sum("tokens").alias("used"))
    return filled.groupBy("capacity").agg(
        F.count("*").alias("containers"), F.sum("used").alias("used_tokens"), F.sum(F.col("capacity") - F.col("used")).alias("unused_tokens")
    )


def p7_gap(spark, sf_dir):
    """Tokens, the capacity that holds them, and by which share it exceeds them; no filling can have less capacity than tokens."""
    whole = p7_use(spark, sf_dir).agg(F.sum("used_tokens").alias("tokens"), F.sum(F.col("used_tokens") + F.col("unused_tokens")).alias("capacity_tokens"))
    return whole.withColumn("gap", F.col("capacity_tokens") / F.col("tokens") - 1)


def p8_found(spark, sf_dir):
    return spans.shared_spans(table(spark, sf_dir, "documents"))


def p8_shares(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return spans.shares(documents, spans.shared_spans(documents))


QUERIES = {f.__name__: f for f in (p1_found, p1_restored, p2_found, p2_repaired, p3_found, p3_classes, p3_forms, p5_found, p5_languages, p6_ids, p6_decoded, p7_containers, p7_use, p7_gap, p8_found, p8_shares)}

#: Windows of 200 characters that occur in several documents, joined where they overlap or touch.
_SPANS = """
WITH d AS (SELECT doc_id, text FROM documents WHERE length(text) >= 200),
w AS (SELECT doc_id, CAST(i AS BIGINT) AS i, substr(text, CAST(i + 1 AS BIGINT), 200) AS s FROM (SELECT doc_id, text, unnest(range(0, length(text) - 199)) AS i FROM d) x),
k AS (SELECT s FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
p AS (SELECT DISTINCT doc_id, i FROM w SEMI JOIN k USING (s)),
n AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS begins FROM p),
g AS (SELECT doc_id, i, sum(begins) OVER (PARTITION BY doc_id ORDER BY i) AS no FROM n)
SELECT doc_id, min(i) AS span_start, max(i) + 200 AS span_end FROM g GROUP BY doc_id, no
"""

SQL = {
    "p8_found": _SPANS,
    "p8_shares": f"""
WITH s AS (SELECT doc_id, CAST(sum(span_end - span_start) AS BIGINT) AS shared_chars FROM ({_SPANS}) f GROUP BY doc_id)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, coalesce(shared_chars, 0) AS shared_chars, coalesce(shared_chars, 0) / nullif(length(text), 0) AS share
FROM documents LEFT JOIN s USING (doc_id)
""",
    "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
