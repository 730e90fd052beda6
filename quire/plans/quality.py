"""Queries of the quality gate, routing and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import nested, quality, validate
from quire.sources.tables import table


def contract_measures(contracts):
    """The gate's measures of contracts, by expressions over one row; of the source nothing is known."""
    has_text = lambda e: F.length(F.trim(F.coalesce(e["text"], F.lit("")))) > 0
    filled = lambda e: has_text(e) | (F.coalesce(F.size(e["artifact_ids"]), F.lit(0)) > 0)
    pages = F.array_distinct(F.transform(F.coalesce("pages", F.array()), lambda p: p["page_number"]))
    content_pages = F.flatten(F.transform(F.filter(F.coalesce("elements", F.array()), filled), lambda e: F.transform(F.coalesce(e["provenance"], F.array()), lambda p: p["page_number"])))
    rows = contracts.select(
        "document_id", "status", F.coalesce("quality.flags", F.array()).alias("flags"), F.col("quality.ocr.used").alias("ocr_used"), F.col("quality.ocr.mean_confidence").alias("ocr_mean"),
        F.size(F.coalesce("quality.ocr.low_confidence_pages", F.array())).alias("low_confidence_pages"), F.size(pages).alias("page_count"), F.size(F.array_except(pages, content_pages)).alias("uncovered"),
        F.coalesce("text.content", F.lit("")).alias("text"),
    )
    chars, cjk = F.length("text"), T.cjk_characters(F.col("text"))
    nothing = {c: F.lit(None).cast(t) for c, t in (
        ("source_matches", "boolean"), ("readable", "boolean"), ("encrypted", "boolean"), ("source_page_count", "int"), ("scan_pages", "int"), ("low_resolution_pages", "int"), ("unclassified_pages", "int"),
        ("empty_tables", "int"), ("sparse_tables", "int"))}
    return rows.withColumns({
        "characters_per_page": F.when(F.col("page_count") > 0, chars / F.col("page_count")).otherwise(0.0), "lost_share": T.occurrences(F.col("text"), "�") / F.greatest(chars, F.lit(1)),
        "cjk_space_share": T.cjk_internal_spaces(F.col("text")) / F.greatest(cjk, F.lit(1)), **nothing,
    }).drop("text")


def text_measures(spark, sf_dir):
    c = table(spark, sf_dir, "parsed_documents").selectExpr("document_id", "text.content AS text", "coalesce(size(pages), 0) AS page_count")
    return quality.text_measures(c)


def page_coverage(spark, sf_dir):
    return quality.page_coverage(table(spark, sf_dir, "parsed_documents"))


def run_evidence(spark, sf_dir):
    """Of each document's runs and fallback pages: whether they read the contract's source, could read it, and how many pages they saw.

    A source that needs a password or whose text layer cannot be read is unreadable.
    """
    contracts = table(spark, sf_dir, "parsed_documents")
    own = contracts.select("document_id", F.col("source.content_sha256").alias("own"), F.transform("errors", lambda e: e["code"]).alias("codes")).distinct()
    runs = table(spark, sf_dir, "runs").select("document_id", F.col("source.content_sha256").alias("read"), F.transform("errors", lambda e: e["code"]).alias("run_codes")).distinct()
    has = lambda code: F.max(F.coalesce(F.array_contains("codes", code), F.lit(False)) | F.coalesce(F.array_contains("run_codes", code), F.lit(False)))
    of_runs = own.join(runs, "document_id").groupBy("document_id").agg(
        F.min(F.col("own") == F.col("read")).alias("source_matches"), has("PDF_ENCRYPTED").alias("encrypted"), has("PDF_TEXT_LAYER_UNREADABLE").alias("no_text_layer"),
    )
    counts = nested.read_pages(table(spark, sf_dir, "run_pages")).groupBy("document_id").agg(F.max("page.page_count").cast("int").alias("source_page_count"))
    return of_runs.join(counts, "document_id", "left").selectExpr("document_id", "source_matches", "NOT (encrypted OR no_text_layer) AS readable", "encrypted", "source_page_count")


def gate_measures(spark, sf_dir):
    """The gate's measures of contracts with all that is known of their sources and tables."""
    measured = contract_measures(table(spark, sf_dir, "parsed_documents"))
    known = ["source_matches", "readable", "encrypted", "source_page_count", "scan_pages", "low_resolution_pages", "unclassified_pages", "empty_tables", "sparse_tables"]
    pages = source_pages(spark, sf_dir).select("document_id", *[F.size(c).alias(c) for c in ("scan_pages", "low_resolution_pages", "unclassified_pages")])
    evidence = run_evidence(spark, sf_dir).join(pages, "document_id", "full").join(table_measures(spark, sf_dir).drop("tables"), "document_id", "full")
    return measured.drop(*known).join(evidence, "document_id", "left")


def quality_gate(spark, sf_dir):
    return quality.gate(gate_measures(spark, sf_dir))


def _scores(spark, sf_dir):
    pages = nested.read_pages(table(spark, sf_dir, "run_pages")).dropDuplicates(["run_id", "page_number"])
    return pages.select(F.col("run_id").alias("document_id"), "page_number", F.explode("page.ocr_lines").alias("l")).select("document_id", "page_number", F.col("l.score").alias("score"))


def ocr_confidence(spark, sf_dir):
    return quality.ocr_confidence(_scores(spark, sf_dir)).withColumnRenamed("document_id", "run_id")


def route_decision(spark, sf_dir):
    """The primary contract if published, else the fallback run if it has pages, else none."""
    primary = quality_gate(spark, sf_dir).distinct().select("document_id", "route_action", F.lit(None).cast("string").alias("failure_code"))
    pages = table(spark, sf_dir, "run_pages").select("document_id").distinct().withColumn("route_action", F.lit("publish")).withColumn("failure_code", F.lit(None).cast("string"))
    return quality.route(primary, pages)


def fallback_work(spark, sf_dir):
    primary = quality_gate(spark, sf_dir).distinct().withColumn("failure_code", F.lit(None).cast("string"))
    return quality.needs_fallback(primary)


def report_consistency(spark, sf_dir):
    """Gate reports with broken ones among them: by the length of the document's id and its status."""
    gate = quality_gate(spark, sf_dir).distinct().join(table(spark, sf_dir, "parsed_documents").select("document_id", "status").distinct(), "document_id")
    n = F.pmod(F.conv(F.substring("document_id", -1, 1), 16, 10).cast("int"), 8)
    report = gate.select(
        "document_id", (F.col("status") != "failed").alias("completed"), (n != 1).alias("assessed"), F.when(n == 2, "maybe").otherwise(F.col("decision")).alias("decision"),
        F.when(n == 3, "publish").otherwise(F.col("route_action")).alias("route_action"), "reason_codes", F.when(n == 4, F.array(F.lit(""))).otherwise(F.col("warning_codes")).alias("warning_codes"), "blocking_codes",
    )
    return report.select("document_id", quality.report_problem(report).alias("failure_code"))


def failure_stages(spark, sf_dir):
    return table(spark, sf_dir, "runs").select("run_id", quality.failure_stages(F.col("errors")).alias("failure_stages"))


def table_measures(spark, sf_dir):
    """Tables of contracts, which are the paragraphs of their content that begin with a bar."""
    c = table(spark, sf_dir, "parsed_documents").select("document_id", F.posexplode(F.split("text.content", "\n\n")).alias("n", "text")).distinct().where("text LIKE '|%'")
    e = c.select("document_id", F.concat(F.lit("table-"), F.col("n").cast("string")).alias("artifact_id"), "text")
    rows = e.select("document_id", "artifact_id", F.posexplode(F.split("text", "\n")).alias("row_no", "row"))
    cells = rows.where("row_no <> 1").select("document_id", "artifact_id", "row_no", F.explode(F.split("row", r"\|")).alias("cell"))
    return quality.table_measures(cells, e.select("document_id", F.col("artifact_id").alias("element_id"), "artifact_id"))


def source_pages(spark, sf_dir):
    """Contract pages in points, with the pixels the fallback run saw, each as one image, and the characters of the native text."""
    native = table(spark, sf_dir, "native_text_pages").groupBy("document_id", "page_number").agg(F.max(F.length(F.trim("text"))).alias("text_characters"))
    pixels = table(spark, sf_dir, "run_pages").select("document_id", "page_number", F.col("width").alias("px_width"), F.col("height").alias("px_height")).distinct()
    pages = table(spark, sf_dir, "parsed_documents").select("document_id", F.explode("pages").alias("p")).select("document_id", "p.page_number", "p.width", "p.height").distinct()
    shaped = pages.join(pixels, ["document_id", "page_number"], "left").join(native, ["document_id", "page_number"], "left").select(
        "document_id", "page_number", "width", "height", F.coalesce("text_characters", F.lit(0)).alias("text_characters"),
        F.when(F.col("px_width").isNull(), 0).otherwise(1).alias("images"), "px_width", "px_height",
    )
    return quality.source_summary(quality.source_pages(shaped))


def contract_violations(spark, sf_dir):
    return validate.contract(table(spark, sf_dir, "parsed_documents"))


def run_violations(spark, sf_dir):
    return validate.run(table(spark, sf_dir, "runs"))


def native_text_violations(spark, sf_dir):
    return validate.native_text(table(spark, sf_dir, "native_text_pages"))


def export_counts(spark, sf_dir):
    blocks = nested.blocks(table(spark, sf_dir, "run_pages")).where("block_label IN ('table', 'image')").select("run_id", "page_number", "block_no", F.expr("block_label || 's'").alias("collection")).distinct()
    native = blocks.groupBy("run_id", "collection").agg(F.count("*").alias("n"))
    rows = table(spark, sf_dir, "run_pages").select("run_id", "page_number", "images", "tables").dropDuplicates(["run_id", "page_number"])
    exported = rows.groupBy("run_id").agg(F.sum(F.coalesce(F.size("images"), F.lit(0))).alias("images"), F.sum(F.coalesce(F.size("tables"), F.lit(0))).alias("tables"))
    exported = exported.selectExpr("run_id", "stack(2, 'images', images, 'tables', tables) AS (collection, n)").where("n > 0")
    statuses = table(spark, sf_dir, "runs").select("run_id", F.col("result.status").alias("status")).distinct()
    return validate.export_counts(native, exported, statuses)


def page_payload_checks(spark, sf_dir):
    p = table(spark, sf_dir, "run_pages").dropDuplicates(["run_id", "page_number"])
    rows = nested.parsed_pages(p, "width", "height")
    return validate.page_payloads(rows)


def identity_checks(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("document_id"), F.col("source").alias("source_ref"), F.col("lang").alias("language"))
    return validate.identity(d.withColumn("document_id", F.when(F.length("document_id") % 2 == 0, F.replace("document_id", F.lit(" "), F.lit("-"))).otherwise(F.col("document_id"))))


def routing_payload(spark, sf_dir):
    return quality.routing_payload(route_decision(spark, sf_dir)).select("document_id", "payload.routing_version", "payload.outcome", "payload.contract_path")


def run_durations(spark, sf_dir):
    """How long runs took by their own times, and those times in one form."""
    r = table(spark, sf_dir, "runs").select("run_id", "result").distinct()
    return r.select("run_id", T.elapsed_ms(F.col("result.started_at"), F.col("result.completed_at")).alias("elapsed_ms"), T.utc_text(F.try_to_timestamp(F.col("result.started_at"))).alias("started"))


QUERIES = {f.__name__: f for f in (run_evidence, 
    text_measures, page_coverage, quality_gate, ocr_confidence, route_decision, fallback_work, report_consistency, failure_stages, table_measures, source_pages, contract_violations, run_violations,
    native_text_violations, export_counts, page_payload_checks, identity_checks, routing_payload, run_durations)}

_CJK = "\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{F900}-\\x{FAFF}"
_MEASURES = f"""
SELECT document_id, CAST(length(t) AS BIGINT) AS characters, CAST(page_count AS BIGINT) AS page_count, CAST(length(t) - length(replace(t, chr(65533), '')) AS BIGINT) AS lost_characters,
  CAST(length(regexp_replace(t, '[^{_CJK}]', '', 'g')) AS BIGINT) AS cjk_characters,
  CAST(len(regexp_extract_all(regexp_replace(t, '([{_CJK}])', '\\1\\1', 'g'), '[{_CJK}][ \\t]+[{_CJK}]')) AS BIGINT) AS cjk_spaces
FROM (SELECT document_id, coalesce(text.content, '') AS t, coalesce(len(pages), 0) AS page_count FROM parsed_documents) s
"""
_SHARES = f"""
SELECT *, CASE WHEN page_count > 0 THEN characters / page_count ELSE 0.0 END AS characters_per_page, lost_characters / greatest(characters, 1) AS lost_share, cjk_spaces / greatest(cjk_characters, 1) AS cjk_space_share
FROM ({_MEASURES}) m
"""
_FILLED = "len(trim(coalesce(e.text, ''))) > 0"
_PAGES = "list_sort(list_distinct(list_transform(coalesce(pages, []), lambda p: p.page_number)))"


def _covered(test: str) -> str:
    return f"list_sort(list_distinct(flatten(list_transform(list_filter(coalesce(elements, []), lambda e: {test}), lambda e: list_transform(coalesce(e.provenance, []), lambda p: p.page_number)))))"


_COVERAGE = f"""
SELECT document_id, {_PAGES} AS page_numbers, {_covered(_FILLED + " OR coalesce(len(e.artifact_ids), 0) > 0")} AS covered_pages, {_covered(_FILLED)} AS text_pages FROM parsed_documents
"""
_TABLES = """
WITH e AS (SELECT DISTINCT document_id, n AS element_id, t AS text FROM (SELECT document_id, unnest(string_split(text.content, chr(10) || chr(10))) AS t, unnest(range(0, len(string_split(text.content, chr(10) || chr(10))))) AS n FROM parsed_documents) s WHERE t LIKE '|%'),
c AS (SELECT document_id, element_id, unnest(string_split(row, '|')) AS cell FROM (SELECT document_id, element_id, unnest(string_split(text, chr(10))) AS row, unnest(range(0, len(string_split(text, chr(10))))) AS row_no FROM e) r WHERE row_no <> 1),
a AS (SELECT document_id, element_id, count(cell) AS cells, count(*) FILTER (WHERE trim(cell) <> '') AS filled FROM c GROUP BY ALL)
SELECT document_id, count(DISTINCT element_id) AS tables, count(*) FILTER (WHERE filled = 0) AS empty_tables, count(*) FILTER (WHERE filled > 0 AND filled / cells < 0.5) AS sparse_tables FROM a GROUP BY document_id
"""
_SOURCE_PAGES = """
WITH n AS (SELECT document_id, page_number, max(length(trim(text, ' '))) AS c FROM native_text_pages GROUP BY ALL),
x AS (SELECT DISTINCT document_id, page_number, width AS px, height AS py FROM run_pages),
o AS (SELECT DISTINCT document_id, p.page_number AS page_number, p.width AS width, p.height AS height FROM (SELECT document_id, unnest(pages) AS p FROM parsed_documents) s),
p AS (SELECT document_id, page_number, width, height, px, py, coalesce(c, 0) AS c FROM o LEFT JOIN x USING (document_id, page_number) LEFT JOIN n USING (document_id, page_number)),
q AS (SELECT *, coalesce(c = 0 AND px IS NOT NULL AND abs(px / py - width / height) / (width / height) <= 0.05, false) AS scan_like FROM p),
d AS (SELECT *, CASE WHEN scan_like THEN least(px / (width / 72), py / (height / 72)) END AS dpi FROM q)
SELECT document_id, count(*) AS page_count, list_sort(coalesce(list(page_number) FILTER (WHERE scan_like), [])) AS scan_pages, list_sort(coalesce(list(page_number) FILTER (WHERE dpi < 150), [])) AS low_resolution_pages,
  list_sort(coalesce(list(page_number) FILTER (WHERE c = 0 AND NOT scan_like), [])) AS unclassified_pages, min(dpi) AS least_dpi FROM d GROUP BY document_id
"""
_RUN_EVIDENCE = """
WITH o AS (SELECT DISTINCT document_id, source.content_sha256 AS own, list_transform(errors, lambda e: e.code) AS a FROM parsed_documents),
r AS (SELECT DISTINCT document_id, source.content_sha256 AS read, list_transform(errors, lambda e: e.code) AS b FROM runs),
g AS (SELECT document_id, bool_and(own = read) AS source_matches, bool_or(coalesce(list_contains(a, 'PDF_ENCRYPTED'), false) OR coalesce(list_contains(b, 'PDF_ENCRYPTED'), false)) AS encrypted,
  bool_or(coalesce(list_contains(a, 'PDF_TEXT_LAYER_UNREADABLE'), false) OR coalesce(list_contains(b, 'PDF_TEXT_LAYER_UNREADABLE'), false)) AS unread FROM o JOIN r USING (document_id) GROUP BY document_id),
c AS (SELECT document_id, CAST(max(CAST(page_json->>'$.page_count' AS BIGINT)) AS INTEGER) AS source_page_count FROM run_pages WHERE json_valid(page_json) GROUP BY document_id)
SELECT document_id, source_matches, NOT (encrypted OR unread) AS readable, encrypted, source_page_count FROM g LEFT JOIN c USING (document_id)
"""
_GATE = f"""
SELECT document_id, list_filter([
   CASE WHEN NOT source_matches THEN 'source_hash_mismatch' END, CASE WHEN NOT readable AND encrypted THEN 'source_pdf_encrypted' END, CASE WHEN NOT readable AND NOT encrypted THEN 'source_pdf_unreadable' END,
   CASE WHEN scans > 0 AND NOT used AND status <> 'failed' THEN 'ocr_required_but_disabled' END,
   CASE WHEN readable AND status = 'partial' AND source_page_count <> pages THEN 'partial_source_contract_page_count_mismatch' END,
   CASE WHEN readable AND status NOT IN ('partial', 'failed') AND source_page_count <> pages THEN 'source_contract_page_count_mismatch' END,
   CASE WHEN low > 0 THEN 'ocr_low_confidence_pages' END, CASE WHEN mean < 0.85 THEN 'ocr_mean_confidence_below_policy' END,
   CASE WHEN pages > 0 AND uncovered = pages THEN 'no_pages_with_parsed_content' END, CASE WHEN status = 'failed' THEN 'parse_failed' END, CASE WHEN uncovered > 0 AND uncovered < pages THEN 'parsed_page_coverage_incomplete' END,
   CASE WHEN status = 'partial' THEN 'partial_parse' END, CASE WHEN lost_share > 0.005 THEN 'replacement_character_ratio_above_policy' END], lambda x: x IS NOT NULL) AS b,
  list_filter([CASE WHEN low_scans > 0 THEN 'scan_resolution_below_policy' END, CASE WHEN unclassified > 0 THEN 'source_pages_without_classifiable_content' END,
   CASE WHEN empty_tables > 0 THEN 'empty_table_artifact' END, CASE WHEN sparse_tables > 0 THEN 'sparse_table_artifact' END, CASE WHEN cjk_space_share > 0.01 THEN 'cjk_internal_space_ratio_above_policy' END, CASE WHEN list_contains(flags, 'ocr_confidence_unavailable') THEN 'ocr_confidence_unavailable' END,
   CASE WHEN status <> 'failed' AND characters_per_page < 20 THEN 'text_density_below_policy' END], lambda x: x IS NOT NULL) AS w
FROM (SELECT p.document_id, p.status, coalesce(p.quality.flags, []) AS flags, p.quality.ocr.mean_confidence AS mean, coalesce(len(p.quality.ocr.low_confidence_pages), 0) AS low,
        len({_PAGES}) AS pages, len(list_filter({_PAGES}, lambda n: NOT list_contains({_covered(_FILLED + " OR coalesce(len(e.artifact_ids), 0) > 0")}, n))) AS uncovered,
        m.characters_per_page, m.lost_share, m.cjk_space_share, p.quality.ocr.used AS used, v.source_matches, v.readable, v.encrypted, v.source_page_count,
        len(g.scan_pages) AS scans, len(g.low_resolution_pages) AS low_scans, len(g.unclassified_pages) AS unclassified, t.empty_tables, t.sparse_tables
      FROM (SELECT *, row_number() OVER () AS r FROM parsed_documents) p
      JOIN (SELECT *, row_number() OVER () AS r FROM ({_SHARES}) q) m ON p.r = m.r
      LEFT JOIN ({_RUN_EVIDENCE}) v ON p.document_id = v.document_id LEFT JOIN ({_SOURCE_PAGES}) g ON p.document_id = g.document_id LEFT JOIN ({_TABLES}) t ON p.document_id = t.document_id) s
"""
_DECIDED = f"""
SELECT document_id, list_sort(b) AS blocking_codes, list_sort(w) AS warning_codes, list_sort(list_concat(b, w)) AS reason_codes,
  CASE WHEN len(b) > 0 THEN 'reject' WHEN len(w) > 0 THEN 'review' ELSE 'accept' END AS decision, CASE WHEN len(b) > 0 THEN 'fallback' ELSE 'publish' END AS route_action FROM ({_GATE}) g
"""
_ERRORS = "coalesce(errors, [])"
_PATH_RE = r"(?:(?:^|[^A-Za-z0-9])[A-Za-z]:[\\/]|\\\\[^\\\s]+[\\/]|(?:^|[^A-Za-z0-9:/])/(?:Users|Volumes|home|private|tmp|var|mnt)/)"
_SAFE_PATH = "length(f.path) > 0 AND f.path NOT LIKE '/%' AND NOT contains(f.path, '\\') AND NOT contains(f.path, ':') AND NOT list_contains(string_split(f.path, '/'), '..')"


def _rules(rules: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN NOT coalesce({ok}, false) THEN '{code}' END" for code, ok in rules) + "], lambda x: x IS NOT NULL)"


def _all(items: str, test: str) -> str:
    return f"len(list_filter({items}, lambda f: NOT coalesce({test}, false))) = 0"


_ID, _SHA = "'^[A-Za-z0-9][A-Za-z0-9._-]{0,159}$'", "'^[a-f0-9]{64}$'"
_NUMBERS = "list_transform(coalesce(pages, []), lambda p: p.page_number)"
_UNIQUE_PAGES = "(SELECT DISTINCT ON (run_id, page_number) * FROM run_pages WHERE json_valid(page_json))"

SQL = {
    "text_measures": _SHARES,
    "page_coverage": f"SELECT *, list_filter(page_numbers, lambda n: NOT list_contains(covered_pages, n)) AS uncovered_pages FROM ({_COVERAGE}) c",
    "quality_gate": _DECIDED,
    "run_evidence": _RUN_EVIDENCE,
    "ocr_confidence": f"""
WITH l AS (SELECT run_id, page_number, CAST(json_extract(page_json, '$.ocr_lines[' || i || '].score') AS DOUBLE) AS score
  FROM (SELECT run_id, page_number, page_json, unnest(range(0, CAST(coalesce(json_array_length(page_json, '$.ocr_lines'), 0) AS BIGINT))) AS i FROM {_UNIQUE_PAGES} u) s),
p AS (SELECT run_id, page_number, sum(score) AS total, count(*) AS n FROM l WHERE score IS NOT NULL GROUP BY ALL)
SELECT run_id, CAST(sum(n) AS BIGINT) AS line_count, sum(total) / sum(n) AS mean_confidence,
  list_sort(coalesce(list(page_number) FILTER (WHERE total / n < 0.8), [])) AS low_confidence_pages FROM p GROUP BY run_id
""",
    "route_decision": f"""
WITH g AS (SELECT DISTINCT document_id, route_action FROM ({_DECIDED}) d), f AS (SELECT DISTINCT document_id FROM run_pages)
SELECT g.document_id, CASE WHEN route_action = 'publish' THEN 'selected_primary' WHEN f.document_id IS NOT NULL THEN 'selected_fallback' ELSE 'degraded' END AS outcome,
  CASE WHEN route_action = 'publish' THEN 'primary' WHEN f.document_id IS NOT NULL THEN 'fallback' END AS selected FROM g LEFT JOIN f USING (document_id)
""",
    "fallback_work": f"SELECT DISTINCT document_id FROM ({_DECIDED}) d WHERE route_action <> 'publish'",
    "report_consistency": f"""
WITH g AS (SELECT DISTINCT * FROM ({_DECIDED}) d), s AS (SELECT DISTINCT document_id, status FROM parsed_documents),
r AS (SELECT document_id, status, (strpos('0123456789abcdef', document_id[-1:]) - 1) % 8 AS n, decision, route_action, reason_codes, warning_codes, blocking_codes FROM g JOIN s USING (document_id)),
t AS (SELECT document_id, status <> 'failed' AS completed, n <> 1 AS assessed, CASE WHEN n = 2 THEN 'maybe' ELSE decision END AS decision, CASE WHEN n = 3 THEN 'publish' ELSE route_action END AS route_action,
        reason_codes, CASE WHEN n = 4 THEN [''] ELSE warning_codes END AS w, blocking_codes AS b FROM r)
SELECT document_id, CASE WHEN NOT completed THEN 'PARSER_RUN_FAILED' WHEN NOT assessed THEN 'QUALITY_ASSESSMENT_FAILED' WHEN decision NOT IN ('accept', 'review', 'reject') THEN 'INVALID_QUALITY_DECISION'
  WHEN list_contains(w, '') OR list_contains(b, '') OR list_sort(reason_codes) <> list_sort(list_distinct(list_concat(w, b))) OR list_has_any(w, b)
    OR (route_action = 'publish' AND len(b) > 0) OR (route_action = 'fallback' AND len(b) = 0) THEN 'INVALID_QUALITY_REPORT' END AS failure_code FROM t
""",
    "failure_stages": "SELECT run_id, list_sort(list_distinct(list_filter(list_transform(coalesce(errors, []), lambda e: e.stage), lambda s: length(s) > 0))) AS failure_stages FROM runs",
    "table_measures": _TABLES,
    "source_pages": _SOURCE_PAGES,
    "contract_violations": "SELECT document_id, " + _rules([
        ("contract_version", "contract_version = '1.0'"), ("document_id", f"regexp_matches(document_id, {_ID})"), ("source_ref", f"regexp_matches(source.source_ref, {_ID})"), ("source_sha256", f"regexp_matches(source.content_sha256, {_SHA})"),
        ("media_type", "length(trim(source.media_type)) > 0"), ("parser", "length(trim(parser_run.parser_name)) > 0 AND length(trim(parser_run.parser_version)) > 0"),
        ("engine", "length(trim(parser_run.engine_name)) > 0 AND length(trim(parser_run.engine_version)) > 0"), ("status", "status IN ('succeeded', 'partial', 'failed')"),
        ("page_number", _all(_NUMBERS, "f >= 1")), ("duplicate_page", f"len(list_distinct({_NUMBERS})) = len({_NUMBERS})"), ("text_content", "text IS NULL OR length(trim(text.content)) > 0"),
        ("text_sha256", "text IS NULL OR sha256(text.content) = text.content_sha256"), ("text_language", "text IS NULL OR length(trim(text.language)) > 0"),
        ("artifact_path", _all("coalesce(artifacts, [])", _SAFE_PATH)), ("artifact_sha256", _all("coalesce(artifacts, [])", f"regexp_matches(f.content_sha256, {_SHA})")),
        ("failed_with_content", f"status <> 'failed' OR (text IS NULL AND len({_NUMBERS}) = 0)"), ("missing_content", f"status = 'failed' OR (text IS NOT NULL AND len({_NUMBERS}) > 0)"),
    ]) + " AS violations FROM parsed_documents",
    "run_violations": "SELECT run_id, " + _rules([
        ("state_version", "output_state_version = 1"), ("status", "result.status IN ('succeeded', 'partial', 'failed')"), ("empty_inventory", "result.status = 'failed' OR coalesce(len(output_files), 0) > 0"),
        ("inventory_path", _all("coalesce(output_files, [])", _SAFE_PATH)),
        ("duplicate_path", "len(list_distinct(list_transform(coalesce(output_files, []), lambda f: f.path))) = coalesce(len(output_files), 0)"), ("inventory_size", _all("coalesce(output_files, [])", "f.byte_size >= 0")),
        ("inventory_sha256", _all("coalesce(output_files, [])", f"regexp_matches(f.content_sha256, {_SHA})")), ("errors_of_success", f"result.status <> 'succeeded' OR len({_ERRORS}) = 0"),
        ("no_errors_of_failure", f"result.status = 'succeeded' OR len({_ERRORS}) > 0"), ("error_code", _all(_ERRORS, "regexp_matches(f.code, '^[A-Z][A-Z0-9_]*$')")),
        ("error_stage", _all(_ERRORS, "f.stage IN ('input', 'download', 'parse', 'ocr', 'layout', 'export', 'unknown')")),
        ("error_message", _all(_ERRORS, f"length(trim(f.sanitized_message)) > 0 AND NOT regexp_matches(f.sanitized_message, '{_PATH_RE}') AND NOT contains(f.sanitized_message, 'Traceback (most recent call last)')")),
        ("error_retryable", _all(_ERRORS, "f.retryable IS NOT NULL")), ("error_page", _all(_ERRORS, "f.page_number IS NULL OR f.page_number >= 1")),
    ]) + " AS violations FROM runs",
    "native_text_violations": "WITH v AS (SELECT document_id, page_number, " + _rules([
        ("evidence_version", "evidence_version = '1.0'"), ("page_number", "page_number >= 1"), ("source_sha256", f"regexp_matches(source_sha256, {_SHA})"), ("text_sha256", "text IS NULL OR sha256(text) = text_sha256"),
    ]) + """ AS v FROM native_text_pages)
SELECT document_id, page_number, count(*) AS n, list_concat(list_sort(list_distinct(flatten(list(v)))), CASE WHEN count(*) > 1 THEN ['duplicate_page'] ELSE [] END) AS violations FROM v GROUP BY document_id, page_number
""",
    "export_counts": f"""
WITH b AS (SELECT DISTINCT run_id, page_number, i, json_extract_string(page_json, '$.parsing_res_list[' || i || '].block_label') AS l
  FROM (SELECT run_id, page_number, page_json, unnest(range(0, CAST(coalesce(json_array_length(page_json, '$.parsing_res_list'), 0) AS BIGINT))) AS i FROM run_pages WHERE json_valid(page_json)) s),
n AS (SELECT run_id, l || 's' AS collection, count(*) AS n FROM b WHERE l IN ('table', 'image') GROUP BY ALL),
u AS (SELECT DISTINCT ON (run_id, page_number) * FROM run_pages),
x AS (SELECT run_id, 'images' AS collection, sum(coalesce(len(images), 0)) AS n FROM u GROUP BY run_id UNION ALL SELECT run_id, 'tables', sum(coalesce(len(tables), 0)) FROM u GROUP BY run_id),
y AS (SELECT * FROM x WHERE n > 0), s AS (SELECT DISTINCT run_id, result.status AS status FROM runs)
SELECT run_id, collection, CASE WHEN coalesce(n.n, 0) = coalesce(y.n, 0) THEN 'ok' WHEN status = 'partial' THEN 'drop' ELSE 'error' END AS action
FROM n FULL JOIN y USING (run_id, collection) JOIN s USING (run_id)
""",
    "page_payload_checks": """
WITH p AS (SELECT run_id, page_number, width, height, CASE WHEN json_valid(page_json) THEN page_json END AS j FROM (SELECT DISTINCT ON (run_id, page_number) * FROM run_pages) u),
r AS (SELECT run_id, page_number, j IS NOT NULL AS readable, CAST(j->'$.page_index' AS BIGINT) + 1 = page_number AS index_ok, CAST(j->'$.width' AS DOUBLE) IS NOT DISTINCT FROM width AND CAST(j->'$.height' AS DOUBLE) IS NOT DISTINCT FROM height AS size_ok,
  CAST(j->'$.page_count' AS BIGINT) AS n FROM p),
g AS (SELECT run_id, count(*) AS pages, bool_and(readable) AS readable, bool_and(coalesce(index_ok, NOT readable)) AS index_ok, bool_and(size_ok OR NOT readable) AS size_ok, count(DISTINCT page_number) AS numbers, max(page_number) AS highest, min(n) AS least, max(n) AS most FROM r GROUP BY run_id)
SELECT run_id, pages, """ + _rules([("unreadable_page", "readable"), ("page_index", "index_ok"), ("page_size", "size_ok"), ("duplicate_page", "numbers = pages"), ("page_count_varies", "least = most"), ("page_count_too_low", "most >= 1 AND most >= numbers AND most >= highest")]) + " AS violations FROM g",
    "identity_checks": "WITH d AS (SELECT CASE WHEN length('doc ' || doc_id) % 2 = 0 THEN 'doc-' || doc_id ELSE 'doc ' || doc_id END AS document_id, source AS source_ref, lang AS language FROM documents) SELECT *, " + _rules([
        ("document_id", f"regexp_matches(document_id, {_ID})"), ("source_ref", f"regexp_matches(source_ref, {_ID})"), ("language", "length(trim(language)) >= 2")]) + " AS violations FROM d",
    "run_durations": """
SELECT run_id, epoch_ms(CAST(result.completed_at AS TIMESTAMPTZ)) - epoch_ms(CAST(result.started_at AS TIMESTAMPTZ)) AS elapsed_ms, strftime(CAST(result.started_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS started
FROM (SELECT DISTINCT run_id, result FROM runs) r
""",
}
SQL["routing_payload"] = f"SELECT document_id, 2 AS routing_version, outcome, CASE WHEN selected IS NOT NULL THEN document_id || '/' || selected || '/parsed-document.json' END AS contract_path FROM ({SQL['route_decision']}) r"
