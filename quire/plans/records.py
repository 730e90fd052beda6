"""Queries of text functions, run records and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions import trees
from quire.operators import contract, evidence, incremental, links, order
from quire.sources.tables import table

#: Parts of diagnostics that carry what must not be published; chosen by a document's number.
_MESSAGES = (
    "cannot open /home/user/in/report.pdf: file is encrypted", "C:\\work\\in\\report.pdf (12): timed out after 300 s", "Resource exhausted near\tpage 7", "bad xref table", "Password needed for report.pdf",
    "failed at https://host/tmp/x, see /tmp/run-1/out.log", "Traceback (most recent call last): line 1",
)


def _messages(spark, sf_dir):
    number = F.pmod("doc_id", F.lit(len(_MESSAGES)))
    return table(spark, sf_dir, "documents").select("doc_id", F.element_at(F.array(*map(F.lit, _MESSAGES)), (number + 1).cast("int")).alias("message"))


def error_classify(spark, sf_dir):
    code = T.error_code(F.col("message"))
    return _messages(spark, sf_dir).select("doc_id", code.alias("code"), T.is_retryable(code).alias("retryable"))


def error_sanitize(spark, sf_dir):
    return _messages(spark, sf_dir).select("doc_id", T.safe_message(F.col("message"), F.lit("report.pdf")).alias("message"), T.has_absolute_path(F.col("message")).alias("had_path"))


def _paths(spark, sf_dir):
    """Output paths as they are, climbing, absolute, with a drive, and with a backslash."""
    runs = table(spark, sf_dir, "runs").select("run_id", F.explode("output_files").alias("f")).select("run_id", F.col("f.path").alias("path")).distinct()
    forms = F.array(F.col("path"), F.concat(F.lit("../"), "path"), F.concat(F.lit("/"), "path"), F.concat(F.lit("C:"), "path"), F.concat(F.lit("a\\"), "path"), F.lit(""))
    return runs.select("run_id", F.explode(forms).alias("path"))


def path_safety(spark, sf_dir):
    return _paths(spark, sf_dir).select("run_id", "path", T.safe_relative_path(F.col("path")).alias("safe"), T.relative_path_without_climbing(F.col("path")).alias("weakly_safe"))


def media_type(spark, sf_dir):
    return _paths(spark, sf_dir).select("run_id", "path", T.media_type(F.upper("path")).alias("media_type"))


def identifier_suffix(spark, sf_dir):
    """Titles and document numbers as parts of identifiers."""
    return table(spark, sf_dir, "documents").select("doc_id", T.identifier_suffix(F.coalesce("title", F.lit("-.-"))).alias("suffix"), T.collection_element_id(F.lit("texts"), F.col("doc_id")).alias("element_id"))


def run_ids(spark, sf_dir):
    """Ids and request digests of runs."""
    r = table(spark, sf_dir, "runs")
    digest = T.canonical_digest(F.struct(F.col("request.chart").alias("chart"), F.col("request.layout").alias("layout"), F.col("request.use_ocr").alias("use_ocr")))
    return r.select("run_id", digest.alias("request_sha256")).distinct().join(
        r.select("run_id", F.col("source.content_sha256").alias("s"), F.col("parser.name").alias("n"), F.col("parser.version").alias("v"), F.col("result.started_at").alias("t")).distinct(), "run_id"
    ).select("run_id", "request_sha256", T.run_id(F.col("s"), F.col("n"), F.col("v"), F.col("t"), F.col("request_sha256")).alias("computed_id"))


def output_names(spark, sf_dir):
    """Directory names for sources below their publishers' folders."""
    identity = F.concat_ws("/", F.coalesce("publisher", F.lit("in: out")), F.concat(F.coalesce("title", F.lit("")), F.lit(".v2.pdf")))
    return table(spark, sf_dir, "sources").select("source_ref", T.output_name(identity).alias("name"), T.output_name(identity, True).alias("prefixed"), T.output_directory(identity).alias("directory"))


def md_image_rewrite(spark, sf_dir):
    c = table(spark, sf_dir, "parsed_documents").select("document_id", F.replace(F.col("text.content"), F.lit("](artifacts/"), F.lit("](out/x\\y/")).alias("c"))
    return c.select("document_id", T.markdown_images_relative(F.col("c")).alias("content"))


def inventory_diff(spark, sf_dir):
    """Recorded files against a copy in which some are gone, some are changed and one is new."""
    f = table(spark, sf_dir, "runs").dropDuplicates(["run_id"]).select("run_id", F.explode("output_files").alias("f")).select("run_id", "f.path", "f.byte_size", "f.content_sha256")
    f = f.groupBy("run_id", "path").agg(F.max("byte_size").alias("byte_size"), F.max("content_sha256").alias("content_sha256"))
    kept = f.where("byte_size % 7 <> 0").withColumn("byte_size", F.expr("byte_size + IF(byte_size % 5 = 0, 1, 0)"))
    new = f.select("run_id", F.lit("new.txt").alias("path"), F.lit(1).cast("bigint").alias("byte_size"), F.lit("").alias("content_sha256")).distinct()
    return links.set_difference(f, kept.unionByName(new), ["run_id", "path"], ["byte_size", "content_sha256"])


def incremental_skip(spark, sf_dir):
    """Which documents need no new run, when some sources and one parser have changed."""
    runs = table(spark, sf_dir, "runs")
    wanted = table(spark, sf_dir, "parsed_documents").select(
        "document_id", F.col("source.content_sha256").alias("content_sha256"), F.expr("source.byte_size + IF(source.byte_size % 11 = 0, 1, 0)").alias("byte_size")).distinct()
    latest = links.latest(runs.select("document_id", F.col("parser.source_sha256").alias("parser_sha256"), "request", "received_at", "run_id"), "document_id", by="received_at").drop("received_at", "run_id")
    files = runs.select("run_id", F.explode("output_files").alias("f")).select("run_id", "f.path", "f.byte_size", "f.content_sha256").distinct()
    agreeing = incremental.inventory_agrees(files, files.where("byte_size % 13 <> 0"))
    return incremental.can_skip(runs, wanted.join(latest.select("document_id", "parser_sha256", "request"), "document_id"), agreeing)


def batch_summary(spark, sf_dir):
    r = table(spark, sf_dir, "runs").select("run_id", F.col("parser.name").alias("parser"), F.col("result.status").alias("status")).distinct()
    return incremental.batch_summary(r, "parser")


def dup_checks(spark, sf_dir):
    """Page keys and run ids that were delivered more than once."""
    pages = links.repeated_keys(table(spark, sf_dir, "native_text_pages").selectExpr("'page' AS kind", "document_id || '/' || page_number AS key"), "kind", "key")
    return pages.unionByName(links.repeated_keys(table(spark, sf_dir, "runs").selectExpr("'run' AS kind", "run_id AS key"), "kind", "key"))


def page_index_coverage(spark, sf_dir):
    p = table(spark, sf_dir, "run_pages").select("run_id", "page_number", F.get_json_object("page_json", "$.page_count").cast("int").alias("page_count"))
    return incremental.page_gaps(p)


def backend_selection(spark, sf_dir):
    """The runs of a document as attempts in order of their start."""
    r = table(spark, sf_dir, "runs").select("document_id", "run_id", F.col("result.started_at").alias("at"), F.col("result.status").alias("status"), F.transform(F.coalesce("errors", F.array()), lambda e: e["code"]).alias("errors")).distinct()
    from pyspark.sql import Window

    attempts = r.withColumn("attempt_no", F.row_number().over(Window.partitionBy("document_id").orderBy("at", "run_id"))).withColumn("has_document", F.lit(True))
    return contract.best_attempt(attempts)


def outcome_errors(spark, sf_dir):
    c = table(spark, sf_dir, "parsed_documents").distinct()
    codes = F.transform(F.coalesce("errors", F.array()), lambda e: e["code"])
    return c.select("document_id", incremental.outcome_errors(F.col("status") != "failed", F.col("text.content"), F.col("quality.ocr.used"), codes, F.coalesce(F.size("artifacts"), F.lit(0)) > 0).alias("codes"))


def first_errors(spark, sf_dir):
    """The first error of each source's contracts, and how many more there are."""
    c = table(spark, sf_dir, "parsed_documents").select(F.col("source.source_ref").alias("source_ref"), "document_id", F.posexplode("errors").alias("i", "e")).distinct()
    e = c.select("source_ref", F.concat_ws("/", "document_id", F.col("i").cast("string")).alias("error_no"), F.col("e.code").alias("code"))
    return order.first_errors(e, "source_ref", 2)


def evidence_status(spark, sf_dir):
    e = table(spark, sf_dir, "runs").select("run_id", F.col("result.status").alias("s"), F.coalesce(F.size("errors"), F.lit(0)).alias("n"))
    return e.select("run_id", contract.evidence_status((F.col("s") == "failed"), F.col("n")).alias("status"))


def run_fields(spark, sf_dir):
    """Whether OCR was asked for, the OCR language, the engine pair and the quality flags of each run."""
    r = table(spark, sf_dir, "runs").join(table(spark, sf_dir, "parsed_documents").select("document_id", F.col("text.language").alias("language")).distinct(), "document_id", "left")
    return r.select(
        "run_id", "language", contract.first_true(F.col("request.use_ocr"), F.col("request.chart")).alias("ocr_used"), contract.ocr_language(F.coalesce("language", F.lit(""))).alias("ocr_language"),
        contract.engine_pair(F.col("parser.backend")).alias("engine"), contract.first_filled(F.col("parser.engine_name"), F.col("parser.name")).alias("engine_name"),
        contract.quality_flags([("partial_parse", F.col("result.status") == "partial"), ("ocr_confidence_unavailable", F.col("request.use_ocr")), ("bbox_degenerate_expanded", F.col("result.duration_ms") < 1000)]).alias("flags"),
    ).distinct()


def content_items(spark, sf_dir):
    """Contract elements as a parser's content items: labels, texts and captions."""
    e = table(spark, sf_dir, "parsed_documents").dropDuplicates(["document_id"]).select("document_id", F.posexplode("elements").alias("n", "e"))
    kind = F.when(F.col("e.kind") == "picture", "image").when(F.col("e.kind").isin("paragraph", "heading"), "text").otherwise(F.col("e.kind"))
    level = F.when(F.col("e.kind") == "heading", F.when(F.col("n") == 0, 1).otherwise(2))
    items = e.select("document_id", "n", kind.alias("kind"), level.alias("level"), F.col("e.text").alias("text"), F.col("e.artifact_ids").alias("captions"), F.transform(F.col("e.provenance"), lambda x: x["parser_element_ref"]).alias("footnotes"))
    labelled = items.select(
        "document_id", "n", contract.item_label(F.col("kind"), F.col("level")).alias("item_label"),
        contract.item_text(F.col("kind"), F.when(F.col("kind") == "table", F.lit("")).otherwise(F.col("text")), F.lit(""), F.lit(None).cast("string"), F.lit(None).cast("array<string>"), F.col("text")).alias("item_text"),
        contract.formula_text(F.lit("formula"), F.when(F.col("n") % 2 == 0, F.lit(" ")).otherwise(F.col("text")), F.col("text")).alias("formula_text"), "kind", "captions", "footnotes")
    return contract.with_captions(labelled)


def zipped_lines(spark, sf_dir):
    """OCR lines taken apart into three arrays of unequal length and zipped again."""
    p = table(spark, sf_dir, "run_pages").dropDuplicates(["run_id", "page_number"]).select(
        "run_id", "page_number", F.from_json("page_json", "ocr_lines ARRAY<STRUCT<text: STRING, score: DOUBLE, bbox: ARRAY<DOUBLE>>>")["ocr_lines"].alias("l")).where("size(l) > 0")
    z = p.select("run_id", "page_number", contract.zipped_lines(F.col("l.text"), F.expr("slice(l.score, 1, size(l) - 1)"), F.col("l.bbox")).alias("z"))
    return z.select("run_id", "page_number", F.size("z").alias("lines"), F.try_element_at("z", F.lit(-1))["text"].alias("last_text"), F.try_element_at("z", F.lit(-1))["score"].alias("last_score"))


def _views(spark, sf_dir):
    """The native text of each document's pages and the contract's, without white space."""
    blank = r"(?U)[\s\x1c-\x1f]+"
    n = table(spark, sf_dir, "native_text_pages").where("text IS NOT NULL").select("document_id", "page_number", "text").distinct()
    native = n.groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "text"))), lambda x: x["text"]), "").alias("native"))
    p = table(spark, sf_dir, "parsed_documents").where("text.content IS NOT NULL").select("document_id", F.col("text.content").alias("parsed")).distinct()
    return p.join(native, "document_id").select("document_id", F.regexp_replace("parsed", blank, "").alias("parsed"), F.regexp_replace("native", blank, "").alias("native"))


def text_multiset_coverage(spark, sf_dir):
    return evidence.compare_views(_views(spark, sf_dir))


def text_route(spark, sf_dir):
    return evidence.text_route(text_multiset_coverage(spark, sf_dir))


def text_lines(spark, sf_dir):
    t = table(spark, sf_dir, "native_text_pages").select("document_id", "page_number", "text").distinct()
    return t.select("document_id", "page_number", T.line_count(F.coalesce("text", F.lit(""))).alias("lines"), T.cjk_internal_spaces(F.coalesce("text", F.lit("")), T.CJK_SPACE_IN_EVIDENCE).alias("cjk_spaces"))


def order_similarity(spark, sf_dir):
    """How alike the order of a page's native text and of its parsed blocks is."""
    from quire.plans.layout import page_text_concat

    pages = page_text_concat(spark, sf_dir).join(table(spark, sf_dir, "runs").select("run_id", "document_id").distinct(), "run_id")
    native = table(spark, sf_dir, "native_text_pages").where("text IS NOT NULL").select("document_id", "page_number", F.col("text").alias("native")).distinct()
    return pages.join(native, ["document_id", "page_number"]).select("run_id", "page_number", T.order_similarity(T.compact_text(F.col("text")), T.compact_text(F.col("native"))).alias("similarity"))


def nfkc_compact(spark, sf_dir):
    return table(spark, sf_dir, "native_text_pages").select("document_id", "page_number", T.compact_text(F.col("text")).alias("compact"))


def json_sanitize(spark, sf_dir):
    c = trees.clean_tree(F.col("page_json"))
    return table(spark, sf_dir, "run_pages").select("run_id", "page_number", c.alias("c"), trees.has_forbidden_key(F.col("page_json")).alias("forbidden")).select("run_id", "page_number", "c.json", "c.problem", "forbidden")


def safe_model_settings(spark, sf_dir):
    return table(spark, sf_dir, "run_pages").select("run_id", "page_number", trees.plain_settings(F.get_json_object("page_json", "$.model_settings")).alias("settings"))


def _table_texts(spark, sf_dir):
    """The pipe tables of contracts: paragraphs that begin with a bar."""
    c = table(spark, sf_dir, "parsed_documents").select("document_id", F.posexplode(F.split("text.content", "\n\n")).alias("table_no", "text")).distinct()
    return c.where("text LIKE '|%'")


def csv_table(spark, sf_dir):
    t = _table_texts(spark, sf_dir).select("document_id", "table_no", F.translate("text", "|", ",").alias("csv"))
    spark.udtf.register("csv_cells", trees.CsvCells)
    return spark.sql("SELECT document_id, table_no, c.* FROM {t}, LATERAL csv_cells(csv) c", t=t)


def html_table(spark, sf_dir):
    row = F.transform(F.split("text", "\n"), lambda r: F.concat(F.lit("<tr><td>"), F.replace(r, F.lit("|"), F.lit("</td><td>")), F.lit("</td></tr>")))
    t = _table_texts(spark, sf_dir).select("document_id", "table_no", F.concat(F.lit("<table>"), F.array_join(row, ""), F.lit("</table>")).alias("html"))
    spark.udtf.register("html_cells", trees.HtmlCells)
    return spark.sql("SELECT document_id, table_no, c.* FROM {t}, LATERAL html_cells(html, 1) c", t=t)


QUERIES = {f.__name__: f for f in (
    error_classify, error_sanitize, path_safety, media_type, identifier_suffix, run_ids, output_names, md_image_rewrite, inventory_diff, incremental_skip, batch_summary, dup_checks, page_index_coverage, backend_selection,
    outcome_errors, first_errors, evidence_status, run_fields, content_items, zipped_lines, text_multiset_coverage, text_route, text_lines, order_similarity, nfkc_compact, json_sanitize, safe_model_settings, csv_table, html_table)}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_MSG = "(SELECT doc_id, [" + ", ".join(map(_q, _MESSAGES)) + f"][doc_id % {len(_MESSAGES)} + 1] AS message FROM documents)"
_LOW = "lower(message)"
_CODE = f"""CASE WHEN contains({_LOW}, 'password') OR contains({_LOW}, 'encrypted') OR contains({_LOW}, 'encryption') THEN 'PDF_ENCRYPTED' WHEN contains({_LOW}, 'timeout') OR contains({_LOW}, 'timed out') THEN 'PARSE_TIMEOUT'
  WHEN contains({_LOW}, 'out of memory') OR contains({_LOW}, 'resource exhausted') THEN 'RESOURCE_EXHAUSTED' ELSE 'PDF_PARSE_FAILED' END"""
_PATH = r"(?:(?:^|[^A-Za-z0-9])[A-Za-z]:[\\/]|\\\\[^\\\s]+[\\/]|(?:^|[^A-Za-z0-9:/])/(?:Users|Volumes|home|private|tmp|var|mnt)/)"
_PATH_ALL = r"((?:^|[^A-Za-z0-9]))[A-Za-z]:[\\/][^\s,;:()]+"
_PATH_POSIX = r"((?:^|[^A-Za-z0-9:/]))/(?:Users|Volumes|home|private|tmp|var|mnt)/[^\s,;:()]+"
_PATHS = """(SELECT run_id, unnest([path, '../' || path, '/' || path, 'C:' || path, 'a\\' || path, '']) AS path FROM (SELECT DISTINCT run_id, f.path AS path FROM (SELECT run_id, unnest(output_files) AS f FROM runs) s) t)"""
_CLEAN = "trim(regexp_replace({v}, '[^A-Za-z0-9._-]+', '_', 'g'), '_')"


def _component(v: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim({v}), '[.\\- ]+$', ''), '[<>:\"/\\\\|?*\\[\\]]', '_', 'g'), '\\s+', '_', 'g'), '_+', '_', 'g'), '_')"


_IDENT = "(SELECT source_ref, coalesce(publisher, 'in: out') AS p, coalesce(title, '') || '.v2' AS stem, coalesce(publisher, 'in: out') || '/' || coalesce(title, '') || '.v2.pdf' AS i FROM sources)"
_FILES = "(SELECT run_id, path, max(byte_size) AS byte_size, max(content_sha256) AS content_sha256 FROM (SELECT run_id, f.path AS path, f.byte_size AS byte_size, f.content_sha256 AS content_sha256 FROM (SELECT run_id, unnest(output_files) AS f FROM (SELECT DISTINCT ON (run_id) * FROM runs) r) s) t GROUP BY ALL)"
_WS = "[\\s\\p{Z}\\x{1c}-\\x{1f}\\x{85}]+"
_VIEWS = f"""(WITH n AS (SELECT document_id, string_agg(text, '' ORDER BY page_number, text) AS native FROM (SELECT DISTINCT document_id, page_number, text FROM native_text_pages WHERE text IS NOT NULL) s GROUP BY document_id),
p AS (SELECT DISTINCT document_id, text.content AS parsed FROM parsed_documents WHERE text.content IS NOT NULL)
SELECT document_id, regexp_replace(parsed, '{_WS}', '', 'g') AS parsed, regexp_replace(native, '{_WS}', '', 'g') AS native FROM p JOIN n USING (document_id))"""
_COVERAGE = f"""(WITH v AS {_VIEWS},
a AS (SELECT document_id, c, count(*) AS a FROM (SELECT document_id, unnest(string_split(parsed, '')) AS c FROM v) s WHERE c <> '' GROUP BY ALL), b AS (SELECT document_id, c, count(*) AS b FROM (SELECT document_id, unnest(string_split(native, '')) AS c FROM v) s WHERE c <> '' GROUP BY ALL),
s AS (SELECT document_id, CAST(sum(least(a, b)) AS BIGINT) AS shared FROM a JOIN b USING (document_id, c) GROUP BY ALL)
SELECT v.document_id, length(parsed) AS parsed_characters, length(native) AS native_characters, coalesce(shared, 0) AS shared_characters, parsed = native AS same,
  coalesce(shared, 0) / nullif(length(parsed), 0) AS parsed_coverage, coalesce(shared, 0) / nullif(length(native), 0) AS native_coverage FROM v LEFT JOIN s USING (document_id))"""

_TABLES = "(SELECT DISTINCT document_id, n, t FROM (SELECT document_id, unnest(string_split(text.content, chr(10) || chr(10))) AS t, unnest(range(0, len(string_split(text.content, chr(10) || chr(10))))) AS n FROM parsed_documents) s WHERE t LIKE '|%')"
_ROWS = f"(SELECT document_id, n, t, unnest(string_split(t, chr(10))) AS r, unnest(range(1, 1 + len(string_split(t, chr(10))))) AS row_no FROM {_TABLES} x)"
_ENDS = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]"
_EV = "\\x{3400}-\\x{9FFF}"

SQL = {
    "incremental_skip": """
WITH w AS (SELECT DISTINCT document_id, source.content_sha256 AS s, source.byte_size + CASE WHEN source.byte_size % 11 = 0 THEN 1 ELSE 0 END AS z FROM parsed_documents),
l AS (SELECT DISTINCT ON (document_id) document_id, parser.source_sha256 AS p, request AS q FROM runs ORDER BY document_id, received_at DESC),
f AS (SELECT DISTINCT run_id, unnest(output_files) AS f FROM runs), a AS (SELECT run_id FROM f GROUP BY run_id HAVING bool_and(f.byte_size % 13 <> 0)),
d AS (SELECT document_id, source.content_sha256 AS s, source.byte_size AS z, parser.source_sha256 AS p, request AS q, output_state_version = 1 AND result.status = 'succeeded' AND len(list_filter(coalesce(output_files, []), lambda x: x.path = 'content.md' AND x.byte_size > 0)) > 0 AS ok
  FROM runs WHERE run_id IN (SELECT run_id FROM a))
SELECT w.document_id, coalesce(bool_or(d.ok AND d.s IS NOT DISTINCT FROM w.s AND d.z IS NOT DISTINCT FROM w.z AND d.p IS NOT DISTINCT FROM l.p AND d.q IS NOT DISTINCT FROM l.q), false) AS skip
FROM w JOIN l USING (document_id) LEFT JOIN d ON d.document_id = w.document_id GROUP BY w.document_id
""",
    "backend_selection": """
WITH r AS (SELECT DISTINCT document_id, run_id, result.started_at AS began, result.status AS status, list_transform(coalesce(errors, []), lambda e: e.code) AS e FROM runs),
a AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY began, run_id) AS n, CASE status WHEN 'succeeded' THEN 1 WHEN 'partial' THEN 2 END AS k FROM r),
g AS (SELECT document_id, min(k) AS k, flatten(list(e ORDER BY n)) AS e FROM a GROUP BY document_id),
b AS (SELECT a.document_id, min(a.n) AS n FROM a JOIN g ON a.document_id = g.document_id AND a.k = g.k GROUP BY ALL)
SELECT g.document_id, CAST(b.n AS INTEGER) AS attempt_no, CASE k WHEN 1 THEN 'succeeded' WHEN 2 THEN 'partial' ELSE 'failed' END AS status,
  CASE WHEN k = 1 THEN [] WHEN k = 2 THEN list_transform(e, lambda x: CASE WHEN x = 'PARSE_TIMEOUT' THEN x ELSE 'PDF_PARTIAL_PARSE' END) ELSE e END AS errors, CASE WHEN k = 1 THEN e ELSE [] END AS diagnostics
FROM g LEFT JOIN b ON b.document_id = g.document_id
""",
    "text_lines": f"""
SELECT document_id, page_number, CAST(len(regexp_extract_all(t, '{_ENDS}')) + CASE WHEN t = '' OR regexp_matches(t, '[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]\\z') THEN 0 ELSE 1 END AS BIGINT) AS lines,
  CAST(len(regexp_extract_all(regexp_replace(t, '([{_EV}])', '\\1\\1', 'g'), '[{_EV}] +[{_EV}]')) AS BIGINT) AS cjk_spaces FROM (SELECT DISTINCT document_id, page_number, coalesce(text, '') AS t FROM native_text_pages) s
""",
    "csv_table": f"SELECT document_id, CAST(n AS INTEGER) AS table_no, CAST(row_no AS INTEGER) AS row_no, CAST(unnest(range(1, 1 + len(string_split(replace(r, '|', ','), ',')))) AS INTEGER) AS column_no, unnest(string_split(replace(r, '|', ','), ',')) AS cell FROM {_ROWS} r",
    "html_table": f"""
SELECT document_id, CAST(n AS INTEGER) AS table_no, CAST(row_no AS INTEGER) AS row_no, CAST(unnest(range(1, 1 + len(string_split(r, '|')))) AS INTEGER) AS column_no, trim(regexp_replace(unnest(string_split(r, '|')), '{_WS}', ' ', 'g')) AS cell, row_no <= 1 AS is_header FROM {_ROWS} r
""",
    "error_classify": f"SELECT doc_id, {_CODE} AS code, {_CODE} IN ('PARSE_TIMEOUT', 'RESOURCE_EXHAUSTED') AS retryable FROM {_MSG} m",
    "error_sanitize": f"""
SELECT doc_id, coalesce(nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(string_split(message, 'Traceback (most recent call last)')[1], 'report.pdf', '[source]'), '{_PATH_ALL}', '\\1[path]', 'g'), '{_PATH_POSIX}', '\\1[path]', 'g'),
  '[\\x00-\\x1f\\x7f]+', ' ', 'g'), '\\s+', ' ', 'g')), ''), 'No safe diagnostic detail was available')[1:500] AS message, regexp_matches(message, '{_PATH}') AS had_path FROM {_MSG} m
""",
    "path_safety": f"""
SELECT run_id, path, length(path) > 0 AND path NOT LIKE '/%' AND NOT contains(path, '\\') AND NOT contains(path, ':') AND NOT list_contains(string_split(path, '/'), '..') AS safe,
  path NOT LIKE '/%' AND NOT list_contains(string_split(path, '/'), '..') AS weakly_safe FROM {_PATHS} p
""",
    "media_type": f"SELECT run_id, path, CASE lower(regexp_extract(upper(path), '[^/](\\.[^./]+)$', 1)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in T.MEDIA_TYPES.items()) + f" ELSE 'application/octet-stream' END AS media_type FROM {_PATHS} p",
    "identifier_suffix": f"""
SELECT doc_id, CASE WHEN regexp_full_match(t, '[A-Za-z0-9][A-Za-z0-9._-]{{0,159}}') THEN t WHEN regexp_matches({_CLEAN.format(v='t')}, '^[A-Za-z0-9]') THEN {_CLEAN.format(v='t')}[1:159] ELSE 'id-' || sha256(t)[1:16] END AS suffix, 'text-' || doc_id AS element_id
FROM (SELECT doc_id, coalesce(title, '-.-') AS t FROM documents) d
""",
    "run_ids": """
WITH r AS (SELECT DISTINCT run_id, request, source.content_sha256 AS s, parser.name AS n, parser.version AS v, result.started_at AS t FROM runs),
d AS (SELECT *, sha256('{"chart":' || coalesce(CAST(request.chart AS VARCHAR), 'null') || ',"layout":' || coalesce(CAST(request.layout AS VARCHAR), 'null') || ',"use_ocr":' || coalesce(CAST(request.use_ocr AS VARCHAR), 'null') || '}') AS request_sha256 FROM r)
SELECT run_id, request_sha256, 'run-' || sha256(concat_ws(':', s, n, v, t, request_sha256))[1:24] AS computed_id FROM d
""",
    "output_names": f"""
WITH n AS (SELECT *, sha1(i)[1:8] AS d, coalesce(nullif({_component('stem')}, ''), sha1(i)[1:8]) AS s, {_component('p')} AS q FROM {_IDENT} x),
m AS (SELECT *, CASE WHEN length(s) > 48 THEN rtrim(s[1:48], '_') ELSE s END || '_' || d AS name, CASE WHEN length(q) > 24 THEN rtrim(q[1:24], '_') ELSE q END || '__' || s AS ps FROM n)
SELECT source_ref, name, CASE WHEN length(ps) > 48 THEN rtrim(ps[1:48], '_') ELSE ps END || '_' || d AS prefixed, q || '/' || name AS directory FROM m
""",
    "md_image_rewrite": "SELECT document_id, text.content AS content FROM parsed_documents",
    "inventory_diff": f"""
WITH f AS {_FILES}, a AS (SELECT run_id, path, byte_size + CASE WHEN byte_size % 5 = 0 THEN 1 ELSE 0 END AS byte_size, content_sha256 FROM f WHERE byte_size % 7 <> 0 UNION ALL SELECT DISTINCT run_id, 'new.txt', 1, '' FROM f),
d AS (SELECT coalesce(f.run_id, a.run_id) AS run_id, coalesce(f.path, a.path) AS path, CASE WHEN a.path IS NULL THEN 'missing' WHEN f.path IS NULL THEN 'untracked' WHEN f.byte_size IS DISTINCT FROM a.byte_size OR f.content_sha256 IS DISTINCT FROM a.content_sha256 THEN 'changed' END AS difference
  FROM f FULL JOIN a ON f.run_id = a.run_id AND f.path = a.path)
SELECT * FROM d WHERE difference IS NOT NULL
""",
    "batch_summary": """
SELECT parser, count(*) AS runs, count(*) FILTER (WHERE status = 'skipped') AS skipped, count(*) FILTER (WHERE status = 'partial') AS partial, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'succeeded') AS succeeded,
  count(*) FILTER (WHERE status IN ('partial', 'failed')) > 0 AS has_issues FROM (SELECT DISTINCT run_id, parser.name AS parser, result.status AS status FROM runs) r GROUP BY parser
""",
    "dup_checks": "SELECT 'page' AS kind, document_id || '/' || page_number AS key, count(*) AS n FROM native_text_pages GROUP BY ALL HAVING count(*) > 1 UNION ALL SELECT 'run', run_id, count(*) FROM runs GROUP BY ALL HAVING count(*) > 1",
    "page_index_coverage": """
SELECT run_id, max(n) AS expected, list_sort(list(DISTINCT page_number)) AS actual, CASE WHEN max(n) >= 1 THEN list_filter(list_transform(range(1, max(n) + 1), lambda i: CAST(i AS INTEGER)), lambda i: NOT list_contains(list(DISTINCT page_number), i)) ELSE [] END AS missing
FROM (SELECT run_id, page_number, CASE WHEN json_valid(page_json) THEN CAST(json_extract(page_json, '$.page_count') AS INTEGER) ELSE CAST(regexp_extract(page_json, '"page_count": (\\d+)', 1) AS INTEGER) END AS n FROM run_pages) p GROUP BY run_id
""",
    "evidence_status": "SELECT run_id, CASE WHEN result.status = 'failed' THEN 'failed' WHEN coalesce(len(errors), 0) > 0 THEN 'partial' ELSE 'succeeded' END AS status FROM runs",
    "run_fields": """
SELECT DISTINCT run_id, language, coalesce(request.use_ocr, false) OR coalesce(request.chart, false) AS ocr_used, CASE WHEN lower(coalesce(language, '')) LIKE 'zh%' THEN 'ch' ELSE 'en' END AS ocr_language,
  CASE WHEN parser.backend = 'pipeline' THEN 'PDF-Extract-Kit/1.0' ELSE 'MinerU2.5-Pro/2605-1.2B' END AS engine, coalesce(CASE WHEN trim(parser.engine_name) <> '' THEN parser.engine_name END, CASE WHEN trim(parser.name) <> '' THEN parser.name END, 'unknown') AS engine_name,
  list_filter([CASE WHEN result.status = 'partial' THEN 'partial_parse' END, CASE WHEN request.use_ocr THEN 'ocr_confidence_unavailable' END, CASE WHEN result.duration_ms < 1000 THEN 'bbox_degenerate_expanded' END], lambda x: x IS NOT NULL) AS flags
FROM runs LEFT JOIN (SELECT DISTINCT document_id, text.language AS language FROM parsed_documents) p USING (document_id)
""",
    "content_items": """
WITH e AS (SELECT document_id, unnest(range(0, len(elements))) AS n, unnest(elements) AS e FROM (SELECT DISTINCT ON (document_id) * FROM parsed_documents) d),
k AS (SELECT document_id, CAST(n AS INTEGER) AS n, e.text AS t, e.artifact_ids AS c, list_transform(e.provenance, lambda x: x.parser_element_ref) AS f, CASE e.kind WHEN 'picture' THEN 'image' WHEN 'paragraph' THEN 'text' WHEN 'heading' THEN 'text' ELSE e.kind END AS kind, e.kind = 'heading' AS h FROM e),
l AS (SELECT *, CASE kind WHEN 'text' THEN CASE WHEN h AND n = 0 THEN 'doc_title' WHEN h THEN 'paragraph_title' ELSE 'text' END WHEN 'list_item' THEN 'list_item' WHEN 'table' THEN 'table' WHEN 'image' THEN 'image' WHEN 'formula' THEN 'formula'
    WHEN 'header' THEN 'header' WHEN 'footer' THEN 'footer' WHEN 'page_number' THEN 'number' ELSE 'other' END AS item_label,
  coalesce(CASE WHEN kind <> 'table' THEN nullif(t, '') END, CASE WHEN kind = 'table' THEN t END, '') AS item_text, CASE WHEN n % 2 = 0 AND trim(coalesce(t, '')) <> '' THEN t WHEN n % 2 = 0 THEN ' ' ELSE t END AS formula_text,
  CASE kind WHEN 'text' THEN 'other' WHEN 'page_number' THEN 'number' WHEN 'caption' THEN 'other' ELSE kind END AS own FROM k),
r AS (SELECT *, list_concat([{'label': own, 'caption': CAST(NULL AS VARCHAR)}], CASE WHEN kind IN ('image', 'table') THEN list_transform(list_filter(coalesce(c, []), lambda x: trim(x) <> ''), lambda x: {'label': CASE WHEN kind = 'table' THEN 'table_title' ELSE 'figure_title' END, 'caption': x}) ELSE [] END, CASE WHEN kind IN ('image', 'table') THEN list_transform(list_filter(coalesce(f, []), lambda x: trim(x) <> ''), lambda x: {'label': 'caption', 'caption': x}) ELSE [] END) AS rows FROM l)
SELECT document_id, n, item_label, item_text, formula_text, CAST(i AS INTEGER) AS row_no, row.label AS label, row.caption AS caption FROM (SELECT *, unnest(rows) AS row, unnest(range(0, len(rows))) AS i FROM r) s
""",
    "zipped_lines": """
WITH l AS (SELECT DISTINCT ON (run_id, page_number) run_id, page_number, page_json, CAST(json_array_length(page_json, '$.ocr_lines') AS BIGINT) AS n FROM run_pages WHERE json_valid(page_json))
SELECT run_id, page_number, CAST(n - 1 AS INTEGER) AS lines, CASE WHEN n > 1 THEN page_json->>('$.ocr_lines[' || (n - 2) || '].text') END AS last_text,
  CASE WHEN n > 1 THEN CAST(page_json->>('$.ocr_lines[' || (n - 2) || '].score') AS DOUBLE) END AS last_score FROM l WHERE n > 0
""",
    "text_multiset_coverage": f"SELECT * FROM {_COVERAGE} c",
    "text_route": f"""
SELECT document_id, CASE WHEN native_characters = 0 THEN 'visual_primary' WHEN parsed_characters = 0 THEN 'native_primary' WHEN round(parsed_coverage, 6) >= 0.98 AND round(native_coverage, 6) >= 0.98 THEN 'native_primary' ELSE 'unresolved' END AS decision,
  CASE WHEN native_characters = 0 THEN 'native_text_layer_empty' WHEN parsed_characters = 0 THEN 'native_text_only_nonempty_view' WHEN round(parsed_coverage, 6) >= 0.98 AND round(native_coverage, 6) >= 0.98 THEN 'cross_view_character_agreement_at_least_0_98'
    ELSE 'native_and_parsed_views_materially_disagree' END AS reason, NOT (native_characters = 0 OR parsed_characters = 0 OR (round(parsed_coverage, 6) >= 0.98 AND round(native_coverage, 6) >= 0.98)) AS requires_reconciliation FROM {_COVERAGE} c
""",
    "outcome_errors": """
WITH c AS (SELECT DISTINCT document_id, status, text.content AS t, quality.ocr.used AS u, list_transform(coalesce(errors, []), lambda e: e.code) AS e, coalesce(len(artifacts), 0) > 0 AS x FROM parsed_documents)
SELECT document_id, CASE WHEN status = 'failed' THEN CASE WHEN len(e) > 0 THEN e ELSE ['DOCUMENT_MISSING'] END WHEN trim(coalesce(t, '')) = '' THEN CASE WHEN list_contains(e, 'PARSE_TIMEOUT') THEN list_filter(e, lambda y: y = 'PARSE_TIMEOUT') WHEN len(e) > 0 THEN e
  WHEN u THEN ['OCR_EMPTY_OUTPUT'] ELSE ['OCR_REQUIRED'] END WHEN NOT x THEN list_append(e, 'OUTPUT_EXPORT_FAILED') ELSE e END AS codes FROM c
""",
    "first_errors": """
WITH c AS (SELECT DISTINCT source.source_ref AS source_ref, document_id, unnest(range(0, len(errors))) AS i, unnest(errors) AS e FROM parsed_documents),
n AS (SELECT source_ref, document_id || '/' || i AS error_no, e.code AS code, row_number() OVER (PARTITION BY source_ref ORDER BY document_id || '/' || i) AS k, count(*) OVER (PARTITION BY source_ref) AS t FROM c)
SELECT source_ref, error_no, code, greatest(t - 2, 0) AS more FROM n WHERE k <= 2
""",
}
