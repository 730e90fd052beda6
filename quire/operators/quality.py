"""Evidence and the quality gate of parsed documents, one row per document.

Every measure is a grouped aggregate or an array expression, so the gate costs one pass over the contracts. Shares
stay unrounded; thresholds compare unrounded values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions.geometry import image_dpi, scan_like


@dataclass(frozen=True)
class Policy:
    """The gate's thresholds."""

    scan_dpi: float = 150.0
    characters_per_page: float = 20.0
    ocr_confidence: float = 0.85
    replacement_share: float = 0.005
    cjk_space_share: float = 0.01
    aspect_tolerance: float = 0.05


POLICY = Policy()


def source_pages(pages: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """``pages`` (``document_id, page_number, width, height, text_characters, images, px_width, px_height``) with ``scan_like``, ``dpi`` and ``unclassified``."""
    scan = F.coalesce(
        scan_like(*[F.col(c) for c in ("text_characters", "images", "px_width", "px_height", "width", "height")], policy.aspect_tolerance), F.lit(False)
    )
    return pages.withColumn("scan_like", scan).select(
        "document_id", "page_number", "scan_like",
        F.when(F.col("scan_like"), image_dpi(*[F.col(c) for c in ("px_width", "px_height", "width", "height")])).alias("dpi"),
        ((F.col("text_characters") == 0) & ~F.col("scan_like")).alias("unclassified"),
    )


def source_summary(classified: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """Page lists and the least resolution of each source, of ``source_pages``."""
    pages = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("page_number"))))
    return classified.groupBy("document_id").agg(
        F.count("*").alias("page_count"), pages(F.col("scan_like")).alias("scan_pages"), pages(F.col("dpi") < policy.scan_dpi).alias("low_resolution_pages"),
        pages(F.col("unclassified")).alias("unclassified_pages"), F.min("dpi").alias("least_dpi"),
    )


def page_coverage(contracts: DataFrame) -> DataFrame:
    """``document_id``, the contract's pages, and those covered by any content, covered by text, and not covered."""
    has_text = lambda e: F.length(F.trim(F.coalesce(e["text"], F.lit("")))) > 0
    filled = lambda e: has_text(e) | (F.coalesce(F.size(e["artifact_ids"]), F.lit(0)) > 0)
    pages_of = lambda test: F.array_sort(F.array_distinct(F.flatten(F.transform(
        F.filter(F.coalesce("elements", F.array()), test), lambda e: F.transform(F.coalesce(e["provenance"], F.array()), lambda p: p["page_number"])))))
    numbers = F.array_sort(F.array_distinct(F.transform(F.coalesce("pages", F.array()), lambda p: p["page_number"])))
    return contracts.select("document_id", numbers.alias("page_numbers"), pages_of(filled).alias("covered_pages"), pages_of(has_text).alias("text_pages")).withColumn(
        "uncovered_pages", F.array_except("page_numbers", "covered_pages")
    )


def text_measures(texts: DataFrame) -> DataFrame:
    """``texts`` (``document_id, text, page_count``) with counts of characters, lost characters, CJK characters and blanks between them, and their shares."""
    t = F.coalesce("text", F.lit(""))
    return texts.select(
        "document_id", F.length(t).cast("bigint").alias("characters"), F.col("page_count").cast("bigint").alias("page_count"),
        T.occurrences(t, "�").alias("lost_characters"), T.cjk_characters(t).alias("cjk_characters"), T.cjk_internal_spaces(t).alias("cjk_spaces"),
    ).selectExpr(
        "*", "IF(page_count > 0, characters / page_count, 0D) AS characters_per_page", "lost_characters / greatest(characters, 1) AS lost_share", "cjk_spaces / greatest(cjk_characters, 1) AS cjk_space_share"
    )


def ocr_confidence(lines: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Per document: the mean of all line scores, and pages whose own mean is below the threshold; ``lines`` are ``document_id, page_number, score``."""
    pages = lines.where("score IS NOT NULL").groupBy("document_id", "page_number").agg(F.sum("score").alias("total"), F.count("*").alias("n"))
    return pages.groupBy("document_id").agg(
        F.sum("n").alias("line_count"), (F.sum("total") / F.sum("n")).alias("mean_confidence"),
        F.array_sort(F.collect_list(F.when(F.col("total") / F.col("n") < threshold, F.col("page_number")))).alias("low_confidence_pages"),
    )


def table_measures(cells: DataFrame, links: DataFrame) -> DataFrame:
    """Per document: tables, and empty and sparse table artifacts. ``cells`` are ``document_id, artifact_id, row_no, cell``; ``links`` tie elements to artifacts."""
    filled = F.sum(F.expr("IF(trim(coalesce(cell, '')) <> '', 1, 0)"))
    artifacts = cells.groupBy("document_id", "artifact_id").agg(F.count("cell").alias("cells"), filled.alias("filled"))
    per = links.join(artifacts, ["document_id", "artifact_id"], "left")
    blank = F.coalesce(F.col("filled"), F.lit(0)) == 0
    return per.groupBy("document_id").agg(
        F.countDistinct("element_id").alias("tables"), F.count(F.when(blank, 1)).alias("empty_tables"),
        F.count(F.when(~blank & (F.col("filled") / F.col("cells") < 0.5), 1)).alias("sparse_tables"),
    )


def codes(conditions: list[tuple[str, Column]]) -> Column:
    """The sorted codes whose condition holds; null conditions do not."""
    return F.array_sort(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in conditions]), lambda x: x.isNotNull()))


def gate(measured: DataFrame, policy: Policy = POLICY) -> DataFrame:
    """Blocking and warning codes and the decision of each document.

    ``measured`` has ``document_id, status, flags, ocr_used, ocr_mean, low_confidence_pages, page_count, uncovered, characters_per_page,
    lost_share, cjk_space_share, empty_tables, sparse_tables``, and of the source ``source_matches, readable, encrypted, source_page_count,
    scan_pages, low_resolution_pages, unclassified_pages`` (counts); unknown source evidence is null and raises nothing.
    """
    c = F.col
    failed = c("status") == "failed"
    counts_differ = c("readable") & ~failed & (c("source_page_count") != c("page_count"))
    blocking = codes([
        ("source_hash_mismatch", ~c("source_matches")), ("source_pdf_encrypted", ~c("readable") & c("encrypted")), ("source_pdf_unreadable", ~c("readable") & ~c("encrypted")),
        ("parse_failed", failed), ("partial_parse", c("status") == "partial"), ("ocr_low_confidence_pages", c("low_confidence_pages") > 0),
        ("ocr_mean_confidence_below_policy", c("ocr_mean") < policy.ocr_confidence), ("ocr_required_but_disabled", (c("scan_pages") > 0) & ~c("ocr_used") & ~failed),
        ("partial_source_contract_page_count_mismatch", counts_differ & (c("status") == "partial")), ("source_contract_page_count_mismatch", counts_differ & (c("status") != "partial")),
        ("no_pages_with_parsed_content", (c("page_count") > 0) & (c("uncovered") == c("page_count"))), ("parsed_page_coverage_incomplete", (c("uncovered") > 0) & (c("uncovered") < c("page_count"))),
        ("replacement_character_ratio_above_policy", c("lost_share") > policy.replacement_share),
    ])
    warning = codes([
        ("ocr_confidence_unavailable", F.array_contains("flags", "ocr_confidence_unavailable")), ("scan_resolution_below_policy", c("low_resolution_pages") > 0),
        ("source_pages_without_classifiable_content", c("unclassified_pages") > 0), ("text_density_below_policy", ~failed & (c("characters_per_page") < policy.characters_per_page)),
        ("cjk_internal_space_ratio_above_policy", c("cjk_space_share") > policy.cjk_space_share), ("empty_table_artifact", c("empty_tables") > 0), ("sparse_table_artifact", c("sparse_tables") > 0),
    ])
    return measured.select("document_id", blocking.alias("blocking_codes"), warning.alias("warning_codes")).select(
        "*", F.array_sort(F.array_union("blocking_codes", "warning_codes")).alias("reason_codes"),
        F.when(F.size("blocking_codes") > 0, "reject").when(F.size("warning_codes") > 0, "review").otherwise("accept").alias("decision"),
        F.when(F.size("blocking_codes") > 0, "fallback").otherwise("publish").alias("route_action"),
    )


def failure_stages(errors: Column) -> Column:
    """The distinct stages of an array of errors, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(errors, F.array()), lambda e: e["stage"]), lambda s: F.length(s) > 0)))


def report_problem(report: DataFrame) -> Column:
    """Why a gate report (``completed, assessed, decision, route_action, reason_codes, warning_codes, blocking_codes``) cannot be used; null for a sound one."""
    c = F.col
    lists = [c(x) for x in ("reason_codes", "warning_codes", "blocking_codes")]
    bad_list = F.lit(False)
    for x in lists:
        bad_list = bad_list | x.isNull() | F.exists(x, lambda s: s.isNull() | (s == ""))
    sets_differ = F.size(F.array_except(lists[0], F.array_union(lists[1], lists[2]))) + F.size(F.array_except(F.array_union(lists[1], lists[2]), lists[0])) > 0
    clash = F.arrays_overlap(lists[1], lists[2]) | ((c("route_action") == "publish") & (F.size(lists[2]) > 0)) | ((c("route_action") == "fallback") & (F.size(lists[2]) == 0))
    return (
        F.when(~c("completed"), "PARSER_RUN_FAILED").when(~c("assessed"), "QUALITY_ASSESSMENT_FAILED")
        .when(~F.coalesce(c("decision").isin("accept", "review", "reject"), F.lit(False)), "INVALID_QUALITY_DECISION")
        .when(~F.coalesce(c("route_action").isin("publish", "fallback"), F.lit(False)) | bad_list | sets_differ | clash, "INVALID_QUALITY_REPORT")
    )


def needs_fallback(primary: DataFrame) -> DataFrame:
    """Documents whose primary result is not published: the work list of the second parser."""
    return primary.where("failure_code IS NOT NULL OR route_action <> 'publish'").select("document_id")


def route(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """``document_id, outcome, selected``: the primary result if published, else the fallback's, else none. Both are ``document_id, route_action, failure_code``."""
    good = lambda side: F.col(f"{side}.failure_code").isNull() & (F.col(f"{side}.route_action") == "publish")
    joined = primary.alias("p").join(fallback.alias("f"), "document_id", "left")
    first, second = F.coalesce(good("p"), F.lit(False)), F.coalesce(good("f"), F.lit(False))
    return joined.select(
        "document_id", F.when(first, "selected_primary").when(second, "selected_fallback").otherwise("degraded").alias("outcome"),
        F.when(first, "primary").when(second, "fallback").alias("selected"),
    )


def routing_payload(routed: DataFrame, root: str = "") -> DataFrame:
    """``routed`` (``document_id, outcome, selected``) with the selected contract's path inside its package, null where nothing is selected."""
    path = F.concat(F.lit(root), F.col("document_id"), F.lit("/"), F.col("selected"), F.lit("/parsed-document.json"))
    return routed.withColumn("payload", F.struct(F.lit(2).alias("routing_version"), F.col("outcome"), F.col("selected"), F.when(F.col("selected").isNotNull(), path).alias("contract_path")))
