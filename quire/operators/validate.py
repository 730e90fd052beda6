"""Violations of records as sorted code lists; ``strict`` raises instead.

The order of a document's codes is that of the rules, so the first is the one a reader that stops at once would report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

CONTRACT_VERSION = "1.0"
EVIDENCE_VERSION = "1.0"


def violations(rules: list[tuple[str, Column]]) -> Column:
    """Codes of the rules that are broken, in their order; an unknown outcome breaks a rule."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in rules]), lambda x: x.isNotNull())


def filled(c: Column) -> Column:
    return F.length(F.trim(c)) > 0


def contract(contracts: DataFrame) -> DataFrame:
    """``document_id, violations`` of contracts."""
    c = F.col
    numbers = F.transform(F.coalesce("pages", F.array()), lambda p: p["page_number"])
    failed = c("status") == "failed"
    rules = [
        ("contract_version", c("contract_version") == CONTRACT_VERSION), ("document_id", c("document_id").rlike(T.IDENTIFIER)), ("source_ref", c("source.source_ref").rlike(T.IDENTIFIER)),
        ("source_sha256", c("source.content_sha256").rlike(T.DIGEST)), ("media_type", filled(c("source.media_type"))),
        ("parser", filled(c("parser_run.parser_name")) & filled(c("parser_run.parser_version"))), ("engine", filled(c("parser_run.engine_name")) & filled(c("parser_run.engine_version"))),
        ("status", c("status").isin(*T.RUN_STATUSES)), ("page_number", F.forall(numbers, lambda n: n >= 1)), ("duplicate_page", F.size(F.array_distinct(numbers)) == F.size(numbers)),
        ("text_content", c("text").isNull() | filled(c("text.content"))), ("text_sha256", c("text").isNull() | (F.sha2(c("text.content"), 256) == c("text.content_sha256"))),
        ("text_language", c("text").isNull() | filled(c("text.language"))),
        ("artifact_path", F.forall(F.coalesce("artifacts", F.array()), lambda a: T.safe_relative_path(a["path"]))),
        ("artifact_sha256", F.forall(F.coalesce("artifacts", F.array()), lambda a: F.coalesce(a["content_sha256"].rlike(T.DIGEST), F.lit(False)))),
        ("failed_with_content", ~failed | (c("text").isNull() & (F.size(numbers) == 0))), ("missing_content", failed | (c("text").isNotNull() & (F.size(numbers) > 0))),
    ]
    return contracts.select("document_id", violations(rules).alias("violations"))


def run(runs: DataFrame) -> DataFrame:
    """``run_id, violations`` of run records: version, inventory and errors."""
    c = F.col
    files = F.coalesce("output_files", F.array())
    errors = F.coalesce("errors", F.array())
    status = c("result.status")
    safe_message = lambda e: filled(e["sanitized_message"]) & ~e["sanitized_message"].rlike(T.ABSOLUTE_PATH) & ~F.contains(e["sanitized_message"], F.lit(T.TRACEBACK))
    rules = [
        ("state_version", c("output_state_version") == 1), ("status", status.isin(*T.RUN_STATUSES)), ("empty_inventory", (status == "failed") | (F.size(files) > 0)),
        ("inventory_path", F.forall(files, lambda f: T.safe_relative_path(f["path"]))), ("duplicate_path", F.size(F.array_distinct(F.transform(files, lambda f: f["path"]))) == F.size(files)),
        ("inventory_size", F.forall(files, lambda f: f["byte_size"] >= 0)), ("inventory_sha256", F.forall(files, lambda f: f["content_sha256"].rlike(T.DIGEST))),
        ("errors_of_success", (status != "succeeded") | (F.size(errors) == 0)), ("no_errors_of_failure", (status == "succeeded") | (F.size(errors) > 0)),
        ("error_code", F.forall(errors, lambda e: e["code"].rlike(T.ERROR_CODE))), ("error_stage", F.forall(errors, lambda e: e["stage"].isin(*T.ERROR_STAGES))),
        ("error_message", F.forall(errors, safe_message)), ("error_retryable", F.forall(errors, lambda e: e["retryable"].isNotNull())),
        ("error_page", F.forall(errors, lambda e: e["page_number"].isNull() | (e["page_number"] >= 1))),
    ]
    return runs.select("run_id", violations(rules).alias("violations"))


def native_text(pages: DataFrame) -> DataFrame:
    """``document_id, page_number, n, violations`` per page key: version, number, digest, and rows that repeat a key."""
    c = F.col
    rules = [
        ("evidence_version", c("evidence_version") == EVIDENCE_VERSION), ("page_number", c("page_number") >= 1), ("source_sha256", c("source_sha256").rlike(T.DIGEST)),
        ("text_sha256", c("text").isNull() | (F.sha2("text", 256) == c("text_sha256"))),
    ]
    return (
        pages.select("document_id", "page_number", violations(rules).alias("v"))
        .groupBy("document_id", "page_number")
        .agg(F.count("*").alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("v")))).alias("found"))
        .select("document_id", "page_number", "n", F.when(F.col("n") > 1, F.concat("found", F.array(F.lit("duplicate_page")))).otherwise(F.col("found")).alias("violations"))
    )


def label(labels: DataFrame) -> DataFrame:
    """Label evidence (columns of ``labels.extract`` and ``labels.boxes``) with ``violations``."""
    c = F.col
    near = lambda a, b: F.abs(a - b) <= 1e-9
    rules = [
        ("object_type", c("object_type").isin("table", "figure")), ("label_number", c("label_number") >= 1),
        ("label_form", (c("object_type") == "figure") | c("label_form").isin("punctuated", "continued", "bare")),
        ("in_page", c("x").between(0, c("page_width")) & c("y").between(0, c("page_height"))),
        ("normalized", near(c("x_normalized"), c("x") / c("page_width")) & near(c("y_normalized"), (c("page_height") - c("y")) / c("page_height"))),
        ("box", (c("x0") >= 0) & (c("x0") < c("x1")) & (c("x1") <= 1) & (c("y0") >= 0) & (c("y0") < c("y1")) & (c("y1") <= 1)),
    ]
    return labels.withColumn("violations", violations(rules))


def page_images(images: DataFrame) -> DataFrame:
    """``document_id, page_number, violations`` of page image rows (``image_path, image_sha256, actual_sha256, width_pixels, height_pixels, width_points, height_points``)."""
    c = F.col
    rules = [
        ("page_number", c("page_number") >= 1), ("image_path", T.relative_path_without_climbing(c("image_path"))), ("image_sha256", c("image_sha256") == c("actual_sha256")),
        ("pixels", (c("width_pixels") > 0) & (c("height_pixels") > 0)), ("points", (c("width_points") > 0) & (c("height_points") > 0)),
    ]
    return images.select("document_id", "page_number", violations(rules).alias("violations"))


def confidence(score: Column) -> Column:
    """Whether a score is a finite number from 0 to 1."""
    return F.coalesce(score.between(0, 1) & ~F.isnan(score), F.lit(False))


def export_counts(native: DataFrame, exported: DataFrame, statuses: DataFrame) -> DataFrame:
    """Per document and collection whether native and exported counts agree: ``ok``, else ``drop`` in a partial run, else ``error``.

    ``native`` and ``exported`` are ``run_id, collection, n``; ``statuses`` are ``run_id, status``.
    """
    both = native.withColumnRenamed("n", "native").join(exported.withColumnRenamed("n", "exported"), ["run_id", "collection"], "full_outer").join(statuses, "run_id")
    same = F.coalesce("native", F.lit(0)) == F.coalesce("exported", F.lit(0))
    return both.select("run_id", "collection", F.when(same, "ok").when(F.col("status") == "partial", "drop").otherwise("error").alias("action"))


def usable_pages(pages: DataFrame) -> DataFrame:
    """``pages`` (``status, page_number, width, height``) with ``action``: placeholders are dropped in partial runs, errors elsewhere."""
    bad = ~F.coalesce((F.col("page_number") >= 1) & (F.col("width") > 0) & (F.col("height") > 0), F.lit(False))
    return pages.withColumn("action", F.when(~bad, "keep").when(F.col("status") == "partial", "drop").otherwise("error"))


def page_payloads(pages: DataFrame, run: str = "run_id") -> DataFrame:
    """``run_id, pages, violations``: whether the page records of a run fit their pages.

    ``pages`` are ``run_id, page_number, width, height, page`` (a parsed record, null if unreadable): each record's index is its page number less one, sizes
    are equal, and the page count is the same throughout, at least 1, and no less than the number of pages and the highest page number.
    """
    c = F.col
    readable = c("page").isNotNull()
    rows = pages.select(run, "page_number", "page", readable.alias("readable"), ((c("page.page_index") + 1) == c("page_number")).alias("index_ok"),
                        (c("page.width").eqNullSafe(c("width")) & c("page.height").eqNullSafe(c("height"))).alias("size_ok"), c("page.page_count").alias("page_count"))
    grouped = rows.groupBy(run).agg(
        F.count("*").alias("pages"), F.min("readable").alias("readable"), F.min(F.coalesce("index_ok", ~c("readable"))).alias("index_ok"), F.min(F.coalesce(c("size_ok"), F.lit(True)) | ~c("readable")).alias("size_ok"),
        F.countDistinct("page_number").alias("numbers"), F.max("page_number").alias("highest"), F.min("page_count").alias("least"), F.max("page_count").alias("most"),
    )
    rules = [
        ("unreadable_page", c("readable")), ("page_index", c("index_ok")), ("page_size", c("size_ok")), ("duplicate_page", c("numbers") == c("pages")), ("page_count_varies", c("least") == c("most")),
        ("page_count_too_low", (c("most") >= 1) & (c("most") >= c("numbers")) & (c("most") >= c("highest"))),
    ]
    return grouped.select(run, "pages", violations(rules).alias("violations"))


def full_request(status: Column, write_json: Column, write_tables: Column, export_images: Column) -> Column:
    """Whether a run asked for all outputs, which a failed one need not."""
    return (status == "failed") | F.coalesce(write_json & write_tables & export_images, F.lit(False))


def identity(rows: DataFrame) -> DataFrame:
    """``rows`` (``document_id, source_ref, language``) with ``violations`` of the names a contract is made for."""
    c = F.col
    rules = [("document_id", c("document_id").rlike(T.IDENTIFIER)), ("source_ref", c("source_ref").rlike(T.IDENTIFIER)), ("language", F.length(F.trim("language")) >= 2)]
    return rows.withColumn("violations", violations(rules))


class ViolationError(ValueError):
    """A strict check found a violation."""


def strict(checked: DataFrame, key: str) -> DataFrame:
    """``checked`` itself, unless a row has violations: then the first one by key is raised."""
    bad = checked.where(F.size("violations") > 0).orderBy(key).limit(1).collect()
    if bad:
        raise ViolationError(f"{bad[0][key]}: {bad[0]['violations'][0]}")
    return checked
