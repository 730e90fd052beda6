"""Work lists and summaries of parser runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE_VERSION = 1


def inventory_agrees(recorded: DataFrame, actual: DataFrame) -> DataFrame:
    """``run_id, agrees``: whether every recorded file exists with its size and digest; a run without records does not agree.

    Both are ``run_id, path, byte_size, content_sha256``; further actual files do no harm.
    """
    now = actual.select("run_id", "path", F.col("byte_size").alias("size_now"), F.col("content_sha256").alias("digest_now"))
    same = F.col("byte_size").eqNullSafe(F.col("size_now")) & F.col("content_sha256").eqNullSafe(F.col("digest_now"))
    return recorded.join(now, ["run_id", "path"], "left").groupBy("run_id").agg(F.min(same).alias("agrees"))


def can_skip(runs: DataFrame, wanted: DataFrame, agreeing: DataFrame) -> DataFrame:
    """``document_id, skip``: whether an earlier run has already done the wanted work.

    ``wanted`` is ``document_id, content_sha256, byte_size, parser_sha256, request``; a run must have succeeded for the same content, size, parser and
    request in the current state version, with a filled text file and an agreeing inventory.
    """
    done = runs.join(agreeing.where("agrees"), "run_id", "left_semi").select(
        "document_id", F.col("source.content_sha256").alias("r_sha"), F.col("source.byte_size").alias("r_size"), F.col("parser.source_sha256").alias("r_parser"), F.col("request").alias("r_request"),
        ((F.col("output_state_version") == STATE_VERSION) & (F.col("result.status") == "succeeded")
         & F.exists(F.coalesce("output_files", F.array()), lambda f: (f["path"] == "content.md") & (f["byte_size"] > 0))).alias("usable"),
    )
    same = (
        F.col("usable") & F.col("content_sha256").eqNullSafe(F.col("r_sha")) & F.col("byte_size").eqNullSafe(F.col("r_size"))
        & F.col("parser_sha256").eqNullSafe(F.col("r_parser")) & F.col("request").eqNullSafe(F.col("r_request"))
    )
    return wanted.join(done, "document_id", "left").groupBy("document_id").agg(F.max(F.coalesce(same, F.lit(False))).alias("skip"))


def work_list(wanted: DataFrame, skippable: DataFrame) -> DataFrame:
    """Wanted documents that no run has done yet."""
    return wanted.join(skippable.where("skip"), "document_id", "left_anti")


def outcome_errors(has_document: Column, text: Column, used_ocr: Column, errors: Column, exported: Column) -> Column:
    """The error codes of a parse: of an empty text the timeouts, else the parser's own, else that OCR was empty or is required; then missing documents and failed exports."""
    empty = F.length(F.trim(F.coalesce(text, F.lit("")))) == 0
    timeouts = F.filter(errors, lambda e: e == "PARSE_TIMEOUT")
    fallback = F.array(F.when(used_ocr, "OCR_EMPTY_OUTPUT").otherwise("OCR_REQUIRED"))
    own = F.coalesce(errors, F.array().cast("array<string>"))
    return (
        F.when(~has_document, F.when(F.size(own) > 0, own).otherwise(F.array(F.lit("DOCUMENT_MISSING"))))
        .when(empty, F.when(F.size(timeouts) > 0, timeouts).when(F.size(own) > 0, own).otherwise(fallback))
        .when(~exported, F.concat(own, F.array(F.lit("OUTPUT_EXPORT_FAILED")))).otherwise(own)
    )


def batch_summary(outcomes: DataFrame, *by: str) -> DataFrame:
    """Numbers of runs, skipped, partial, failed and fully successful ones, and whether there are issues."""
    n = lambda status: F.count(F.when(F.col("status") == status, 1))
    return outcomes.groupBy(*by).agg(
        F.count("*").alias("runs"), n("skipped").alias("skipped"), n("partial").alias("partial"), n("failed").alias("failed"), n("succeeded").alias("succeeded")
    ).withColumn("has_issues", (F.col("partial") > 0) | (F.col("failed") > 0))


def page_gaps(pages: DataFrame) -> DataFrame:
    """``run_id, expected, actual, missing``: page numbers against 1..``page_count``; ``pages`` are ``run_id, page_count, page_number``."""
    seen = F.array_sort(F.collect_set("page_number"))
    return pages.groupBy("run_id").agg(F.max("page_count").alias("expected"), seen.alias("actual")).withColumn(
        "missing", F.when(F.col("expected") >= 1, F.array_except(F.transform(F.sequence(F.lit(1), F.greatest("expected", F.lit(1))), lambda i: i.cast("int")), "actual")).otherwise(F.array().cast("array<int>"))
    )
