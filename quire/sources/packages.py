"""Files as sources: documents, run packages, and parsers as plug-ins.

Directories are listed by Spark, so files are read where the tasks run. No parser is part of this library: one is any object
with ``parse(name, content, options)``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T


def documents(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """``path, name, byte_size, content_sha256, content`` of all PDF files; names that start with ``~$`` are left out, case does not matter."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), F.col("length").alias("byte_size"), F.sha2("content", 256).alias("content_sha256"), "content").where(~F.col("name").startswith("~$"))


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """``path, byte_size, content_sha256`` of every file below a folder, paths relative to it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    base = folder.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    return files.select(F.substring_index("path", base, -1).alias("path"), F.col("length").alias("byte_size"), F.sha2("content", 256).alias("content_sha256"))


RUN_SCHEMA = (
    "output_state_version INT, source STRUCT<content_sha256: STRING, byte_size: BIGINT>, "
    "parser STRUCT<name: STRING, version: STRING, engine_name: STRING, engine_version: STRING, backend: STRING, source_sha256: STRING>, "
    "request STRING, result STRUCT<status: STRING, started_at: STRING, completed_at: STRING, duration_ms: BIGINT>, "
    "output_files ARRAY<STRUCT<path: STRING, byte_size: BIGINT, content_sha256: STRING>>, "
    "errors ARRAY<STRUCT<code: STRING, stage: STRING, sanitized_message: STRING, retryable: BOOLEAN, page_number: INT>>, _unreadable STRING"
)


def run_records(spark: SparkSession, pattern: str) -> DataFrame:
    """``path, run``: one record per ``run.json``; an unreadable one, or one that is no object, is null."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "run.json").load(pattern)
    parsed = F.from_json(F.decode("content", "UTF-8"), RUN_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unreadable"})
    return files.select("path", parsed.alias("run")).select("path", F.when(F.col("run._unreadable").isNull(), F.col("run")).alias("run"))


@dataclass(frozen=True)
class ParserOptions:
    """Defaults of a parser run."""

    timeout_seconds: float = 300.0
    ocr_batch: int = 8
    layout_batch: int = 8
    use_ocr: bool = False
    write_json: bool = True
    write_tables: bool = True
    export_images: bool = True
    images_scale: float = 3.0

    @classmethod
    def slim(cls) -> ParserOptions:
        return cls(write_json=False, write_tables=False, export_images=False, images_scale=1.0)


@dataclass
class Attempt:
    """What one backend made of a document: page records, and where it has them the native text and the image of each page."""

    status: str
    pages: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)
    images: list[bytes | None] = field(default_factory=list)
    page_count: int | None = None


class Parser(Protocol):
    """A parser backend; created once per task, used for all its documents.

    ``parse`` returns the attempt, or yields page records one after another; those that came before a failure are kept as a partial result.
    """

    def parse(self, name: str, content: bytes, options: ParserOptions) -> Attempt | Iterator[str]: ...


ATTEMPTS = (
    "path STRING, attempt_no INT, backend STRING, status STRING, pages ARRAY<STRING>, texts ARRAY<STRING>, images ARRAY<BINARY>, page_count INT, "
    "errors ARRAY<STRUCT<code: STRING, message: STRING>>"
)
_RAW = "path STRING, attempt_no INT, backend STRING, status STRING, pages ARRAY<STRING>, texts ARRAY<STRING>, images ARRAY<BINARY>, page_count INT, messages ARRAY<STRING>"


def _attempt(parser: Parser, name: str, content: bytes, options: ParserOptions) -> Attempt:
    pages: list[str] = []
    try:
        made = parser.parse(name, content, options)
        if not isinstance(made, Attempt):
            for page in made:
                pages.append(page)
            made = Attempt("succeeded", pages)
    except Exception as e:  # noqa: BLE001 - any failure of a plug-in belongs to its document
        return Attempt("partial" if pages else "failed", pages, [str(e) or type(e).__name__])
    if made.status != "failed" and made.page_count is not None and made.page_count < 1:
        return Attempt("failed", errors=[f"the source has {made.page_count} pages"])
    return made


def parse(files: DataFrame, backends: list[tuple[str, Any]], options: ParserOptions = ParserOptions()) -> DataFrame:
    """Attempts (``ATTEMPTS``) of the backends, ``(name, factory)``, in order until one succeeds. A failure, even a raised one, stays with its document.

    Messages are made safe before they leave the task; ``contract.best_attempt`` picks the result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = [(name, factory()) for name, factory in backends]
        for batch in batches:
            rows = []
            for path, name, content in zip(batch["path"], batch["name"], batch["content"]):
                for no, (backend, parser) in enumerate(made, 1):
                    a = _attempt(parser, name, bytes(content), options)
                    rows.append((path, no, backend, a.status, a.pages, a.texts, a.images, a.page_count, [f"{backend}: {m}" for m in a.errors]))
                    if a.status == "succeeded":
                        break
            out = pd.DataFrame(rows, columns=[x.split()[0] for x in _RAW.split(", ")])
            yield out.astype({"page_count": "Int32"})

    raw = files.select("path", "name", "content").mapInPandas(run, _RAW)
    name = F.element_at(F.split("path", "/"), -1)
    made_safe = F.transform("messages", lambda m: F.struct(T.error_code(m).alias("code"), T.safe_message(m, F.col("path"), name).alias("message")))
    return raw.withColumn("errors", made_safe).drop("messages")


def native_texts(attempts: DataFrame) -> DataFrame:
    """``path, page_number, text, text_sha256``: the native text of each page that has one."""
    return attempts.select("path", F.posexplode("texts").alias("n", "text")).where("text IS NOT NULL").select("path", (F.col("n") + 1).alias("page_number"), "text", F.sha2("text", 256).alias("text_sha256"))


def page_images(attempts: DataFrame, scale: float = 2.0) -> DataFrame:
    """``path, page_number, image, byte_size, content_sha256, scale`` of each page that has an image, rendered at ``scale``, above 0 and 4 at most."""
    if not 0 < scale <= 4:
        raise ValueError("the scale must be above 0 and 4 at most")
    return attempts.select("path", F.posexplode("images").alias("n", "image")).where("image IS NOT NULL").select(
        "path", (F.col("n") + 1).alias("page_number"), "image", F.length("image").alias("byte_size"), F.sha2("image", 256).alias("content_sha256"), F.lit(scale).alias("scale"))


def json_files(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """``path, text, problem`` of JSON files, read strictly: ``unreadable`` is what is no UTF-8 or no JSON, ``no_object`` any other value than an object; null where sound."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    tree = F.try_parse_json("text")
    return files.select("path", F.when(F.expr("is_valid_utf8(CAST(content AS STRING))"), F.col("content").cast("string")).alias("text")).withColumn(
        "problem", F.when(tree.isNull(), "unreadable").when(~F.schema_of_variant(tree).startswith("OBJECT"), "no_object"))


# Files of a content package.
MIDDLE, CONTENT = "_middle.json", "content_list.json"
_MIDDLE_FIELDS = "pdf_info ARRAY<STRUCT<page_idx: INT, page_size: ARRAY<DOUBLE>>>"
_ITEM_FIELDS = (
    "ARRAY<STRUCT<type: STRING, text: STRING, text_level: INT, page_idx: INT, bbox: ARRAY<DOUBLE>, img_path: STRING, table_body: STRING, image_caption: ARRAY<STRING>, image_footnote: ARRAY<STRING>, "
    "table_caption: ARRAY<STRING>, table_footnote: ARRAY<STRING>>>"
)


def content_packages(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages, items and problems of content packages, a folder each: exactly one page file, a content list, and page numbers that are its own.

    Pages are ``package, page_index, width, height``; items are ``package, item_no`` and the item's fields; problems are ``package, problem``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(folder)
    files = files.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("package"), "path", F.col("content").cast("string").alias("text"))
    middle = files.where(F.col("path").endswith(MIDDLE)).select("package", F.from_json("text", _MIDDLE_FIELDS).alias("m"))
    listed = files.where(F.col("path").endswith(CONTENT)).select("package", F.from_json("text", _ITEM_FIELDS).alias("items"))
    pages = middle.select("package", F.explode("m.pdf_info").alias("p")).select(
        "package", F.col("p.page_idx").alias("page_index"), F.get("p.page_size", F.lit(0)).alias("width"), F.get("p.page_size", F.lit(1)).alias("height"))
    items = listed.select("package", F.posexplode("items").alias("item_no", "i")).select("package", (F.col("item_no") + 1).alias("item_no"), "i.*")
    count = middle.groupBy("package").count()
    packages = files.select("package").distinct()
    flagged = lambda rows, problem: rows.select("package", F.lit(problem).alias("problem"))
    problems = (
        flagged(packages.join(count, "package", "left").where("coalesce(count, 0) <> 1"), "page_files")
        .unionByName(flagged(packages.join(listed, "package", "left_anti"), "no_content_list"))
        .unionByName(flagged(pages.groupBy("package", "page_index").count().where("count > 1 OR page_index IS NULL"), "page_index"))
        .unionByName(flagged(pages.where("NOT coalesce(width > 0 AND height > 0, false)"), "page_size"))
        .unionByName(flagged(items.where("page_idx IS NOT NULL").join(pages, (items.package == pages.package) & (F.col("page_idx") == F.col("page_index")), "left_anti"), "unknown_page"))
        .distinct()
    )
    return pages, items, problems
