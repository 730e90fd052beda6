"""Text, path, identifier and hash functions as column expressions.

A null argument gives a null result unless a docstring says otherwise.
"""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

# Character ranges and patterns that results depend on.
CJK = r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"
CJK_CHARACTER = f"[{CJK}]"
CJK_SPACE = rf"(?<=[{CJK}])[ \t]+(?=[{CJK}])"
CJK_SPACE_IN_EVIDENCE = r"(?<=[\x{3400}-\x{9FFF}]) +(?=[\x{3400}-\x{9FFF}])"
ABSOLUTE_PATH = r"(?:(?<![A-Za-z0-9])[A-Za-z]:[\\/]|\\\\[^\\\s]+[\\/]|(?<![A-Za-z0-9:/])/(?:Users|Volumes|home|private|tmp|var|mnt)/)"
ABSOLUTE_PATH_WHOLE = (
    r"(?:(?<![A-Za-z0-9])[A-Za-z]:[\\/][^\s,;:()]+|\\\\[^\\\s]+[\\/][^\s,;:()]+|(?<![A-Za-z0-9:/])/(?:Users|Volumes|home|private|tmp|var|mnt)/[^\s,;:()]+)"
)
IDENTIFIER = r"^[A-Za-z0-9][A-Za-z0-9._-]{0,159}$"
DIGEST = r"^[a-f0-9]{64}$"
ERROR_CODE = r"^[A-Z][A-Z0-9_]*$"
ERROR_STAGES = ("input", "download", "parse", "ocr", "layout", "export", "unknown")
RUN_STATUSES = ("succeeded", "partial", "failed")
MEDIA_TYPES = {".csv": "text/csv", ".json": "application/json", ".md": "text/markdown", ".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".webp": "image/webp"}
OTHER_MEDIA_TYPE = "application/octet-stream"
NO_DETAIL = "No safe diagnostic detail was available"
TRACEBACK = "Traceback (most recent call last)"


def cjk_characters(text: Column) -> Column:
    return F.regexp_count(text, F.lit(CJK_CHARACTER)).cast("bigint")


def cjk_internal_spaces(text: Column, pattern: str = CJK_SPACE) -> Column:
    """Runs of blanks between two CJK characters."""
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def occurrences(text: Column, needle: str) -> Column:
    """How often one character occurs."""
    return (F.length(text) - F.length(F.replace(text, F.lit(needle)))).cast("bigint")


def line_count(text: Column) -> Column:
    """Lines of a text with any line ending; an ending at the very end opens no line."""
    ends = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
    open_ended = F.when(text == "", 0).when(text.rlike(f"(?:{ends})$") & text.rlike(rf"(?s)[\n\r\x0b\x0c\x1c\x1d\x1e\x{{85}}\x{{2028}}\x{{2029}}]\z"), 0).otherwise(1)
    return (F.regexp_count(text, F.lit(ends)) + open_ended).cast("bigint")


@F.pandas_udf(StringType())
def compact_text(texts: pd.Series) -> pd.Series:
    """The NFKC form without white space; Spark has no expression for it."""
    return texts.map(lambda t: None if t is None else "".join(unicodedata.normalize("NFKC", t).split()))


@F.pandas_udf(DoubleType())
def order_similarity(parsed: pd.Series, native: pd.Series) -> pd.Series:
    """The matching-blocks ratio of two texts, in this order, rounded to six places."""
    return pd.Series(
        [None if a is None or b is None else round(difflib.SequenceMatcher(None, a, b).ratio(), 6) for a, b in zip(parsed, native)], dtype="float64"
    )


def python_round(places: int):
    """Rounding to the nearest, by the exact binary value; neither of Spark's roundings gives it."""

    @F.pandas_udf(DoubleType())
    def rounded(values: pd.Series) -> pd.Series:
        return values.map(lambda x: x if pd.isna(x) else round(x, places)).astype("float64")

    return rounded


def has_absolute_path(text: Column) -> Column:
    return text.rlike(ABSOLUTE_PATH)


def safe_message(message: Column, *source_forms: Column) -> Column:
    """A diagnostic without tracebacks, paths, control characters and names of its source, of 500 characters at most.

    ``source_forms`` are replaced in the order given: pass the longest first. A blank rest becomes a default text.
    """
    text = F.substring_index(message, TRACEBACK, 1)
    for form in source_forms:
        text = F.when(F.length(form) > 0, F.replace(text, form, F.lit("[source]"))).otherwise(text)
    text = F.regexp_replace(text, ABSOLUTE_PATH_WHOLE, "[path]")
    text = F.regexp_replace(text, r"[\x00-\x1f\x7f]+", " ")
    text = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.substring(F.coalesce(F.nullif(text, F.lit("")), F.lit(NO_DETAIL)), 1, 500)


def _any_of(text: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(text, F.lit(w))
    return found


def error_code(message: Column) -> Column:
    """The code of a parser's message; passwords come before timeouts, these before exhausted resources."""
    low = F.lower(message)
    return (
        F.when(_any_of(low, ("password", "encrypted", "encryption")), "PDF_ENCRYPTED")
        .when(_any_of(low, ("timeout", "timed out")), "PARSE_TIMEOUT")
        .when(_any_of(low, ("out of memory", "resource exhausted")), "RESOURCE_EXHAUSTED")
        .otherwise("PDF_PARSE_FAILED")
    )


def is_retryable(code: Column) -> Column:
    return code.isin("PARSE_TIMEOUT", "RESOURCE_EXHAUSTED")


def safe_relative_path(path: Column) -> Column:
    """Whether a path is relative, does not climb, and has neither backslash nor colon."""
    return F.coalesce(
        (F.length(path) > 0) & ~path.startswith("/") & ~F.contains(path, F.lit("\\")) & ~F.contains(path, F.lit(":")) & ~F.array_contains(F.split(path, "/"), ".."),
        F.lit(False),
    )


def relative_path_without_climbing(path: Column) -> Column:
    """The weaker rule: relative, without ``..``."""
    return F.coalesce(~path.startswith("/") & ~F.array_contains(F.split(path, "/"), ".."), F.lit(False))


def media_type(path: Column) -> Column:
    """The media type by the suffix, in any case."""
    suffix = F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))
    known = F.create_map(*[F.lit(x) for pair in MEDIA_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, suffix), F.lit(OTHER_MEDIA_TYPE))


def identifier_suffix(value: Column) -> Column:
    """A value as part of an identifier: kept if it is one, else cleaned, else a digest of it."""
    cleaned = F.regexp_replace(F.regexp_replace(value, r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")
    usable = F.when(cleaned.rlike(r"^[A-Za-z0-9]"), cleaned).otherwise(F.concat(F.lit("id-"), F.substring(F.sha2(value, 256), 1, 16)))
    return F.when(value.rlike(IDENTIFIER), value).otherwise(F.substring(usable, 1, 159))


def block_element_id(page_number: Column, block_id: Column, block_order: Column) -> Column:
    """The element id of a block; a block without id goes by its order, else is unknown."""
    suffix = F.coalesce(identifier_suffix(block_id), block_order.cast("string"), F.lit("unknown"))
    return F.concat(F.lit("block-"), page_number.cast("string"), F.lit("-"), suffix)


def collection_element_id(collection: Column, index: Column) -> Column:
    """``texts`` and 3 give ``text-3``."""
    return F.concat(F.regexp_replace(collection, "s$", ""), F.lit("-"), index.cast("string"))


def run_id(*parts: Column) -> Column:
    """An id from the digest of its parts, joined by colons."""
    return F.concat(F.lit("run-"), F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 24))


def canonical_digest(record: Column) -> Column:
    """The digest of a struct as compact JSON; name its fields in alphabetical order."""
    return F.sha2(F.to_json(record, {"ignoreNullFields": "false"}), 256)


def path_component(name: Column, longest: int | None = None) -> Column:
    """A name as a safe directory name."""
    t = F.regexp_replace(F.trim(name), r"[.\- ]+$", "")
    t = F.regexp_replace(t, r'[<>:"/\\|?*\[\]]', "_")
    t = F.regexp_replace(F.regexp_replace(t, r"(?U)\s+", "_"), "_+", "_")
    t = F.regexp_replace(t, "^_+|_+$", "")
    if longest is None:
        return t
    return F.when(F.length(t) > longest, F.regexp_replace(F.substring(t, 1, longest), "_+$", "")).otherwise(t)


def output_name(identity: Column, with_parent: bool = False, longest: int = 48) -> Column:
    """A short directory name that is unique for a relative path: its cleaned stem and eight digits of its digest."""
    digest = F.substring(F.sha1(identity), 1, 8)
    name = F.regexp_extract(identity, r"([^/]*)$", 1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")
    stem = F.coalesce(F.nullif(path_component(stem), F.lit("")), digest)
    if with_parent:
        parent = path_component(F.regexp_extract(identity, r"([^/]*)/[^/]*$", 1), 24)
        stem = F.when(F.length(parent) > 0, F.concat(parent, F.lit("__"), stem)).otherwise(stem)
    stem = F.when(F.length(stem) > longest, F.regexp_replace(F.substring(stem, 1, longest), "_+$", "")).otherwise(stem)
    return F.concat(stem, F.lit("_"), digest)


def output_directory(identity: Column) -> Column:
    """The cleaned parent directories of a relative path and its output name."""
    parents = F.filter(
        F.transform(F.split(F.regexp_extract(identity, r"^(.*)/[^/]*$", 1), "/"), lambda p: path_component(p)), lambda x: F.length(x) > 0
    )
    return F.array_join(F.concat(parents, F.array(output_name(identity))), "/")


def markdown_images_relative(markdown: Column, folder: str = "artifacts") -> Column:
    """Image references of a markdown text pointed to ``folder``, whatever path they had."""
    return F.regexp_replace(markdown, r"!\[([^\]]*)\]\((?:[^)]*[/\\])?([^)/\\]+)\)", f"![$1]({folder}/$2)")


def replace_by_map(text: Column, replacements: Column) -> Column:
    """Plain replacements, one after the other, by an array of ``(old, new)`` structs; the empty string is never replaced."""
    return F.aggregate(
        replacements, text, lambda t, r: F.when(F.length(r["old"]) > 0, F.replace(t, r["old"], r["new"])).otherwise(t)
    )


def utc_text(time: Column) -> Column:
    """A timestamp as text in UTC, in seconds, with ``Z``; the session must be in UTC."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def elapsed_ms(start: Column, end: Column) -> Column:
    """Milliseconds between two texts of a time, with ``Z`` or an offset."""
    return F.unix_millis(F.try_to_timestamp(end)) - F.unix_millis(F.try_to_timestamp(start))
