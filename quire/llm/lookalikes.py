"""One consistent form for text that looks the same in different characters.

Widths, ligatures, radicals, compatibility ideographs, kinds of blank and of hyphen, and invisible marks are folded
by a character table, accents are composed. Letters that look alike across scripts are resolved by token: every
letter (Latin, Cyrillic, Greek, Armenian, Cherokee, Lisu, Coptic) stands for the set of scripts in which a letter of that look exists, the sets are intersected over the token, and the token
is spelled in the script that is left. A token that several scripts could spell (a whole-script
confusable) takes the script of its neighbours, which are resolved the same way, so texts that look alike get
the same spelling. A token that no script can spell keeps its own letters where only one script has them and
takes Latin elsewhere.

Defined results: a null text stays null, an empty one empty; accents, case, digits, raised digits, signs, the number of blanks
and line breaks are kept as they are. In ``alike_pairs`` null and empty records, and those that consist of blanks and invisible marks only, have no
partner; records delivered twice count once; records of one document are not compared with each other.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.checkpoint import checkpoint
from quire.partitioning import spread

# Letters of other scripts and the Latin letters they look like, by script.
CYRILLIC = ("АВЕЅІЈКМНОРСТУХҮԌԚԜаԁеһіјӏорԛѕѵԝхусү", "ABESIJKMHOPCTYXYGQWadehijlopqsvwxycy")
GREEK = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϲϳ", "ABEZHIKMNOPTYXovcj")
ARMENIAN = ("ՍՕհոսցօքզ", "UOhnugofq")
CHEROKEE = ("ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᎽᏀᏃᏎᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏴᏻ", "DRTiAJEWMHYGZ4bRWSVSLCPKBG")
LISU = ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU")
COPTIC = ("ⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ", "HIKMNOPCTYXopc")
# Other forms of letters of one script, with the usual one.
LETTER_FORMS = {"ɑ": "a", "ɡ": "g"}
# The blocks of those scripts; what lies elsewhere among letters with marks is Latin.
BLOCKS = {"Cyrillic": "Ѐ-ԯ", "Greek": "Ͱ-Ͽἀ-῿", "Armenian": "԰-֏", "Cherokee": "Ꭰ-᏿ꭰ-ꮿ", "Lisu": "ꓐ-꓿", "Coptic": "Ⲁ-⳿"}
# Marks that are not seen, and hyphens that look like the plain one.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩︀︁︂︃︄︅︆︇︈︉︊︋︌︍︎️﻿"
HYPHENS = "‐‑"


def _fold_table() -> dict[int, str]:
    """Characters that only differ in width, joining, form or kind from another spelling, with that spelling."""
    table: dict[int, str] = {}
    for o in range(0x80, 0x30000):
        c = chr(o)
        kind, _, points = unicodedata.decomposition(c).partition(" ")
        if unicodedata.category(c) == "Zs":
            table[o] = " "
        elif kind in ("<wide>", "<narrow>") or 0xFB00 <= o <= 0xFB4F and kind == "<compat>" or 0x2E80 <= o <= 0x2FDF and kind == "<compat>":
            table[o] = unicodedata.normalize("NFKC", c)
        elif kind == "<compat>" and 0xB5 <= o <= 0x1F5 and not points.startswith("0020"):
            table[o] = unicodedata.normalize("NFKC", c)
        elif kind == "<font>" or 0x2160 <= o <= 0x217F and kind == "<compat>":  # letters for formulas, and Roman numerals
            table[o] = unicodedata.normalize("NFKC", c)
    table[0xB5], table[0x3BC] = "µ", "µ"
    table.update({ord(c): usual for c, usual in LETTER_FORMS.items()})
    table.update({ord(c): "" for c in INVISIBLE})
    table.update({ord(c): "-" for c in HYPHENS})
    return table


FOLDS = _fold_table()
_FOREIGN = {script: dict(zip(map(ord, a), b)) for script, (a, b) in {
    "Cyrillic": CYRILLIC, "Greek": GREEK, "Armenian": ARMENIAN, "Cherokee": CHEROKEE, "Lisu": LISU, "Coptic": COPTIC,
}.items()}
_TO_LATIN = {k: v for m in _FOREIGN.values() for k, v in m.items()}
#: From the Latin look to each script's letter; of two letters with one look the first.
_FROM_LATIN = {script: {ord(b): chr(a) for a, b in reversed(m.items())} for script, m in _FOREIGN.items()}
_LOOKS = {b: frozenset(["Latin", *(s for s, m in _FROM_LATIN.items() if ord(b) in m)]) for b in set(_TO_LATIN.values())}
_OF_SCRIPT = {script: re.compile(f"[{block}]") for script, block in BLOCKS.items()}
_OTHER = re.compile("[" + "".join(BLOCKS.values()) + "]")
_TOKEN = re.compile("[A-Za-zÀ-ÖØ-öø-ʯ̀-ͯḀ-ỿ" + "".join(BLOCKS.values()) + "]+")
_SURE_CYRILLIC = re.compile("[бвгджзийклмнптфцчшщъыьэюяБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯ]")
_NOT_CYRILLIC = re.compile("[A-Za-zÀ-ÖØ-öø-ʯ̀-ͯḀ-ỿ" + "".join(b for s, b in BLOCKS.items() if s != "Cyrillic") + "]")
_ALIKE = re.compile("[" + "".join(map(chr, _TO_LATIN)) + "]")


def _script(c: str) -> str:
    for script, block in _OF_SCRIPT.items():
        if block.match(c):
            return script
    return "Latin"


def _resolve(look: str) -> frozenset[str] | None:
    """Scripts in which every letter of a token's look exists; None if a token has no letters."""
    left: frozenset[str] | None = None
    for c in look:
        if unicodedata.combining(c):
            continue
        scripts = _LOOKS.get(c) or frozenset([_script(c)])
        left = scripts if left is None else left & scripts
    return left


def _spell(look: str, script: str) -> str:
    return look if script == "Latin" else look.translate(_FROM_LATIN[script])


def unify_scripts(line: str) -> str:
    """The line with every token spelled in one script; composed text in, composed text out."""
    if not _ALIKE.search(line):
        # Latin letters alone may still stand for another script's, as in a token of a line of that script
        if not _OTHER.search(line):
            return line
    if _SURE_CYRILLIC.search(line) and not _NOT_CYRILLIC.search(line):
        return line  # every token is of this script, or takes it from its neighbours
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(line)]
    looks = [unicodedata.normalize("NFD", line[a:z]).translate(_TO_LATIN) for a, z in tokens]
    sets = [_resolve(x) for x in looks]
    sure = [next(iter(s)) if s and len(s) == 1 else None for s in sets]
    chosen: list[str] = []
    for i, s in enumerate(sets):
        script = sure[i]
        if script is None:
            script = "Latin"
            if s and len(s) > 1:
                for d in range(1, len(sets)):
                    near = {sure[j] for j in (i - d, i + d) if 0 <= j < len(sure)} - {None}
                    near &= s
                    if near:
                        script = "Latin" if "Latin" in near else min(near)
                        break
        chosen.append(script)
    out, at = [], 0
    for (a, z), look, script in zip(tokens, looks, chosen):
        out += (line[at:a], unicodedata.normalize("NFC", _spell(look, script)))
        at = z
    out.append(line[at:])
    return "".join(out)


def one_form(text: str | None) -> str | None:
    """The consistent form of a text."""
    if not text or text.isascii():
        return text
    text = unicodedata.normalize("NFC", text.translate(FOLDS))
    if not _OTHER.search(text):
        return text
    return "\n".join(map(unify_scripts, text.split("\n")))


def normalized(records: DataFrame) -> DataFrame:
    """``records`` (``tab, document_id, page_number, text``) with ``form``, the consistent form of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            form = pa.array([one_form(t) for t in b.column(3).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, form], ["tab", "document_id", "page_number", "text", "form"])

    return spread(records.select("tab", "document_id", "page_number", "text")).mapInArrow(
        run, "tab STRING, document_id STRING, page_number INT, text STRING, form STRING"
    )


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def digests(records: DataFrame) -> DataFrame:
    """``tab, document_id, page_number, stored, form``: 128-bit digests of the text as stored and of its form, of records that show anything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stored, forms = [], []
            for t in b.column(3).to_pylist():
                form = one_form(t)
                if form and not form.isspace():
                    stored.append(_digest(t))
                    forms.append(_digest(form) if form is not t else stored[-1])
                else:
                    stored.append(None)
                    forms.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(stored, pa.binary()), pa.array(forms, pa.binary())],
                ["tab", "document_id", "page_number", "stored", "form"],
            )

    rows = records.select("tab", "document_id", "page_number", "text").where("text IS NOT NULL AND document_id IS NOT NULL")
    return spread(rows).mapInArrow(run, "tab STRING, document_id STRING, page_number INT, stored BINARY, form BINARY").where("form IS NOT NULL")


def alike(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of records that read the same, and their members.

    Classes are ``tab, form, stored, records``: a row for each spelling (digest ``stored``) of each form that is stored in several ways, with the number
    of its distinct records. Members are ``tab, document_id, page_number, form, stored``, each record of a class once. Both grow with the
    records at most, however many copies a spelling has.
    """
    rows = checkpoint(digests(records))  # read by both
    spellings = rows.distinct().groupBy("tab", "form", "stored").agg(F.count("*").alias("records"))
    varied = rows.groupBy("tab", "form").agg(F.min("stored").alias("least"), F.max("stored").alias("most")).where("least < most").select("tab", "form")
    return spellings.join(varied, ["tab", "form"], "left_semi"), rows.join(varied, ["tab", "form"], "left_semi").distinct()


def alike_pairs(records: DataFrame) -> DataFrame:
    """Pairs of records of different documents that are stored differently and read the same.

    Pairs are made of the distinct spellings of a form, which are few, and each is then given its records on either side: copies of one spelling
    never meet each other, and no more rows are made than there are pairs, but for those inside one document.
    """
    classes, members = alike(records)
    a, b = (classes.select("tab", "form", F.col("stored").alias(x)) for x in ("s", "t"))
    spellings = a.join(b, ["tab", "form"]).where("s < t").select("tab", "s", "t")
    one, other = (members.select("tab", F.col("stored").alias(x), F.col("document_id").alias(f"document_{x}"), F.col("page_number").alias(f"page_{x}")) for x in ("s", "t"))
    pairs = spellings.join(one, ["tab", "s"]).join(other, ["tab", "t"]).where("document_s <> document_t")
    first = F.col("document_s") < F.col("document_t")
    pick = lambda c, x, y: F.when(first, F.col(f"{c}_{x}")).otherwise(F.col(f"{c}_{y}"))
    return pairs.select(
        "tab", pick("document", "s", "t").alias("document_id_a"), pick("page", "s", "t").alias("page_number_a"),
        pick("document", "t", "s").alias("document_id_b"), pick("page", "t", "s").alias("page_number_b"),
    ).distinct()
