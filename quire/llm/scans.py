"""Repairing the text of scanned pages.

A noisy channel: a word as printed is misread by confusing shapes. The channel is learned from the corpus: for alphabets by expectation and
maximisation over pairs of rare and frequent words that differ in one gap of one or two letters; for scripts without spaces from
contexts that are nearly always filled by one character and now and then hold another. Any other confusion of one or two letters, or of one character in a known context, has
a probability as well. The source is the corpus's n-grams: words and neighbouring words of alphabets, three characters in a row elsewhere. Each line is decoded by Viterbi search
over the candidates of its words, or of its characters.

Words split at a line's end are told from words broken at their own hyphen by how often the corpus has the joined
and the hyphenated form. Page numbers are known by their form and place. Running headers and footers are known by
repetition: a line that stands nearly always at the edge of pages, of the corpus or of its document, or a document's title that comes again.

The tables hold what makes up a fixed share of the corpus or more, so their size is bounded; they are
counted over all texts.

Defined results: null and empty texts give no line; unreadable page records give none; lines of other kinds than furniture are reported once per kind;
records delivered twice count once; equal titles of different documents do not mix.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.checkpoint import checkpoint
from quire.llm.lookalikes import FOLDS, one_form
from quire.partitioning import spread

WORD_SHARE, PAIR_SHARE, TRIPLE_SHARE, COMPOUND_SHARE = 1e-6, 4e-6, 2e-6, 1e-6
#: A context is filled by one character if it has this share of it; a filler is rare if that one is so many times as frequent.
SETTLED, RARER = 0.9, 30.0
#: A confused pair makes up this share of all such rare fillers at least.
CONFUSION_SHARE = 0.0003
#: How many times as frequent a reading must be as a known word it replaces, by the word's length (5 or more); languages share short words.
FAR_MORE = {3: 3000.0, 4: 200.0, 5: 40.0}
#: The share of a reading of a short word that is unknown or holds a digit.
SHORT_SHARE = 3e-5
#: A header stands at the edge of its page in this share of its occurrences, and makes up this share of edge lines.
EDGE_SHARE, HEADER_SHARE = 0.85, 2e-5
#: The least number of pages that a header of the corpus, or of one document, stands on, whatever the size of the corpus.
HEADER_PAGES = 5
#: A confusable character that is misread in a smaller share of its occurrences is mostly right.
COMMON_SHARE = 0.1
#: Bits that a reading of a character must save beyond those of the confusion.
CHARACTER_GAIN = 4.0
#: Bits of a misread word, besides those of its confusion among all; of a confusion of letters, or of characters, that the corpus does not show; and of a word the corpus does not have.
CONFUSED, UNLISTED, UNLISTED_CHARACTER, UNSEEN = 3.0, 11.0, 9.0, 26.0
#: A word with this share of all may be read for a word with a confusion that the corpus does not show.
FREQUENT_SHARE = 5e-6

_LETTERS = "A-Za-zÀ-ÖØ-öø-ʯͰ-ϿЀ-ԯ̀-ͯ"
_CJK = "々-〇〡-〩぀-ヿ㐀-鿿豈-﫿"
_WORD = re.compile(f"[{_LETTERS}0-9!|]*[{_LETTERS}][{_LETTERS}0-9!|]*")
_COMPOUND = re.compile(f"[{_LETTERS}]+(?:-[{_LETTERS}]+)+")
_HAN = re.compile(f"[{_CJK}]")
_HAN_BLANK = re.compile(f"(?<=[{_CJK}，。；：、（）0-9A-Z]) (?=[{_CJK}，。；：、（）0-9A-Z])")
# Marks at the end of a split line; the second kind is never written inside a word.
SPLIT_MARKS, SURE_MARKS = "-‐‑⁃–¬­", "¬­"
_WITH_SIGN = re.compile(f"[{_LETTERS}][0-9!|]|[0-9!|][{_LETTERS}]")
_DIGITS = re.compile("(?=.*[0-9])[0-9OSBlIZ]+")
_MARKS = set(SPLIT_MARKS)
#: Characters whose consistent form matters for reading words; wide signs of punctuation do not.
_FOLDED = re.compile("[" + "".join(re.escape(chr(o)) for o in sorted(FOLDS) if o < 0x10000 and not (0xFF01 <= o <= 0xFF0F or 0xFF1A <= o <= 0xFF20 or chr(o) in "µ")) + "\u0300-\u036f\u3099\u309a\uf900-\ufaff]")
_ASTRAL = re.compile("[\U0001d400-\U0001d7ff]")  # apart, as a class within the first plane is searched faster
_OTHER = re.compile("[Ͱ-ԯ]")
_SECOND = re.compile("[Ѐ-ӿ]+")
_MIXED = re.compile("[A-Za-z][Ͱ-ԯ]|[Ͱ-ԯ][A-Za-z]")
_SPLIT_END = re.compile(f"[{SPLIT_MARKS}][ \\t\\r]*(?:\\n|$)")


def _folded(text: str) -> str:
    """The text in its consistent form, as far as that matters for reading words."""
    if text.isascii() or not (_FOLDED.search(text) or _ASTRAL.search(text) or _OTHER.search(text) and _MIXED.search(text)):
        return text
    return one_form(text)


_MAY_BE_NUMBER = re.compile(r"[0-9][.,]?[OSBlIZ]|[OSBlIZ][.,]?[0-9]")
_SPLIT = re.compile(f"([{_LETTERS}]+)[{SPLIT_MARKS}]\\s*$")
_HEAD = re.compile(f"\\s*([{_LETTERS}]+)")
_NUMBER = re.compile(r"(?<![\w.,/-])(?=[^\s]*[0-9])(?=[^\s%]*[OSBlIZ])[0-9OSBlIZ]+(?:[.,][0-9OSBlIZ]+)?(?=%|[.,;:)。，；]*(?:\s|$)|[぀-鿿])")
# Forms of page numbers.
_N = r"[0-9OlIS]+"
_PAGE = re.compile(
    rf"(?:[-–—·|~\[(]*\s*{_N}\s*[-–—·|~\])]*|{_N}\s*/\s*{_N}(?:\s*ページ)?|{_N}\s*ページ|第\s*{_N}\s*[页頁](?:\s*[,，/]?\s*共\s*{_N}\s*[页頁])?"
    rf"|\w{{3,6}}\.?\s+{_N}(?:\s*(?:of|von|sur|de|di|из|/|ot|ol)\s*{_N}(?:\s+\w+)?)?|(?:ページ|[页頁])\s*{_N}|[-–—·|]?\s*[ivxlcdm]{{1,8}}\s*[-–—·|]?)",
    re.IGNORECASE,
)
_PAGE_WORDS = re.compile(r"(?:page|seite|blatt|feuille|hoja|foglio|folha|лист|sheet|página|pagina|стр|страница|pag|p|s)\.?\s", re.IGNORECASE)
_CODE_END = re.compile(r"\s*[·|–—-]\s*[A-Z]{2}\s?[-0-9/OSBlI]+\s*$", re.IGNORECASE)
_ROMAN = re.compile(r"m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})", re.IGNORECASE)
_SENTENCE_END = re.compile(r"[.。!?;；:：,，、)）]\s*$")


def _close(text: str) -> str:
    """Unspaced script without the blanks set between its characters; other text as it is."""
    return _HAN_BLANK.sub("", text) if _HAN.search(text) else text


#: A longer line is looked at as a page number only if it has few parts; their length does not matter.
LONGEST_PAGE_NUMBER = 60


def is_page_number(text: str) -> bool:
    """Whether the text, in its consistent form, has the form of a page number."""
    if len(text) > LONGEST_PAGE_NUMBER and len(text.split()) > 8 and not _HAN.search(text):
        return False  # no form has so many parts
    t = _close(text.strip())
    if not t or not _PAGE.fullmatch(t):
        return False
    words = re.sub(r"[\W\d_]+", " ", t).split()
    if not words or _HAN.search(t):
        return True
    if len(words) == 1 and _ROMAN.fullmatch(words[0]):
        return True
    if all(set(w) <= set("OlIS") for w in words):
        return any(c.isdigit() for c in t) or len(words) == 1
    return bool(_PAGE_WORDS.match(t + " ")) and any(c.isdigit() or c in "OlIS" for c in t)


# Shapes of two letters with the one they are like.
_SKELETON = (("rn", "m"), ("nn", "m"), ("cl", "d"), ("li", "h"), ("ii", "u"), ("vv", "w"), ("ri", "n"), ("ti", "ü"))
_SHAPES = bytes.maketrans(b"ecil1!|oa0s5tf7g9qb68", b"cc" + b"lllll" + b"ooo" + b"ss" + b"ttt" + b"ggg" + b"bbb")


def skeleton(text: str) -> str:
    """What is left of a line in its consistent form when confusable shapes are taken as one."""
    t = "_".join(_close(text).lower().replace("_", " ").split())
    for two, one in _SKELETON:
        t = t.replace(two, one)
    return t.encode("utf-8", "surrogatepass").translate(_SHAPES).decode("utf-8", "surrogatepass")  # signs of one byte only


def _case(word: str, like: str) -> str:
    return word.upper() if like.isupper() and len(like) > 1 else word.capitalize() if like[:1].isupper() else word


# --- counts -------------------------------------------------------------------------------------------------


def _runs(text: str) -> list[str]:
    """Stretches of unspaced script, across line breaks, with digits as one class."""
    t = re.sub(f"(?<=[{_CJK}，。；：、]) *\\n(?=[{_CJK}])", "", text)
    t = re.sub(r"[0-9A-Z]+", "0", _HAN_BLANK.sub("", t))
    return re.findall(f"[{_CJK}0，。；、]{{3,}}", t)


def count_grams(records: DataFrame) -> DataFrame:
    """``kind, gram, n`` of all texts: words ``w``, word pairs ``p``, hyphenated words ``h``, triples of unspaced script ``t``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        pairs: Counter = Counter()
        compounds: Counter = Counter()
        triples: Counter = Counter()

        def emit() -> Iterator[pa.RecordBatch]:
            for kind, counts, between in (("w", words, None), ("p", pairs, " "), ("h", compounds, None), ("t", triples, "")):
                if counts:
                    grams = list(counts) if between is None else list(map(between.join, counts))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * len(counts)), pa.array(grams, pa.string()), pa.array(list(counts.values()), pa.int64())], ["kind", "gram", "n"]
                    )
                    counts.clear()

        for b in batches:
            for t in b.column(0).to_pylist():
                if not t:
                    continue
                t = _folded(t)
                low = t.lower()
                found = _WORD.findall(low)
                words.update(found)
                pairs.update(zip(found, found[1:]))
                if "-" in t:
                    for x in low.split():
                        if "-" in x:
                            compounds.update(_COMPOUND.findall(x))
                if _HAN.search(t):
                    for r in _runs(t):
                        triples.update(zip(r, r[1:], r[2:]))
            if len(words) + len(pairs) + len(triples) > 400_000:
                yield from emit()
        yield from emit()

    return spread(records.select("text").where("text IS NOT NULL")).mapInArrow(run, "kind STRING, gram STRING, n BIGINT").groupBy("kind", "gram").agg(F.sum("n").alias("n"))


def confusions(grams: DataFrame, triples: int) -> tuple[dict[str, list[tuple[str, float]]], set[str], dict[str, str]]:
    """What each character of an unspaced script may have been, with bits; learned from contexts that one character fills. Also those that are mostly right,
    and the contexts themselves that make up ``TRIPLE_SHARE`` of all ``triples``, with what fills them."""
    # the context of a character: what stands on both sides, before it, or after it
    t = grams.where("kind = 't'").selectExpr(
        """inline(array(named_struct('around', substr(gram, 1, 1) || '_' || substr(gram, 3, 1), 'c', substr(gram, 2, 1), 'n', n),
        named_struct('around', substr(gram, 1, 2) || '_', 'c', substr(gram, 3, 1), 'n', n), named_struct('around', '_' || substr(gram, 2, 2), 'c', substr(gram, 1, 1), 'n', n)))"""
    )
    settled = checkpoint(
        t.groupBy("around")
        .agg(F.max_by("c", "n").alias("usual"), F.max("n").alias("most"), F.sum("n").alias("total"))
        .where(f"most >= {SETTLED} * total AND most >= {RARER}")
    )
    rare = t.join(settled, "around").where(f"c <> usual AND n * {RARER} <= most AND c RLIKE '[{_CJK}]' AND usual RLIKE '[{_CJK}]'")
    all_of = t.groupBy("c").agg(F.sum("n").alias("all_of"))
    pairs = rare.groupBy("c", "usual").agg(F.sum("n").alias("n"), F.count("*").alias("contexts")).join(all_of, "c")
    total = pairs.agg(F.sum("n")).collect()[0][0] or 0
    out: dict[str, list[tuple[str, float]]] = {}
    common: set[str] = set()
    for r in pairs.where(F.col("n") >= CONFUSION_SHARE * total).where("contexts >= 2 OR n >= 20").collect():  # at most 1 / CONFUSION_SHARE
        if one_form(r["c"]) == r["usual"]:
            continue  # another form of the same character
        out.setdefault(r["c"], []).append((r["usual"], -math.log2(r["n"] / total)))
        if r["n"] < COMMON_SHARE * r["all_of"]:
            common.add(r["c"])
    frequent = settled.where((F.col("most") >= TRIPLE_SHARE * triples) & F.expr("substr(around, 2, 1) = '_'") & F.col("usual").rlike(f"[{_CJK}]"))
    return out, common, {r["around"][0] + r["around"][2]: r["usual"] for r in frequent.collect() if len(r["around"]) == 3}


def channel(grams: DataFrame, least: float) -> dict[str, list[tuple[str, float]]]:
    """What a stretch of one or two letters may have been, with bits, learned by expectation and maximisation from words of alphabets.

    A word with a gap is a context. Where one filling is ``RARER`` times as frequent as another, the other is a misreading of it or a word of its own. The
    rare words of one set of explanations are shared out among them, first evenly and then by how often each confusion explains anything, until
    the confusions that explain much stand out; one is kept if it makes up ``CONFUSION_SHARE`` of all. Words of fewer than ``least``
    occurrences are left out, so the work is bounded like the table of words.
    """
    words = grams.where((F.col("kind") == "w") & (F.col("n") >= least) & F.col("gram").rlike(f"^[{_LETTERS}0-9!|]{{4,24}}$")).select("gram", "n")
    gaps = words.selectExpr(
        """inline(flatten(transform(array(1, 2), k -> transform(sequence(1, length(gram) - k + 1), i -> named_struct(
        'around', substr(gram, 1, i - 1) || '_' || substr(gram, i + k), 'x', named_struct('n', n, 'filling', substr(gram, i, k), 'word', gram))))))"""
    )
    # the fillings of a gap are as many as an alphabet has stretches of two letters at most
    fillings = gaps.groupBy("around").agg(F.collect_list("x").alias("xs")).where("size(xs) > 1").selectExpr("xs", "array_max(xs) AS usual")
    rare = fillings.selectExpr(
        f"""inline(transform(filter(xs, x -> x.n * {RARER} <= usual.n AND left(x.filling, 1) <> left(usual.filling, 1) AND right(x.filling, 1) <> right(usual.filling, 1)),
        x -> named_struct('word', x.word, 'n', x.n, 'confusion', named_struct('wrong', x.filling, 'right', usual.filling))))"""
    )
    sets = checkpoint(rare.groupBy("word").agg(F.first("n").alias("n"), F.array_sort(F.collect_set("confusion")).alias("confusions")).groupBy("confusions").agg(F.sum("n").alias("n"), F.count("*").alias("words")))
    total = sets.agg(F.sum("n")).collect()[0][0] or 0
    rows = sets.where((F.col("n") >= CONFUSION_SHARE * total / 2) & (F.col("words") > 1)).collect()  # at most 2 / CONFUSION_SHARE
    explained = [([(c["wrong"], c["right"]) for c in r["confusions"]], r["n"]) for r in rows]
    weights = {c: 1.0 for cs, _ in explained for c in cs}
    for _ in range(20):
        counts: Counter = Counter()
        for cs, n in explained:
            whole = sum(weights.get(c, 0.0) for c in cs)
            for c in cs if whole else ():
                counts[c] += n * weights.get(c, 0.0) / whole
        whole = sum(counts.values()) or 1.0
        weights = {c: n / whole for c, n in counts.items() if n >= CONFUSION_SHARE * whole}
    out: dict[str, list[tuple[str, float]]] = {}
    for (wrong, right), share in sorted(weights.items()):
        marked = [c for c in wrong + right if len(unicodedata.normalize("NFD", c)) > 1 and not _SECOND.match(c)]
        if marked and not wrong.isascii() and (not right.isascii() or set(unicodedata.normalize("NFD", wrong)) & set(right)):
            continue  # another accent, or none, is no confusion of shapes
        out.setdefault(wrong, []).append((right, CONFUSED - math.log2(share)))
    return out


def tables(records: DataFrame) -> dict:
    """The bounded tables of the channel and the source."""
    grams = checkpoint(count_grams(records))
    totals = {r["kind"]: r["n"] for r in grams.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    share = {"w": WORD_SHARE, "p": PAIR_SHARE, "h": COMPOUND_SHARE, "t": TRIPLE_SHARE}
    found, common, usual = confusions(grams, totals.get("t") or 0)
    out: dict = {"totals": totals, "confusions": found, "common": common, "usual": usual}
    out["channel"] = channel(grams, max(2, WORD_SHARE * (totals.get("w") or 0)))
    for kind in share:
        least = max(2, share[kind] * (totals.get("w" if kind == "h" else kind) or 0))
        out[kind] = {r["gram"]: r["n"] for r in grams.where((F.col("kind") == kind) & (F.col("n") >= least)).collect()}
    return out


# --- lines --------------------------------------------------------------------------------------------------


class Reader:
    """Reads lines under the tables."""

    def __init__(self, made: dict):
        self.words, self.pairs, self.compounds, self.triples = made["w"], made["p"], made["h"], made["t"]
        self.total = max(1, made["totals"].get("w", 1))
        self.confusions, self.common, self.usual = made["confusions"], made["common"], made.get("usual", {})
        self.channel = [(wrong, right, bits) for wrong, rights in made.get("channel", {}).items() for right, bits in rights]
        self._gaps: dict[str, list[str]] = {}
        for w, n in self.words.items():
            if n >= FREQUENT_SHARE * self.total and len(w) > 3 and w.isalpha():
                for k in (1, 2):
                    for i in range(len(w) - k + 1):
                        self._gaps.setdefault(f"{w[:i]}_{w[i + k:]}", []).append(w)
        self.rarest = max(0.5, TRIPLE_SHARE * made["totals"].get("t", 0) / 6)
        self._candidates: dict[str, tuple[tuple[str, float], ...]] = {}
        self._plain: set[str] = set()
        self._changes: dict[str, bool] = {}
        self._confusable = re.compile("[" + "".join(map(re.escape, self.confusions)) + "]") if self.confusions else None

    def candidates(self, word: str) -> tuple[tuple[str, float], ...]:
        """Readings of a lower-case word with the bits of their confusions; the word itself first."""
        known = self._candidates.get(word)
        if known is None:
            known = self._find(word)
            if len(self._candidates) > 300_000:
                self._candidates.clear()
                self._plain.clear()
            self._candidates[word] = known
            if len(known) == 1:
                self._plain.add(word)
        return known

    def _find(self, word: str) -> tuple[tuple[str, float], ...]:
        own = self.words.get(word, 0)
        found: dict[str, float] = {}
        least = self._least(word, own)
        if least is not None:
            once = self._once(word)
            for w, bits in once.items():
                if self.words.get(w, 0) > least and bits < found.get(w, 99.0):
                    found[w] = bits
            if not found and not own and len(word) > 4:
                for x, first in once.items():
                    for w, bits in self._once(x).items():
                        if w != word and self.words.get(w, 0) and first + bits < found.get(w, 99.0):
                            found[w] = first + bits
            if not own and len(word) > 3:
                for k in (1, 2):
                    for i in range(len(word) - k + 1):
                        filling = word[i : i + k]
                        if filling.isascii() or _SECOND.fullmatch(filling):
                            for w in self._gaps.get(f"{word[:i]}_{word[i + k:]}", ()):
                                if w[i] != word[i] and w[len(w) - len(word) + i + k - 1] != word[i + k - 1] and w not in found and (filling.isascii() and not filling.isalpha() or filling.isascii() == w[i : len(w) - len(word) + i + k].isascii()):
                                    found[w] = UNLISTED
        return ((word, 0.0), *sorted(found.items(), key=lambda x: (x[1], -self.words[x[0]])))

    def _least(self, word: str, own: int) -> float | None:
        """How often another word must occur to be a reading of this one; None if none can be."""
        if _WITH_SIGN.search(word):  # never written so
            return 0 if len(word) > 2 else SHORT_SHARE * self.total
        if len(word) < 3:
            return None
        if own:
            return own * FAR_MORE[min(len(word), 5)]
        return 0 if len(word) > 3 else SHORT_SHARE * self.total

    def _once(self, word: str) -> dict[str, float]:
        """The word with one confusion undone, with the bits of the confusion."""
        out: dict[str, float] = {}
        for wrong, right, bits in self.channel:
            at = word.find(wrong)
            while at >= 0:
                x = word[:at] + right + word[at + len(wrong) :]
                if bits < out.get(x, 99.0):
                    out[x] = bits
                at = word.find(wrong, at + 1)
        return out

    def _bits(self, word: str) -> float:
        n = self.words.get(word)
        return -math.log2(n / self.total) if n else UNSEEN

    def decode(self, words: list[str]) -> list[str]:
        """The likeliest readings of a line's lower-case words."""
        options = [self.candidates(w) for w in words]
        if all(len(o) == 1 for o in options):
            return words
        steps: list[dict[str, tuple[float, str]]] = []
        before: dict[str, float] = {"": 0.0}
        for o in options:
            now: dict[str, tuple[float, str]] = {}
            for w, channel in o:
                own = self._bits(w) + channel
                for last, bits in before.items():
                    n = self.pairs.get(f"{last} {w}", 0) if last else 0
                    cost = bits + channel + min(own - channel, -math.log2(n / self.words[last]) + 1 if n and last in self.words else 99)
                    if w not in now or cost < now[w][0]:
                        now[w] = (cost, last)
            steps.append(now)
            before = {w: c for w, (c, _) in now.items()}
        last = min(before, key=before.get)
        out = []
        for now in reversed(steps):
            out.append(last)
            last = now[last][1]
        return out[::-1]

    def joins(self, first: str, mark: str, second: str) -> bool:
        """Whether two pieces at a line break are one word that was split there."""
        if mark in SURE_MARKS:
            whole = first + second
            return whole.isupper() or whole[1:].islower()  # else damage of another kind
        a, b = first.lower(), second.lower()
        joined, hyphened = self.words.get(a + b, 0), self._compound(a, b)
        if joined or hyphened:
            return joined > hyphened
        if second[:1].isupper() and not first.isupper():
            return False
        if first.isupper() and len(first) <= 2:
            return False
        readings = self.candidates(a + b)
        return len(readings) > 1 or not (self.words.get(a, 0) and self.words.get(b, 0))

    def _compound(self, a: str, b: str) -> int:
        return self.compounds.get(f"{a}-{b}", 0) or self._ends.get((a, b), 0)

    @property
    def _ends(self) -> dict[tuple[str, str], int]:
        """Neighbouring parts inside hyphenated words."""
        if not hasattr(self, "_inside"):
            self._inside: dict[tuple[str, str], int] = {}
            for c, n in self.compounds.items():
                parts = c.split("-")
                for pair in zip(parts, parts[1:]):
                    self._inside[pair] = self._inside.get(pair, 0) + n
        return self._inside

    def read(self, text: str) -> tuple[list[str], set[int], set[int]]:
        """The lines with misread words and characters corrected, the numbers (from 0) of lines that end in a split word, and of misread ones."""
        raw = text.split("\n")
        folded = _folded(text)
        lines = folded.split("\n")
        split: set[int] = set()
        misread: set[int] = set()
        carried: tuple[str, str, str] | None = None  # first piece, mark, second piece of the word split before this line
        # most texts hold nothing but words that read as themselves
        plain = not _MAY_BE_NUMBER.search(folded) and not _SPLIT_END.search(text) and self._plain.issuperset(_WORD.findall(folded.lower()))
        for i, line in enumerate(() if plain else lines):
            if not line:
                continue
            ending = None
            m = _SPLIT.search(raw[i]) if i + 1 < len(lines) and raw[i].rstrip(" \t")[-1:] in _MARKS else None
            if m:
                head = _HEAD.match(lines[i + 1])
                if head and self.joins(one_form(m[1]), raw[i].rstrip()[-1], head[1]):
                    ending = (one_form(m[1]), raw[i].rstrip()[-1], head[1])
                    split.add(i)
            if carried or ending or _MAY_BE_NUMBER.search(line) or not self._plain.issuperset(_WORD.findall(line.lower())):
                fixed, wrong = self._read_words(line, raw[i], carried, ending)
                if wrong:
                    misread.add(i)
                    lines[i] = fixed
            carried = ending
        if _HAN.search(text):
            self._read_characters(lines, misread)
        return lines, split, misread

    def _read_words(self, line: str, raw: str, carried, ending) -> tuple[str, bool]:
        matches = list(_WORD.finditer(line))
        if not matches:
            numbers = _NUMBER.search(line)
            return (_NUMBER.sub(_digits, line), True) if numbers else (line, False)
        words = [m.group().rstrip("!|").lstrip("|").lower() for m in matches]
        suspects = False
        for w in words:
            o = self._candidates.get(w) or self.candidates(w)
            if len(o) > 1:
                suspects = True
        wrong = False
        if suspects:
            skip = {0} if carried else set()
            if ending or raw.rstrip()[-1:] in SPLIT_MARKS:
                skip.add(len(words) - 1)
            read = self.decode(words)
            pieces, at = [], 0
            for k, (m, old, new) in enumerate(zip(matches, words, read)):
                if _DIGITS.fullmatch(m.group()):
                    continue
                if old != new and k not in skip and not (m.group().isupper() and len(old) < 4) and not _is_code(line, m) and _plain(line, m):
                    wrong = True
                    a = m.start() + m.group().lower().find(old)
                    pieces += (line[at:a], _case(new, m.group()))
                    at = a + len(old)
            line = "".join(pieces) + line[at:]
        for piece in (carried, ending):
            if piece:
                a, b = piece[0].lower(), piece[2].lower()
                whole = self.candidates(a + b)
                if len(whole) > 1:
                    new = whole[1][0]
                    here, there = (b, a) if piece is carried else (a, b)
                    intact = new.startswith(there) if piece is carried else new.endswith(there)
                    if intact or not (new.endswith(here) if piece is carried else new.startswith(here)):
                        wrong = True
        if _NUMBER.search(line):
            wrong = True
            line = _NUMBER.sub(_digits, line)
        return line, wrong

    def _reading(self, c: str, windows: list[tuple[str, int]]) -> str | None:
        """What a confusable character was, by the triples it stands in and its place in each; None if itself."""
        triples, rarest = self.triples, self.rarest
        best, most = None, CHARACTER_GAIN
        for usual, bits in self.confusions[c]:
            gain = -bits
            for x, o in windows:
                gain += math.log2((triples.get(x[:o] + usual + x[o + 1 :], 0) + rarest) / (triples.get(x, 0) + rarest))
            if gain > most:
                best, most = usual, gain
        return best

    def _doubtful(self, lines: list[str], classes: list[str], i: int, strange: bool) -> bool:
        """Whether the line holds a confusable character; one that is mostly right counts if it reads otherwise between its neighbours, also across line breaks; so does any other in an unknown place of a known context."""
        found = self._confusable.findall(lines[i]) if self._confusable else []
        if not found and not (strange and _HAN.search(lines[i])):
            return False
        if found and not self.common.issuperset(found):
            return True
        # two characters of what stands around the line
        before = classes[i - 1][-2:] if i and "�" not in classes[i - 1] else ""
        after = classes[i + 1][:3] if i + 1 < len(lines) and "�" not in classes[i + 1] else ""
        around = (before + classes[i] + after).replace("00", "0")
        if strange and self._strange(around):
            return True
        if not found:
            return False
        around = "\n\n" + around + "\n\n"
        for m in self._confusable.finditer(around):
            context = around[m.start() - 2 : m.start() + 3]
            changes = self._changes.get(context)
            if changes is None:
                if len(self._changes) > 200_000:
                    self._changes.clear()
                changes = self._changes[context] = self._reading(context[2], [(context[o : o + 3], 2 - o) for o in range(3)]) is not None
            if changes:
                return True
        return False

    def _strange(self, chars: str) -> list[int]:
        """Places of characters that no known triple holds, among neighbours whose triples are known, where the context is filled by another."""
        triples, n = self.triples, len(chars) - 2
        out, passed = [], -1
        for i in range(0, n, 3):  # three unknown triples in a row hold one of these places
            if chars[i : i + 3] in triples or i <= passed:
                continue
            begin, passed = i, i
            while begin and chars[begin - 1 : begin + 2] not in triples:
                begin -= 1
            while passed + 1 < n and chars[passed + 1 : passed + 4] not in triples:
                passed += 1
            if passed == begin + 2:
                usual = self.usual.get(chars[begin + 1] + chars[begin + 3])
                if usual and usual != chars[passed] and _HAN.match(chars[passed]):
                    out.append(passed)
        return out

    def _read_characters(self, lines: list[str], misread: set[int]) -> None:
        """Corrects confused characters of unspaced script in ``lines`` by Viterbi search over the readings of each, with contexts that reach over line breaks."""
        confused = self.confusions
        # stretches of characters with their places, from lines that hold a doubtful one and their neighbours; digits and capitals are one class
        whole = _classes("\n".join(lines))
        strange = bool(self._strange(whole.replace("\n\n", "\0").replace("\n", "").replace("\0", "\n").replace("00", "0")))
        if not strange and not (self._confusable and self._confusable.search(whole)):
            return
        classes = whole.split("\n")
        near = {j for i in range(len(lines)) if self._doubtful(lines, classes, i, strange) for j in (i - 1, i, i + 1)}
        if not near:
            return
        chars: list[str] = []
        places: list[tuple[int, int]] = []
        for i in sorted(near & set(range(len(lines)))):
            line = lines[i]
            if not line or "�" in line or i - 1 not in near:  # a paragraph's end, damage of another kind, or another stretch
                chars.append("\n")
                places.append((i, -1))
                if not line or "�" in line:
                    continue
            for j, c in enumerate(line):
                if c == " ":
                    continue
                if c.isascii() and (c.isdigit() or c.isupper()):
                    c = "0"
                    if chars[-1:] == ["0"]:
                        continue
                chars.append(_WIDE.get(c, c))
                places.append((i, j))
        if not chars:
            return
        options: dict[int, list[tuple[str, float]]] = {k: [(u, bits + CHARACTER_GAIN) for u, bits in confused[c]] for k, c in enumerate(chars) if c in confused}
        for k in self._strange("".join(chars)):
            usual = self.usual[chars[k - 1] + chars[k + 1]]
            if all(u != usual for u, _ in options.get(k, ())):
                options.setdefault(k, []).append((usual, UNLISTED_CHARACTER + CHARACTER_GAIN))
        changes: dict[int, dict[int, str]] = {}
        for k, new in self._likeliest(chars, options).items():
            i, j = places[k]
            changes.setdefault(i, {})[j] = new
        for i, by in changes.items():
            lines[i] = "".join(by.get(j, c) for j, c in enumerate(lines[i]))
            misread.add(i)

    def _likeliest(self, chars: list[str], options: dict[int, list[tuple[str, float]]]) -> dict[int, str]:
        """The characters that change in the likeliest reading under the triples' frequencies; ``options`` are the other readings of places, with bits."""
        out: dict[int, str] = {}
        places = sorted(options)
        while places:
            # places so near that a triple holds two are read together
            last = 1
            while last < len(places) and places[last] - places[last - 1] < 3:
                last += 1
            group, places = places[:last], places[last:]
            begin, end = max(0, group[0] - 2), min(len(chars), group[-1] + 3)
            states: dict[tuple[str, ...], tuple[float, dict[int, str]]] = {(): (0.0, {})}
            for k in range(begin, end):
                now: dict[tuple[str, ...], tuple[float, dict[int, str]]] = {}
                for c, bits in ((chars[k], 0.0), *options.get(k, ())):
                    for before, (cost, changed) in states.items():
                        own = cost + bits
                        if len(before) == 2:
                            triple = before[0] + before[1] + c
                            if "\n" not in triple:
                                own -= math.log2(self.triples.get(triple, 0) + self.rarest)
                        state = (*before, c)[-2:]
                        if state not in now or own < now[state][0]:
                            now[state] = own, changed if c == chars[k] else {**changed, k: c}
                states = now
            out.update(min(states.values(), key=lambda x: x[0])[1])
        return out

    def repair(self, text: str, furniture: set[int]) -> str:
        """The text without furniture lines (numbers from 1), corrected, with split words whole and lines joined into paragraphs."""
        lines, split, _ = self.read(text)
        widest = max(map(len, lines), default=0)
        out: list[str] = []
        open_line = join_word = False  # whether the last line goes on, and whether in the middle of a word
        for i, line in enumerate(lines):
            if i + 1 in furniture:
                continue  # a paragraph goes on below furniture
            line = line.strip()
            if not line:
                out.append("")
                open_line = join_word = False
                continue
            if open_line and out and out[-1] and not _OWN_LINE.match(line):
                before = out[-1]
                close = join_word or _HAN.match(before[-1]) and _HAN.match(line[0]) or before[-1] in "，、；。,;" and _HAN.match(line[0]) or before[-1] in "-‐‑" and line[0].isalpha()
                out[-1] = (before[:-1] if join_word else before) + ("" if close else " ") + line
            else:
                out.append(line)
            join_word = i in split
            open_line = not _OWN_LINE.match(line) and (join_word or len(line) >= 0.6 * widest)
        return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip("\n")


#: Signs that the consistent form narrows, as the counts have them.
_WIDE = {",": "，", ";": "；"}
_CODES = re.compile("[0-9A-Z]+")


def _classes(line: str) -> str:
    """The line as the counts have it: no blanks, and digits and capitals as one class."""
    return _CODES.sub("0", line.replace(" ", "").replace(",", "，").replace(";", "；"))


# Openings of lines that stand by themselves.
_OWN_LINE = re.compile(r"[#|!•*]|- |[0-9]+(?:\.[0-9]+)* \S|(?:Table|Figure|Tabelle|Abbildung|Tableau|Tabla|Figura|Tabela|Tabella|Таблица|Рисунок|表|图|図) ?[0-9]")


def _digits(m: re.Match) -> str:
    return m.group().translate(str.maketrans("OSBlIZ", "058112"))


# Signs beyond ASCII that may stand beside a word.
_BESIDE = set("’‘“”„«»‹›–—…•·°²³±µ‐‑。，、；：（）「」『』《》¿¡º")


_ODD_INSIDE = ("²", "³", "°", "±", "µ", "º", "¡", "¿")


def _plain(line: str, m: re.Match) -> bool:
    """Whether a word stands beside ordinary signs only; others are damage of another kind."""
    a, z = line[m.start() - 1 : m.start()], line[m.end() : m.end() + 1]
    return all(not c or c.isascii() or c in _BESIDE or c.isspace() or bool(_HAN.match(c)) for c in (a, z)) and not (
        a in _ODD_INSIDE and line[m.start() - 2 : m.start() - 1].isalpha() or z in _ODD_INSIDE and line[m.end() + 1 : m.end() + 2].isalpha())


def _is_code(line: str, m: re.Match) -> bool:
    """Whether a word is part of a reference code or an address."""
    return line[m.end() : m.end() + 1] in ("/", "_", "{", "}") or line[m.start() - 1 : m.start()] in ("/", "_", "\\", "{") or bool(re.fullmatch(r"[A-Z]{2}[0-9OSBlI]*", m.group()))


_reader_of: list = []


def _reader(shared) -> Reader:
    made = shared.value
    if not _reader_of or _reader_of[0] is not made:
        _reader_of[:] = [made, Reader(made)]
    return _reader_of[1]


# --- furniture ----------------------------------------------------------------------------------------------


# Labels of blocks that are headings or captions.
HEADING_LABELS = ("paragraph_title", "figure_title", "table_title", "caption", "figure_caption", "table_caption")


#: A line off the edges is compared with headers of the corpus up to this length; a longer one counts where it stands at an edge.
LONGEST_INNER = 44


_COLUMNS = re.compile(r"\s{2,}|\t")
_OTHER_BLANK = re.compile(r"[^\S ]")


def _cores(line: str) -> tuple[str | None, bool] | None:
    """The part of a line that is no page number, and whether another part is one; None if several parts are none."""
    if len(line) > LONGEST_PAGE_NUMBER and "  " not in line and not _OTHER_BLANK.search(line):
        return line.strip(), False
    if is_page_number(line):
        return None, True
    parts = [p for p in _COLUMNS.split(line.strip()) if p]
    if len(parts) == 1:
        return parts[0], False
    rest = [p for p in parts if not is_page_number(p)]
    if not rest:
        return None, True
    return (rest[0], len(rest) < len(parts)) if len(rest) == 1 else None


_DASHED = re.compile(r"- [0-9OlIS]+ -(?:\s|$)|\| ?[0-9OlIS]+(?:\s{2,}|$)")


def edge_lines(tab: str, label: str | None, lines: list[str], page: int) -> Iterator[tuple[int, str | None, bool, bool, str]]:
    """Lines that may be furniture: number from 1, skeleton of the core, whether a page number is on the line, whether at the page's edge, and a role.

    Lines at an edge are among them at any length.
    """
    if tab == "native_text_pages":
        filled = [i for i, x in enumerate(lines) if x.strip()]
        top = set(filled[:EDGE_LINES])
        edge = top.union(filled[-EDGE_LINES:])
        first = filled[0] if filled else -1
        for i in filled:
            if i in edge:
                c = _cores(lines[i])
                if c:
                    yield i + 1, _core_shape(c[0]), c[1], True, "title" if page == 1 and i == first else "top" if i in top else "line"
            elif len(lines[i]) <= LONGEST_INNER and not _SENTENCE_END.search(lines[i]):  # counts against headers of the corpus only
                core = _core(lines[i].strip())
                if not _NO_HEADER.search(core):
                    yield i + 1, skeleton(core), False, False, "line"
    elif tab == "parsed_documents":
        titled = False
        for i, x in enumerate(lines):
            if not x.strip() or (i and lines[i - 1].strip()) or (i + 1 < len(lines) and lines[i + 1].strip()):
                continue
            if x.startswith("# ") and not titled:
                titled = True
                yield i + 1, _core_shape(x[2:]), False, False, "title"
            elif not x.startswith(("#", "|", "!", "- ", "* ", "• ")) or _DASHED.match(x):
                c = _cores(x)
                if c:
                    yield i + 1, _core_shape(c[0]), c[1], True, "line"
            elif x.startswith("#"):
                yield i + 1, _core_shape(x), False, False, "heading"
            elif is_page_number(x):
                yield i + 1, None, True, True, "line"
    else:
        marked = label in ("header", "footer", "number", "page_header", "page_footer", "page_number")
        filled = [i for i, x in enumerate(lines) if x.strip()]
        if len(filled) == 1 or marked:
            for i in filled:
                c = _cores(lines[i])
                if c or marked:
                    c = c or (lines[i], False)
                    role = "marked" if marked else "title" if label == "doc_title" else "heading" if label in HEADING_LABELS else "line"
                    yield i + 1, _core_shape(c[0]), c[1], role != "heading", role


#: Lines at the head and at the foot of a page that are its edges.
EDGE_LINES = 2
_LEADING = re.compile(r"^[#\s]*(?:[0-9OlIS]+(?:\.[0-9OlIS]+)*\.?\s+)?")


_CODE_LAST = set("0123456789-/OSBlIosbi")
_MAY_LEAD = set("# \t0123456789OlIS")
_DIGIT = re.compile("[0-9]")
_FIGURES = re.compile(r"[0-9]+(?:[.,][0-9]+)*")


def _core(line: str) -> str:
    """A line without heading marks, leading number and closing code."""
    if line[:1] in _MAY_LEAD:
        line = _LEADING.sub("", line)
    return _CODE_END.sub("", line) if line.rstrip()[-1:] in _CODE_LAST else line


def _core_shape(core: str | None) -> str | None:
    """The shape of a line without heading marks, leading number and closing code, with other numbers as one sign."""
    if core is None:
        return None
    core = _core(core)
    return skeleton(_FIGURES.sub("#", core) if _DIGIT.search(core) else core)


_NO_HEADER = re.compile("[.。，,;；:：#{}0-9]")
#: Marks that a header of the corpus or of a document does not have.
_SENTENCE_MARKS = re.compile("[.。，,;；:：#{}|]")

LINES = (
    "tab STRING, document_id STRING, page_number INT, part_no INT, line_no INT, kind STRING, "
    "shape STRING, bare BOOLEAN, numbered BOOLEAN, edge BOOLEAN, role STRING"
)


def _hashed(shape: str) -> str:
    """96 bits for a shape of any length, as 16 signs."""
    return base64.b64encode(hashlib.blake2b(shape.encode("utf-8", "surrogatepass"), digest_size=12).digest()).decode()


def lines_of(records: DataFrame, made: dict) -> DataFrame:
    """Split and misread lines, and lines that may be furniture (kind ``edge``), of ``tab, document_id, page_number, part_no, label, text``.

    ``bare`` tells that a shape has none of the marks and numbers that sentences have.
    """
    shared = records.sparkSession.sparkContext.broadcast(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = _reader(shared)
        for b in batches:
            out: list[tuple] = []
            for tab, doc, page, part, label, text in zip(*(c.to_pylist() for c in b.columns)):
                if not text:
                    continue
                lines, split, misread = r.read(text)
                out += [(tab, doc, page, part, i + 1, "hyphen", None, None, None, None, None) for i in split]
                out += [(tab, doc, page, part, i + 1, "misread", None, None, None, None, None) for i in misread]
                for i, s, n, e, role in edge_lines(tab, label, lines, page):
                    bare = s is not None and not _SENTENCE_MARKS.search(s)
                    out.append((tab, doc, page, part, i, "edge", None if s is None else _hashed(s), bare, n, e, role))
            columns = list(zip(*out)) if out else [[]] * 11
            types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [x.split()[0] for x in LINES.split(", ")])

    rows = spread(records.select("tab", "document_id", "page_number", "part_no", "label", "text").where("text IS NOT NULL AND document_id IS NOT NULL"))
    return rows.mapInArrow(run, LINES)


def found(records: DataFrame, publishers: list[str], made: dict | None = None) -> DataFrame:
    """``tab, document_id, page_number, part_no, line_no, kind`` of furniture, split and misread lines.

    ``publishers`` are names that may stand in headers, from a table of fixed size; ``made`` are the ``tables`` of the records, if they are at hand.
    """
    # lines of records delivered twice are there twice: shares are the same, pages and results are counted once
    lines = checkpoint(lines_of(records, made or tables(records)))
    edges = lines.where("kind = 'edge'")
    keys = ["tab", "document_id", "page_number", "part_no", "line_no"]

    # headers of the corpus: shapes that stand nearly always at edges of pages
    native = edges.where("tab = 'native_text_pages' AND shape IS NOT NULL AND role <> 'title'")
    total = native.where("edge").count()
    least = max(HEADER_PAGES, HEADER_SHARE * total)
    within = native.where("bare").groupBy("document_id", "shape").agg(F.count("*").alias("n"), F.sum(F.col("edge").cast("int")).alias("at_edge"), F.countDistinct("page_number").alias("pages"))
    repeated = (
        within.groupBy("shape").agg(F.sum("n").alias("n"), F.sum("at_edge").alias("at_edge"), F.sum("pages").alias("pages"))
        .where(f"at_edge >= {EDGE_SHARE} * n AND pages >= {least}")
        .select("shape")
    )
    own = within.where(f"at_edge >= {EDGE_SHARE} * n AND pages >= {HEADER_PAGES}").select("document_id", "shape")
    headings = edges.where("role = 'heading' AND shape IS NOT NULL").groupBy("shape").agg(F.countDistinct("document_id").alias("d")).where("d > 1").select("shape")
    # at most 1 / HEADER_SHARE shapes of 16 signs: joined by broadcast, as a third of all lines may be page numbers, without shape
    repeated = F.broadcast(repeated.join(headings, "shape", "left_anti"))
    names = sorted({_hashed(_core_shape(one_form(p))) for p in publishers if p and p.strip()})
    known = F.col("shape").isin(names) if names else F.lit(False)

    # shapes at the edge of several pages of one document; its other records, too, are looked at
    own = own.join(headings, "shape", "left_anti").withColumn("is_own", F.lit(True))
    titles = edges.where("role = 'title' AND shape IS NOT NULL").select("document_id", "shape", F.lit(True).alias("is_title"), F.lit(None).cast("boolean").alias("is_own"))
    titles = titles.unionByName(own.withColumn("is_title", F.lit(None).cast("boolean"))).groupBy("document_id", "shape").agg(F.max("is_title").alias("is_title"), F.max("is_own").alias("is_own"))
    marked = edges.where("edge OR tab <> 'native_text_pages' OR role = 'title'").join(titles, ["document_id", "shape"], "left").join(repeated.withColumn("is_header", F.lit(True)), "shape", "left")
    marked = marked.withColumn("may_be", F.col("shape").isNull() | (F.col("role") == "marked") | known | F.col("is_header").isNotNull() | F.col("is_own").isNotNull())
    marked = checkpoint(marked.where("is_title OR may_be"))  # read twice

    # a title on the first page is the heading, unless it is there twice: then the one at the foot, or else the first, is the header
    page = Window.partitionBy("tab", "document_id", "page_number", "part_no")
    place = Window.partitionBy("tab", "document_id", "page_number").orderBy("part_no", "line_no")
    shown = marked.where("is_title").distinct().withColumn("times", F.count("*").over(Window.partitionBy("tab", "document_id", "page_number")))
    shown = shown.withColumn("nth", F.row_number().over(place)).withColumn("foot", F.max(F.expr("role = 'line'")).over(page))
    heading = F.expr(
        "CASE WHEN numbered THEN false WHEN tab = 'parsed_documents' THEN role = 'title' WHEN page_number > 1 THEN role = 'title' AND tab = 'run_pages' "
        "WHEN tab = 'run_pages' THEN role = 'title' OR (times = 1 AND role <> 'marked') WHEN times = 1 THEN true WHEN foot THEN role <> 'line' ELSE nth = 2 END"
    )
    again = shown.where(F.col("edge") | (F.col("tab") != "native_text_pages")).where(~heading).select(*keys)
    plain = marked.where("edge AND role <> 'heading' AND may_be AND (is_title IS NULL OR role = 'marked')").select(*keys)
    furniture = again.unionByName(plain).distinct()
    rest = lines.where("kind <> 'edge'").select(*keys, "kind").join(furniture, keys, "left_anti").distinct()
    return furniture.withColumn("kind", F.lit("furniture")).unionByName(rest)


def repaired(records: DataFrame, publishers: list[str]) -> DataFrame:
    """``tab, document_id, page_number, part_no, text``: each text repaired into continuous paragraphs, without furniture."""
    made = tables(records)
    keys = ["tab", "document_id", "page_number", "part_no"]
    dropped = found(records, publishers, made).where("kind = 'furniture'").groupBy(*keys).agg(F.collect_list("line_no").alias("dropped"))
    shared = records.sparkSession.sparkContext.broadcast(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = _reader(shared)
        for b in batches:
            texts = [None if t is None else r.repair(t, set(d or ())) for t, d in zip(b.column(4).to_pylist(), b.column(5).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(texts, pa.string())], [*keys, "text"])

    # texts are shuffled once: what is delivered twice is dropped in the partitions of the join
    rows = records.select(*keys, "text").join(dropped, keys, "left").dropDuplicates([*keys, "text"]).select(*keys, "text", "dropped")
    return rows.mapInArrow(run, "tab STRING, document_id STRING, page_number INT, part_no INT, text STRING")
