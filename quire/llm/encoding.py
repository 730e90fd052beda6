"""Finding and restoring text that was decoded with the wrong character encoding.

A noisy channel: the corpus gives the frequencies of its words with letters beyond ASCII, of
neighbouring characters of scripts written without spaces, and of other signs between their neighbours'
classes. A line costs the sum of its units' code lengths. Where a line holds rare units, also in the
consistent form of look-alike characters, or bytes like those of UTF-8, its stretches are turned back into bytes under each
known decoding; lost bytes (U+FFFD) become wildcards. Bytes that decode are read so; the byte lattice of others is read in each known
encoding by exact Viterbi search over all characters the corpus knows. A second Viterbi search, over the stretches of the line, parts it into right
and damaged spans under one decoder and encoding, by the word frequencies of what stands there and of what is read. If the cheapest reading
saves enough bits and holds more known words, its spans are damaged and are replaced; nothing outside them is touched. The
search is repeated on the result for text that was decoded wrongly twice. A line with a lost byte is damaged even
if nothing can be read from it.

A lost letter or sign, in any encoding or in a line that is right otherwise, is read by the whole word: the known words, ASCII ones
among them, and signs that fit the stretch between white space are compared, and U+FFFD stays where none fits or two are about as likely.

The unit table holds units with a share of at least ``MIN_SHARE`` of all, thus at most ``1 / MIN_SHARE`` of them whatever the size
of the corpus, and is counted over all texts. Stretches that are valid UTF-8 under some decoder are not counted, and words that are a commoner
one in the wrong encoding are left out, so that the damage of a large source does not pass for what texts are written with.

Defined results: a null text stays null and is not damaged; an empty or blank one is not damaged; a record that is delivered
twice counts once in ``found``; lines without a cheaper reading stay as they are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.checkpoint import checkpoint
from quire.llm.lookalikes import FOLDS, one_form
from quire.partitioning import spread

MIN_SHARE = 2e-6
#: The least share of a sign between its neighbours, or of a word of one letter; they are few, so misreadings give the same ones again and again.
MIN_SIGN_SHARE = 2e-4
#: Bits by which a reading must be cheaper than the text as it stands.
GAIN = 12.0
GAIN_UTF8 = 4.0
#: Bits of a unit that the table lacks, and of each of its characters beyond the first.
UNKNOWN, UNKNOWN_MORE = 22.0, 2.0
#: A line is looked at if a unit has so many bits; a sign of fewer bits is common.
RARE, COMMON_SIGN = 15.0, 11.0
#: Bits more of a character in an unspaced script that makes no known pair with the one before.
UNPAIRED = 8.0
#: Bits of a byte that no character explains.
BAD_BYTE = 20.0
#: Bits by which the reading of a lost letter or sign must be cheaper than any other, and of one that stands between blanks.
MARGIN, MARGIN_ALONE = 1.0, 8.0
#: Bits of passing from right to damaged text or back inside a line.
SWITCH = 3.0
#: Bits by which another pair of an unspaced script must be cheaper for a pair to be taken as its misreading.
PAIR_GAIN = 6.0
#: Bits that a search may save at a bad and at a lost byte against plain decoding; and by which a reading of one stretch may cost more than in another encoding, as a line has one.
ROOM, ROOM_LOST, SLACK = 8.0, 50.0, 20.0

# Character ranges of alphabets beyond ASCII, and of scripts written without spaces.
ALPHABETS = "À-ÖØ-öø-ʯ̀-ͯͰ-߿Ḁ-῿"
UNSPACED = "⺀-⿟々-〇〡-〩぀-ヿㄅ-ㄯ㐀-鿿가-힯豈-﫿ｦ-ﾟ"
# Decoders by which text may have been misread, and encodings it may have had.
MISREAD_AS = ("cp1252", "latin-1", "cp1251", "mac_roman", "cp437", "cp850", "koi8-r", "cp866", "cp932", "gbk", "big5", "euc_jp", "euc_kr", "cp1250", "iso8859-15", "iso8859-5", "iso8859-2", "mac_cyrillic")
WRITTEN_AS = (
    "utf-8", "cp1252", "cp1251", "gbk", "cp932", "euc_jp", "big5", "koi8-r", "mac_roman", "cp437", "cp850", "cp866", "cp1250", "iso8859-15", "iso8859-5", "iso8859-2", "mac_cyrillic", "euc_kr",
)
# Signs that may stand beside a damaged word in another encoding's text.
_NEUTRAL = set("’‘“”„«»‹›–—…•·、。，；：（）「」")
_ASCII = set(map(chr, range(128)))
# Signs that stand inside words.
INSIDE_WORDS = "’‘\xad‐‑–²³"
_WIDEST = {"utf-8": 4, "gbk": 2, "cp932": 2, "euc_jp": 3, "big5": 2, "euc_kr": 2}

_PARTS = re.compile(f"[{UNSPACED}]+|[A-Za-z{ALPHABETS}]+|[^\x00-\x7f]")
#: No language writes words of accented Latin letters alone.
_NO_WORD = re.compile("[À-ÖØ-öø-ɏ]{4,}")
_LETTER = re.compile(f"[A-Za-z{ALPHABETS}]")
_IDEOGRAM = re.compile(f"[{UNSPACED}]")
LOST = "�"
_BEYOND_LOST = re.compile(f"[^\x00-\x7f{LOST}]")
#: Characters that stand for a set of letters and signs while a line is read.
_OPEN = "\U000f0000"
_LOST_STRETCH = re.compile(f"\\S*[{LOST}{_OPEN}-\U000ffffd]\\S*")
_LOST_RUN = re.compile(f"[A-Za-z{ALPHABETS}{LOST}{_OPEN}-\U000ffffd]+")
#: Blanks between stretches; those set between the characters of an unspaced script part nothing.
_BLANKS = re.compile(f"((?<![{UNSPACED}，。；：、（）℃0-9%.])[ \t]+|[ \t]+(?![{UNSPACED}，。；：、（）℃0-9%.]))")
_BEYOND = re.compile("[^\x00-\x7f]+")
_UTF8 = re.compile(
    rb"[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|\xed[\x80-\x9f][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|\xf4[\x80-\x8f][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}"
)
_UTF8_OR_BYTE = re.compile(_UTF8.pattern + rb"|[\x00-\xff]")
#: What texts of the known scripts are made of.
_USUAL = re.compile(f"[\x00-\x7f¡-¿À-ž{UNSPACED}Ѐ-џ\u2010-\u2044\u2103\u2116\u3000-\u3020\uff01-\uff5e]*")
_ASCII_WORD = re.compile(f"(?<![{ALPHABETS}A-Za-z])[A-Za-z]+(?![{ALPHABETS}A-Za-z])")


def _utf8_like() -> set[str]:
    """Pairs of characters, and characters of two bytes, whose bytes under some decoder begin a sequence of UTF-8."""
    out: set[str] = set()
    for decoder in MISREAD_AS:
        if decoder in _WIDEST:
            for b in range(0xC2, 0xF5):
                for x in range(0x80, 0xC0):
                    out.update(bytes([b, x]).decode(decoder, "ignore")[:1])
        else:
            lead, more = (
                [bytes([x]).decode(decoder, "ignore") or chr(x) for x in range(a, z)] for a, z in ((0xC2, 0xF5), (0x80, 0xC0))
            )
            out.update(a + z for a in lead for z in more)
    return out


_LIKE_UTF8 = _utf8_like()


def _side(c: str) -> str:
    if not c:
        return "e"
    if c.isdigit():
        return "d"
    if _LETTER.match(c):
        return "a"
    return "c" if _IDEOGRAM.match(c) else "p"


def units(token: str) -> list[str]:
    """The units beyond ASCII of a stretch without white space."""
    out: list[str] = []
    for m in _PARTS.finditer(token):
        s = m.group()
        c = s[0]
        if _IDEOGRAM.match(c):
            if len(s) > 1:
                out.extend(map("".join, zip(s, s[1:])))
            else:
                a, z = m.span()
                out.append(_side(token[a - 1 : a]) + c + _side(token[z : z + 1]))
        elif len(s) > 1 or _LETTER.match(c):
            if not s.isascii():
                out.append(s)
        else:
            a, z = m.span()
            out.append(_side(token[a - 1 : a]) + c + _side(token[z : z + 1]))
    return out


def counted(token: str) -> list[str]:
    """The units of a stretch without white space and its words in ASCII; none if its bytes under some decoder are valid UTF-8 of usual characters, as damage is no evidence of what texts are written with."""
    found = _ASCII_WORD.findall(token)
    if token.isascii():
        return found
    return [] if _misread_utf8(token) else found + units(token)


def _misread_utf8(token: str) -> bool:
    m = _BEYOND.search(token)
    if m.group()[:2] not in _LIKE_UTF8 and m.group()[0] not in _LIKE_UTF8:
        return False
    for decoder in MISREAD_AS:
        if decoder in _WIDEST:  # of several bytes each: some may be lost
            text = token.encode(decoder, "ignore").decode("utf-8", "replace")
            good = len(_BEYOND_LOST.findall(text))
            if good >= 2 and 3 * text.count(LOST) <= good:
                return True
            continue
        try:
            text = token.encode(decoder).decode()
        except UnicodeError:
            continue
        if _USUAL.fullmatch(text):
            return True
    return False


def count_units(texts: DataFrame, column: str = "text") -> DataFrame:
    """``unit, n``: how often each unit, and each word in ASCII, occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def emit() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["unit", "n"])
            total.clear()
            return batch

        for b in batches:
            tokens: Counter = Counter()
            for t in b.column(0).to_pylist():
                if t:
                    tokens.update(t.split())
            for token, n in tokens.items():
                if token.isalpha() and token.isascii():
                    total[token] += n
                else:
                    for u in counted(token):
                        total[u] += n
            if len(total) > 300_000:
                yield emit()
        if total:
            yield emit()

    return spread(texts.select(column)).mapInArrow(run, "unit STRING, n BIGINT").groupBy("unit").agg(F.sum("n").alias("n"))


def is_sign(unit: str) -> bool:
    """Whether a unit is one character between its neighbours' classes."""
    return len(unit) == 3 and unit[0] in "eadcp" and unit[2] in "eadcp" and not _PARTS.fullmatch(unit)


def _natural(unit: str, share: float) -> bool:
    """Whether a unit with this share of all is one that texts are written with."""
    if is_sign(unit):
        c = unit[1]
        if c == LOST or unit[0] == unit[2] == "a" and c not in INSIDE_WORDS:
            return False
        return share >= (MIN_SHARE if _IDEOGRAM.match(c) else MIN_SIGN_SHARE)
    if unit.isascii():
        return share >= MIN_SHARE
    if any(ord(c) in FOLDS for c in unit) or _NO_WORD.fullmatch(unit):
        return False
    return share >= (MIN_SHARE if len(unit) > 1 else MIN_SIGN_SHARE)


def costs_of(counts: dict[str, int], total: int) -> dict[str, float]:
    """Bits of each unit that is common enough for its kind."""
    return {u: -math.log2(n / total) for u, n in counts.items() if _natural(u, n / total)}


def without_misreadings(costs: dict[str, float]) -> dict[str, float]:
    """The table without words and pairs that are a commoner one, read in the wrong single step between two encodings.

    So damage that fills a share of the corpus does not pass for what texts are written with. A word of an alphabet counts from four
    letters on; a pair of an unspaced script, which may be so by chance, if the other is ``PAIR_GAIN`` bits cheaper.
    """
    doubted = [u for u in costs if not u.isascii() and not is_sign(u) and len(u) >= (2 if _IDEOGRAM.match(u) else 4)]
    dropped: set[str] = set()
    for decoder in MISREAD_AS:
        data = []
        for u in doubted:
            try:
                data.append((u, u.encode(decoder)))
            except UnicodeEncodeError:
                pass
        for encoding in WRITTEN_AS:
            if encoding == decoder:
                continue
            for u, b in data:
                other = costs.get(b.decode(encoding, "replace"))
                if other is not None and other + (PAIR_GAIN if _IDEOGRAM.match(u) else 0.0) < costs[u]:
                    dropped.add(u)
    return {u: bits for u, bits in costs.items() if u not in dropped}


def unit_costs(counts: DataFrame) -> dict[str, float]:
    """Bits of each unit with a share of ``MIN_SHARE`` or more, and likewise of each word in ASCII: at most ``1 / MIN_SHARE`` of either."""
    counts = checkpoint(counts.withColumn("plain", F.expr("octet_length(unit) = length(unit)")))  # read twice
    out: dict[str, float] = {}
    totals = {r["plain"]: r["n"] for r in counts.groupBy("plain").agg(F.sum("n").alias("n")).collect()}
    for plain, total in totals.items():
        rows = counts.where((F.col("plain") == plain) & (F.col("n") >= max(2, MIN_SHARE * total))).collect()
        out.update(costs_of({r["unit"]: r["n"] for r in rows}, total))
    return without_misreadings(out)


def _two_best(bits: dict[str, float]) -> dict[str, float]:
    return dict(sorted(bits.items(), key=lambda x: (x[1], x[0]))[:2]) if len(bits) > 2 else bits


class Restorer:
    """Readings of damaged lines under a table of unit costs."""

    def __init__(self, costs: dict[str, float]):
        self.costs = costs
        characters: dict[str, float] = {}
        self._after: dict[str, dict[str, float]] = {}
        self._before: dict[str, list[str]] = {}
        self._words: dict[int, list[str]] = {}
        self._beside: dict[tuple[str, str], list[tuple[str, float]]] = {}
        around: dict[tuple[str, str], float] = {}
        for u, bits in costs.items():
            if is_sign(u):
                around[u[0], u[2]] = around.get((u[0], u[2]), 0.0) + 2.0**-bits
        for u, bits in costs.items():
            sign = is_sign(u)
            if not u.isascii():
                for c in u[1] if sign else u:
                    if c != LOST and bits < characters.get(c, 1e9):
                        characters[c] = bits
            if sign:
                self._beside.setdefault((u[0], u[2]), []).append((u[1], bits + math.log2(around[u[0], u[2]])))  # among the signs that stand so
            elif _IDEOGRAM.match(u):
                if len(u) == 2:
                    self._after.setdefault(u[0], {})[u[1]] = bits
                    self._before.setdefault(u[1], []).append(u[0])
            else:
                self._words.setdefault(len(u), []).append(u)
        self.characters = characters
        self.known = set(characters) | {chr(i) for i in range(128)}
        self._masks: dict[str, dict[tuple, list[str]]] = {}
        self._arcs: dict[tuple, tuple[dict[str, float], str, float]] = {}
        self._open: dict[str, str] = {}
        self._sets: list[set[str]] = []
        self._filled: dict[tuple, str] = {}
        self._options: dict[str, dict] = {}
        self._singles: dict[str, dict] = {}
        self._giving: dict[str, int] = {}
        self._tokens: dict[str, tuple[float, int, int, int, float]] = {}
        signs = {u for u in costs if is_sign(u)}
        self._common = {u for u in signs if costs[u] <= COMMON_SIGN and (u[0] != "a" or u[1] in "²³")}
        self._wordlike = {u for u in costs if len(u) > 1 and u not in signs}
        self._alphabet: dict[str, set[str]] = {}

    def measure(self, text: str) -> tuple[float, int, int, int, float]:
        """Of the units beyond ASCII: their bits, the number of known words and pairs, of unknown units, of common signs, and the bits of the rarest."""
        bits, known, unknown, common, rarest = 0.0, 0, 0, 0, 0.0
        for token in text.split():
            if not token.isascii():
                x = self._tokens.get(token) or self._measure_token(token)
                bits += x[0]
                known += x[1]
                unknown += x[2]
                common += x[3]
                if x[4] > rarest:
                    rarest = x[4]
        return bits, known, unknown, common, rarest

    def _measure_token(self, token: str) -> tuple[float, int, int, int, float]:
        found = units(token)
        bits = [*map(self.costs.get, found)]
        unknown = bits.count(None)
        if unknown:
            bits = [UNKNOWN + UNKNOWN_MORE * (len(u) - 1) if x is None else x for u, x in zip(found, bits)]
        out = sum(bits), sum(map(self._wordlike.__contains__, found)), unknown, sum(map(self._common.__contains__, found)), max(bits, default=0.0)
        if len(token) < 30:
            if len(self._tokens) > 200_000:
                self._tokens.clear()
            self._tokens[token] = out
        return out

    def _explained(self, line: str) -> bool:
        """Whether the line's unknown units are look-alike characters of known words."""
        for token in line.split():
            if not token.isascii() and self.measure(token)[2]:
                form = one_form(token)
                if self.measure(form)[2] or any(len(w) > 2 and w not in self.costs and w.lower() not in self.costs for w in _ASCII_WORD.findall(form)):
                    return False
        return True

    def suspicious(self, line: str) -> bool:
        """Whether the line holds a unit that the table lacks."""
        return self.measure(line)[2] > 0

    def _bytes(self, line: str, decoder: str) -> list[int | None] | None:
        """The line's bytes under a decoder, None for lost ones; None if it cannot have come from the decoder."""
        out: list[int | None] = []
        for i, part in enumerate(line.split(LOST)):
            if i:
                out.append(None)
            try:
                out.extend(part.encode(decoder))
            except UnicodeEncodeError:
                if decoder not in ("cp1252", "cp1251", "cp1250"):
                    return None
                for c in part:  # bytes without a character there may have been kept as control characters
                    try:
                        out.extend(c.encode(decoder))
                    except UnicodeEncodeError:
                        if not 0x80 <= ord(c) <= 0x9F:
                            return None
                        out.append(ord(c))
        return out

    def _decoders(self, c: str) -> int:
        """The decoders that can have given a character beyond ASCII, as bits."""
        known = self._giving.get(c)
        if known is None:
            known = self._giving[c] = -1 if c == LOST else sum(1 << i for i, d in enumerate(MISREAD_AS) if self._bytes(c, d) is not None)
        return known

    def _spans(self, token: str, rich: bool, known: int, unknown: int) -> dict[tuple, list[str]]:
        """The token as maximal stretches that can have come from a decoder, as bytes (with None for lost ones), and the text between them, with the decoders; by whether they are of several bytes, too.

        Parts of a token are sought in scripts without blanks only; every unknown unit must lie in one, as what stands between them is right. Such a token of known pairs for the most part is not damaged throughout.
        """
        beyond = set(token) - _ASCII
        whole = part = -1
        for c in beyond:
            whole &= self._decoders(c)
        if rich and (unknown or LOST in token):
            for u in units(token.replace(LOST, " ")):
                if u not in self.costs and not (is_sign(u) and u[1] in self.characters):  # a known sign may only have got another neighbour
                    bits = 0
                    for c in u:
                        if c >= "\x80":
                            bits |= self._decoders(c)
                    part &= bits
        else:
            part = 0
        mostly = rich and known > 3 * unknown and LOST not in token
        if mostly:
            whole = 0
        groups: dict[tuple, list[str]] = {}
        for i, decoder in enumerate(MISREAD_AS):
            if whole >> i & 1:
                spans: list = [tuple(self._bytes(token, decoder))]
            elif part >> i & 1 and not (mostly and decoder in _WIDEST):
                spans = []
                for c in token:
                    own = (ord(c),) if c < "\x80" else tuple(self._bytes(c, decoder)) if self._decoders(c) >> i & 1 else None
                    kind = str if own is None else tuple
                    if spans and type(spans[-1]) is kind:
                        spans[-1] += c if own is None else own
                    else:
                        spans.append(c if own is None else own)
                if not any(type(x) is tuple for x in spans) or LOST not in token and max((sum(y >= 0x80 for y in x) for x in spans if type(x) is tuple), default=0) < 2:
                    continue  # a single sign beside right text is no evidence
            else:
                continue
            groups.setdefault((tuple(spans), decoder in _WIDEST), []).append(decoder)
        return groups

    def _matching(self, pattern: tuple, encoding: str) -> list[str]:
        """All known characters whose bytes fit a pattern with wildcards; a lost byte is none of ASCII."""
        masks = self._masks.get(encoding)
        if masks is None:
            masks = self._masks[encoding] = {}
            for c in sorted(self.characters, key=self.characters.get):
                try:
                    b = c.encode(encoding)
                except UnicodeEncodeError:
                    continue
                for bits in range(1, 1 << len(b)):
                    masks.setdefault(tuple(None if bits >> i & 1 else x for i, x in enumerate(b)), []).append(c)
        return masks.get(pattern, [])

    def _arc(self, pattern: tuple, encoding: str) -> tuple[dict[str, float], str, float]:
        """Of a pattern: its characters of unspaced scripts with their bits, one character that stands for all others, and its bits."""
        arc = self._arcs.get((pattern, encoding))
        if arc is None:
            fitting = self._matching(pattern, encoding)
            unspaced = {c: self.characters[c] for c in fitting if _IDEOGRAM.match(c)}
            others = "".join(sorted(c for c in fitting if c not in unspaced))
            if others and others not in self._open:
                self._open[others] = chr(ord(_OPEN) + len(self._sets))
                self._sets.append(set(others))
            arc = self._arcs[pattern, encoding] = unspaced, self._open.get(others, ""), min((self.characters[c] for c in others), default=0.0)
        return arc

    def _decode(self, piece: list[int | None], encoding: str) -> str:
        """The one character that the bytes are, or nothing."""
        if None not in piece:
            try:
                c = bytes(piece).decode(encoding)
            except UnicodeDecodeError:
                return ""
            if len(c) == 1 and c < _OPEN:
                return c
        return ""

    def read(self, data: Sequence[int | None], encoding: str, kept: str | None = None) -> tuple[str, float]:
        """The cheapest reading of a byte lattice, and the bits of what it could not explain.

        A character of which no byte is left is read only by a known pair with a neighbour that has bytes left. ``kept`` are the
        characters as they stand, if each came from one byte: a byte that nothing explains keeps its own; otherwise it is lost.
        """
        if None not in data:
            try:
                return bytes(data).decode(encoding), 0.0
            except UnicodeDecodeError:
                pass
        n, widest = len(data), _WIDEST.get(encoding, 1)
        # of each place and last character: bits, place and last character before
        states: list[dict[str, tuple[float, int, str]]] = [{} for _ in range(n + 1)]
        states[0][""] = (0.0, -1, "")
        single, after = self.characters.get, self._after
        for at in range(n):
            here = states[at]
            if not here:
                continue
            cheapest = min(here, key=lambda c: here[c][0])
            base = here[cheapest][0]
            # the cheapest before a character that makes no known pair with it
            apart = min(here, key=lambda c: here[c][0] + (UNPAIRED if _IDEOGRAM.match(c) else 0.0))
            unpaired = here[apart][0] + (UNPAIRED if _IDEOGRAM.match(apart) else 0.0)

            def reach(end: int, c: str, bits: float, last: str) -> None:
                old = states[end].get(c)
                if old is None or bits < old[0]:
                    states[end][c] = (bits, at, last)

            for width in range(1, min(widest, n - at) + 1):
                piece, end = data[at : at + width], at + width
                if None not in piece:
                    c = self._decode(piece, encoding)
                    if c:
                        own = 0.0 if c < "\x80" else single(c, UNKNOWN)
                        if _IDEOGRAM.match(c):
                            reach(end, c, unpaired + own, apart)
                            for last in self._before.get(c, ()):
                                if last in here:
                                    reach(end, c, here[last][0] + min(own, after[last][c]), last)
                        else:
                            reach(end, c, base + own, cheapest)
                        if piece[0] < 0x80 and width == 1:
                            break
                    continue
                unspaced, others, own = self._arc(tuple(piece), encoding)
                if others:
                    reach(end, others, base + own, cheapest)
                if not unspaced:
                    continue
                if any(x is not None for x in piece):
                    for c, own in unspaced.items():
                        reach(end, c, unpaired + own, apart)
                else:
                    following = [self._decode(data[end : end + w], encoding) for w in range(1, widest + 1)]
                    for c in {c for d in following for c in self._before.get(d, ())} & unspaced.keys():
                        reach(end, c, unpaired + unspaced[c], apart)
                for last, (bits, since, _) in here.items():
                    pairs = after.get(last)
                    if pairs and (any(x is not None for x in piece) or any(x is not None for x in data[since:at])):
                        few, many = (pairs, unspaced) if len(pairs) < len(unspaced) else (unspaced, pairs)
                        for c in few:
                            if c in many:
                                reach(end, c, bits + min(pairs[c], unspaced[c]), last)
            stay = LOST if kept is None or data[at] is None else "\0" + kept[at]
            reach(at + 1, stay, base + BAD_BYTE, cheapest)
        last = min(states[n], key=lambda c: states[n][c][0])
        out, at = [], n
        while at > 0:
            out.append(last)
            _, at, last = states[at][last]
        bad = sum(c[:1] == "\0" and len(c) > 1 for c in out)
        text = "".join(c[-1] if c[:1] == "\0" else c for c in reversed(out))
        text = _LOST_STRETCH.sub(lambda m: self._fill_stretch(m.group()), text)
        return text, BAD_BYTE * (bad + text.count(LOST))

    def fill(self, text: str) -> str:
        """The text with the lost letters and signs that a known word, or a sign's neighbours, settle; others are U+FFFD."""
        # characters beyond _OPEN that the text itself has stand for no set
        return _LOST_STRETCH.sub(lambda m: m.group() if max(m.group()) >= _OPEN else self._fill_stretch(m.group()), text)

    def _fill_stretch(self, token: str) -> str:
        rest = [c for c in token if self._fitting(c) is None]
        if not self.known.issuperset(rest):  # damage of another kind
            return "".join(c if self._fitting(c) is None else LOST for c in token)

        def run(m: re.Match) -> str:
            piece = m.group()
            if piece.isalpha():  # nothing is lost
                return piece
            a, z = m.span()
            key = piece, _side(token[a - 1 : a]), _side(token[z : z + 1])
            filled = self._filled.get(key)
            if filled is None:
                options = sorted((bits, text) for text, bits in self._fillings(*key).items())
                margin = MARGIN_ALONE if key[1] == key[2] == "e" and len(piece) == 1 else MARGIN
                clear = options and (len(options) == 1 or options[1][0] - options[0][0] >= margin)
                filled = options[0][1] if clear else "".join(LOST if self._fitting(c) is not None else c for c in piece)
                if len(self._filled) > 100_000:
                    self._filled.clear()
                self._filled[key] = filled
            return filled

        return _LOST_RUN.sub(run, token)

    def _fitting(self, c: str) -> set[str] | None:
        """The characters a lost one may be; an empty set for any beyond ASCII, None if it is not lost."""
        return set() if c == LOST else self._sets[ord(c) - ord(_OPEN)] if c >= _OPEN else None

    def _fillings(self, piece: str, left: str, right: str) -> dict[str, float]:
        """The two cheapest readings of a stretch of letters and lost characters between two classes of neighbours, with their bits: known words, parted by known signs.

        Bits add up, so that the two best of the whole are made of the two best of its parts.
        """
        sets = [self._fitting(c) for c in piece]
        n = len(piece)
        ends: list[dict[str, float]] = [{} for _ in range(n + 1)]  # readings of what is left from each place
        ends[n][""] = 0.0
        for i in range(n - 1, -1, -1):
            out = ends[i]
            out.update(self._words_like(piece[i:], sets[i:], n == 1 and left != "c" != right))
            for p in range(i, n):
                if sets[p] is None:
                    continue
                sides = left if p == 0 else "a", right if p == n - 1 else "a"
                if not sets[p] and "c" in sides:
                    continue  # it may be a character of the unspaced script
                if not ends[p + 1]:
                    continue
                before = {"": 0.0} if p == i else _two_best(self._words_like(piece[i:p], sets[i:p], False))
                signs = {c: bits for c, bits in self._beside.get(sides, ()) if (c in sets[p] if sets[p] else not _IDEOGRAM.match(c)) and not c.isascii()}
                for c, bits in _two_best(signs).items():
                    for x, own in before.items():
                        for y, rest in ends[p + 1].items():
                            if own + bits + rest < out.get(x + c + y, 1e9):
                                out[x + c + y] = own + bits + rest
            ends[i] = _two_best(out)
        return ends[0]

    def _words_like(self, piece: str, sets: list[set[str] | None], alone: bool) -> dict[str, float]:
        """Known words that fit, with their bits; in capitals also if the table has them in small letters.

        A word of which no letter is left is one only if it has one letter and stands ``alone``.
        """
        lost = [k for k, x in enumerate(sets) if x is not None]
        if not lost:
            bits = self.costs.get(piece, self.costs.get(piece.lower()))
            return {} if bits is None else {piece: bits}
        if len(lost) == len(piece) and not alone:
            return {}
        out: dict[str, float] = {}
        intact = [(k, c) for k, c in enumerate(piece) if sets[k] is None]
        capitals = len(intact) > 1 and all(c.isupper() for _, c in intact)
        capital = bool(intact) and intact[0][0] == 0 and intact[0][1].isupper()
        for w in self._words.get(len(piece), ()):
            if w.isascii():
                continue
            forms = (w, w.upper()) if capitals else (w, w[0].upper() + w[1:]) if capital else (w,)
            for form in forms:
                if len(form) == len(piece) and all(form[k] == c for k, c in intact) and all(form[k] in sets[k] if sets[k] else form[k] >= "\x80" for k in lost):
                    if self.costs[w] < out.get(form, 1e9):
                        out[form] = self.costs[w]
        return out

    def _read_plainly(self, data: tuple, encoding: str, decoder: str) -> tuple:
        """A stretch of bytes read in an encoding without a search, the bits of what is unexplained, and whether it is valid UTF-8 throughout; less if it cannot be
        read so: empty if a search would not help either, of one part else."""
        lost = None in data
        if encoding not in _WIDEST:
            text = bytes([0 if x is None else x for x in data] if lost else data).decode(encoding, "replace")
            if lost:
                if LOST in text:
                    return ()  # of bytes that are there
                text = "".join([LOST if x is None else c for x, c in zip(data, text)])
            if not self.known.issuperset(text.replace(LOST, "") if lost else text):
                return ()
            if lost:
                text = self.fill(text)
            return text, BAD_BYTE * text.count(LOST), False
        if lost:
            return (None,)
        raw = bytes(data)
        try:
            text = raw.decode(encoding)
        except UnicodeDecodeError:
            if encoding == "utf-8" and decoder not in _WIDEST and _UTF8.search(raw):  # valid sequences among right letters of the decoder
                text = "".join([x.decode() if len(x) > 1 else self._alone(x, decoder) for x in _UTF8_OR_BYTE.findall(raw)])
                if self.known.issuperset(text):
                    return text, 0.0, False
            return (None,)
        if encoding == "utf-8":
            return text, 0.0, True
        return (text, 0.0, False) if self.known.issuperset(text) else ()

    def _least(self, data: tuple, encoding: str) -> float:
        """About the least bits that a reading of the lattice costs: those of its plain decoding, in which a lost byte is a sign or goes with the next byte, less ``ROOM`` for each bad byte and ``ROOM_LOST`` for each lost one."""
        least, lost = math.inf, sum(x is None for x in data)
        for width in (1, 2) if lost else (1,):
            plain, skip = [], 0
            for x in data:
                skip = width if x is None else max(0, skip - 1)
                plain.append(63 if skip else x)
            text = bytes(plain).decode(encoding, "replace")
            if lost or any(c >= "\x80" and c in self.characters for c in text):
                bad = text.count(LOST)
                least = min(least, self.measure(text.replace(LOST, ""))[0] + (BAD_BYTE - (0.0 if encoding == "utf-8" else ROOM)) * bad - ROOM_LOST * lost)
        return least

    def _lattice(self, data: tuple, encoding: str, decoder: str) -> tuple[str, float]:
        kept = None
        if decoder not in _WIDEST:
            kept = "".join("?" if x is None else self._alone(bytes([x]), decoder) for x in data)
        return self.read(data, encoding, kept)

    @staticmethod
    def _alone(byte: bytes, decoder: str) -> str:
        try:
            return byte.decode(decoder)
        except UnicodeDecodeError:
            return chr(byte[0])

    def _valid_utf8(self, line: str) -> dict[tuple[str, str], str]:
        """By decoder, the readings of a line whose bytes are valid UTF-8 throughout."""
        out = {}
        for decoder in MISREAD_AS:
            data = self._bytes(line, decoder)
            if data is not None:
                try:
                    text = bytes(data).decode()
                except UnicodeDecodeError:
                    continue
                out[decoder, "utf-8"] = text
        return out

    def options(self, token: str) -> dict[tuple[str, str], tuple]:
        """Of a stretch without blanks: by decoder and encoding its reading, with bits, known words, unknown units, common signs, and whether it is valid UTF-8.

        Only maximal stretches that the decoder can have given are read; what stands between them stays as it is.
        """
        found = self._options.get(token)
        if found is not None:
            return found
        found = {}
        bits, known, unknown, _, _ = self.measure(token.replace(LOST, ""))
        present = bits + BAD_BYTE * token.count(LOST)
        rich = _IDEOGRAM.search(token) is not None
        narrow = not rich and LOST not in token
        groups, options = self._spans(token, rich, known, unknown), {}
        best, searched = self._add_single(token, found) if narrow else math.inf, []
        for (spans, wide), decoders in groups.items():
            for encoding in _WIDEST if narrow and not wide else WRITTEN_AS:
                if decoders == [encoding]:
                    continue
                read = [(x, 0.0, None) if type(x) is str else self._read_plainly(x, encoding, decoders[0]) for x in spans]
                if () in read:
                    continue
                if (None,) not in read:
                    best = min(best, self._note(found, options, token, read, decoders, encoding))
                else:
                    least = sum(self._least(x, encoding) for x, r in zip(spans, read) if r == (None,))
                    if least + GAIN <= present:
                        searched.append((least, len(searched), spans, read, decoders, encoding))
        for least, _, spans, read, decoders, encoding in sorted(searched):  # the likeliest first
            if least > best + SLACK:
                break
            read = [(*self._lattice(x, encoding, decoders[0]), False) if r == (None,) else r for x, r in zip(spans, read)]
            best = min(best, self._note(found, options, token, read, decoders, encoding))
        if rich and unknown >= 6 and LOST not in token:
            self._add_stretches(token, found)
        if len(token) < 40:
            if len(self._options) > 50_000:
                self._options.clear()
            self._options[token] = found
        return found

    def _note(self, found: dict, options: dict, token: str, read: list, decoders: list[str], encoding: str) -> float:
        """Adds a reading of the token; its bits."""
        text = "".join([x[0] for x in read])
        if text == token:
            return math.inf
        key = text, sum([x[1] for x in read]), all([x[2] for x in read])
        option = options.get(key)
        if option is None:
            option = options[key] = self._option(*key)
        for decoder in decoders:
            if decoder != encoding:
                found[decoder, encoding] = option
        return option[1]

    def _option(self, text: str, spoiled: float, valid: bool) -> tuple:
        bits, known, unknown, common, _ = self.measure(text.replace(LOST, ""))
        return text, bits + spoiled, known, unknown, common, valid

    def _add_single(self, token: str, found: dict) -> float:
        """Adds readings between encodings of one byte a character; the bits of the best."""
        beyond = set(token) - _ASCII
        maps = sorted((self._single(c) for c in beyond), key=len)
        best, options = math.inf, {}
        for pair in maps[0]:
            if pair != "c" and all(pair in m for m in maps):
                text = token.translate({ord(m["c"]): m[pair] for m in maps})
                if text == token:
                    continue
                option = options.get(text)
                if option is None:
                    option = options[text] = self._option(text, 0.0, False)
                    best = min(best, option[1])
                found[pair] = option
        return best

    def _single(self, c: str) -> dict:
        """What a character is by decoder and encoding, where both have one byte for a character; signs of punctuation that a decoder lacks stay."""
        known = self._singles.get(c)
        if known is None:
            known = self._singles[c] = {"c": c}
            for decoder in MISREAD_AS:
                if decoder in _WIDEST:
                    continue
                data = self._bytes(c, decoder)
                for encoding in WRITTEN_AS:
                    if encoding in _WIDEST or encoding == decoder:
                        continue
                    if data is None:
                        if c in _NEUTRAL:
                            known[decoder, encoding] = c
                    else:
                        other = bytes(data).decode(encoding, "replace")
                        if other in self.known:
                            known[decoder, encoding] = other
        return known

    def _add_stretches(self, token: str, found: dict) -> None:
        """Adds readings of the stretch of unknown pairs inside a token that is right elsewhere, where its characters took several bytes each."""
        odd = [i for i, (c, d) in enumerate(zip(token, token[1:])) if _IDEOGRAM.match(c) and _IDEOGRAM.match(d) and c + d not in self.costs]
        if not odd or 2 * len(odd) < odd[-1] - odd[0] + 1:
            return
        for decoder in _WIDEST:
            if decoder == "utf-8":
                continue
            for a in range(max(0, odd[0] - 1), min(odd[0] + 3, len(token))):
                for z in {*range(max(a + 2, odd[-1] - 1), min(odd[-1] + 3, len(token)) + 1), len(token)}:
                    try:
                        data = token[a:z].encode(decoder)
                    except UnicodeEncodeError:
                        continue
                    for encoding in WRITTEN_AS:
                        if encoding == decoder:
                            continue
                        try:
                            text = data.decode(encoding)
                        except UnicodeDecodeError:
                            continue
                        if self.known.issuperset(text):
                            option = self._option(token[:a] + text + token[z:], 0.0, False)
                            old = found.get((decoder, encoding))
                            if old is None or option[1] < old[1]:
                                found[decoder, encoding] = option

    def restore_once(self, line: str, again: bool = True, utf8_only: bool = False) -> tuple[str, float]:
        """The cheapest reading of the line, and how many bits it saves.

        For each decoder and encoding the line is parted into right and damaged spans by Viterbi search over its stretches without
        blanks; a span begins and ends at ``SWITCH`` bits. Bytes that are valid UTF-8 throughout are evidence enough of a reading that
        saves ``GAIN_UTF8`` bits. Any other must save ``GAIN`` bits and either hold more known words and pairs than the line and no
        more unknown units, or more common signs (where the whole line is damaged, or sequences of UTF-8 are read), fewer unknown units and no fewer known words. The reading of a line with lost
        bytes must hold a known word or pair. Characters outside damaged spans stay as they are.
        """
        parts = _BLANKS.split(line)
        places = [i for i in range(0, len(parts), 2) if not parts[i].isascii()]
        own = []
        for i in places:
            t = parts[i]
            lost = t.count(LOST)
            bits, known, unknown, common, rarest = self.measure(t.replace(LOST, "") if lost else t)
            own.append((t, bits + BAD_BYTE * lost, known, unknown, common, rarest))
        present = sum(x[1] for x in own)
        known, unknown, signs = (sum(x[k] for x in own) for k in (2, 3, 4))
        if again and unknown >= 3 and LOST not in line:
            whole = self._whole(line, present, known, unknown)
            if whole is not None:
                return whole
        hopes: set[tuple[str, str]] = set()
        for (t, bits, _, odd, _, rarest) in () if utf8_only else own:
            if odd or rarest >= RARE or LOST in t:
                hopes.update(pair for pair, x in self.options(t).items() if x[1] < bits)
        lost = LOST in line
        best, least, twice = line, present, set()
        done = set()
        if utf8_only:
            hopes = set(self._valid_utf8(line))
        for pair in sorted(hopes):
            chosen, whole, valid = self._spans_of([(x, self.options(x[0]).get(pair)) for x in own])
            if chosen is None:
                continue
            key = tuple(x[0] for x in chosen)
            if key in done:
                continue
            done.add(key)
            got = sum(x[1] for x in chosen)
            more, less, common = (sum(x[k] for x in chosen) for k in (2, 3, 4))
            text = None
            if valid and again and pair[1] == "utf-8":
                text = self._with(parts, places, chosen)
                twice.add(text)
            if got >= least:
                continue
            # a line with lost bytes has more characters, and so more chance pairs, than its reading
            better = (more > known or lost and more > 0) and less <= unknown or less < unknown and more >= known and (whole and common > signs and (not less or pair[0] not in _WIDEST) or pair[1] == "utf-8")
            if got + GAIN_UTF8 <= present if valid else got + GAIN <= present and better:
                best, least = text or self._with(parts, places, chosen), got
        for once in twice:
            text, _ = self.restore_once(once, again=False)
            got, more, less, _, _ = self.measure(text)
            if text is not once and got < least and more > known and less <= unknown:
                best, least = text, got
        return best, present - least

    def _whole(self, line: str, present: float, known: int, unknown: int) -> tuple[str, float] | None:
        """The cheapest reading of a line that is damaged throughout, if it leaves no unknown unit, and the bits it saves; there is no better one then."""
        best, least, done = None, present - GAIN, set()
        for decoder in MISREAD_AS:
            data = self._bytes(line, decoder)
            if data is None or (raw := bytes(data)) in done:
                continue
            done.add(raw)
            for encoding in WRITTEN_AS:
                try:
                    text = raw.decode(encoding)
                except UnicodeDecodeError:
                    continue
                if encoding != decoder and self.known.issuperset(text):
                    got, more, less, _, _ = self.measure(text)
                    if less == 0 and more > known and got < least:
                        best, least = text, got
        return None if best is None else (best, present - least)

    @staticmethod
    def _with(parts: list[str], places: list[int], chosen: list[tuple]) -> str:
        out = list(parts)
        for i, x in zip(places, chosen):
            out[i] = x[0]
        return "".join(out)

    @staticmethod
    def _spans_of(choices: list[tuple[tuple, tuple | None]]) -> tuple[list[tuple] | None, bool, bool]:
        """The cheapest parting into right and damaged spans, nothing if none is damaged; whether all is damaged; and valid UTF-8, which is preferred."""
        if all(y is not None and y[5] for _, y in choices):
            return [y for _, y in choices], True, True
        right, damaged, back = 0.0, 0.0, []
        for x, y in choices:
            to_right = (right, False) if right <= damaged + SWITCH else (damaged + SWITCH, True)
            to_damaged = (damaged, True) if damaged <= right + SWITCH else (right + SWITCH, False)
            right, damaged = to_right[0] + x[1], to_damaged[0] + y[1] if y is not None else math.inf
            back.append((to_right[1], to_damaged[1]))
        mode = damaged < right
        chosen, count = [], 0
        for (x, y), (from_right, from_damaged) in zip(reversed(choices), reversed(back)):
            chosen.append(y if mode else x)
            count += mode
            mode = from_damaged if mode else from_right
        return (chosen[::-1], count == len(choices), False) if count else (None, False, False)

    def _like_utf8(self, line: str) -> bool:
        """Whether the first character beyond ASCII and the next one can be the bytes of UTF-8 under some decoder."""
        m = _BEYOND.search(line)
        return m is not None and (m.group()[:2] in _LIKE_UTF8 or m.group()[0] in _LIKE_UTF8)

    def restore_line(self, line: str) -> tuple[str, bool]:
        """The restored line, and whether it was damaged."""
        if line.isascii():
            return line, False
        utf8_only = False
        if LOST not in line:
            _, _, unknown, _, rarest = self.measure(line)
            utf8_only = rarest < RARE or not unknown or self._explained(line)
            if utf8_only:  # what it holds is known, so that only bytes of UTF-8 are evidence
                present = self.measure(line)[0]
                if not self._like_utf8(line) or not any(self.measure(t)[0] + GAIN_UTF8 <= present for t in self._valid_utf8(line).values()):
                    return line, False
        damaged = LOST in line
        for _ in range(3):
            text, gain = self.restore_once(line, utf8_only=utf8_only)
            if text is line or LOST in line and gain < GAIN:
                break
            line, damaged = text, True
            if not self.suspicious(line):
                break
        return self.fill(line) if LOST in line else line, damaged

    def damaged(self, text: str | None) -> bool:
        """Whether any line is damaged."""
        if not text or text.isascii():
            return False
        return any(self.restore_line(x)[1] for x in text.split("\n"))

    def restore(self, text: str | None) -> tuple[str | None, int]:
        """The text with its damaged lines restored, and their number."""
        if not text or text.isascii():
            return text, 0
        lines = [self.restore_line(x) for x in text.split("\n")]
        return "\n".join(x for x, _ in lines), sum(d for _, d in lines)


_restorer_of: list[tuple[int, Restorer]] = []


def _restorer(shared) -> Restorer:
    """The Restorer of a broadcast table, built once in each Python worker."""
    costs = shared.value
    if not _restorer_of or _restorer_of[0][0] != id(costs):
        _restorer_of[:] = [(id(costs), Restorer(costs))]
    return _restorer_of[0][1]


def _table(records: DataFrame):
    """The corpus's unit table for all workers; its size is bounded by ``MIN_SHARE``."""
    return records.sparkSession.sparkContext.broadcast(unit_costs(count_units(records)))


def found(records: DataFrame) -> DataFrame:
    """``tab, document_id, page_number`` of each record (``tab, document_id, page_number, text``) with a damaged line."""
    shared = _table(records)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = _restorer(shared)
        for b in batches:
            yield b.select(["tab", "document_id", "page_number"]).filter(pa.array([r.damaged(t) for t in b.column(3).to_pylist()], pa.bool_()))

    rows = spread(records.select("tab", "document_id", "page_number", "text").where("text IS NOT NULL"))
    return rows.mapInArrow(run, "tab STRING, document_id STRING, page_number INT").distinct()


def restored(records: DataFrame) -> DataFrame:
    """``records`` with ``restored``, the text with its damaged lines restored where possible, and ``damaged_lines``, their number."""
    shared = _table(records)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = _restorer(shared)
        for b in batches:
            out = [r.restore(t) for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([t for t, _ in out], pa.string()), pa.array([n for _, n in out], pa.int32())],
                ["tab", "document_id", "page_number", "restored", "damaged_lines"],
            )

    rows = spread(records.select("tab", "document_id", "page_number", "text"))
    return rows.mapInArrow(run, "tab STRING, document_id STRING, page_number INT, restored STRING, damaged_lines INT")
