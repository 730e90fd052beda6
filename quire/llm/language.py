"""Languages of documents and of their paragraphs.

String-kernel classification: a text is the set of its character n-grams of one to four characters
(a blended spectrum of presence), and two texts are as similar as the share of n-grams they have in
common. Landmarks drawn evenly from the sure examples span a Nyström approximation of that kernel, in which one ridge
regression per language is fitted against the rest. Because the kernel is linear in the n-grams, landmark map
and regression collapse into one weight per n-gram and language, and paragraphs are scored in batches by one matrix
product of their presence rows with these weights. A long paragraph is scored by stretches of equal length: its score is the
mean of theirs, and its number of known n-grams their sum, so that both mean the same at any length.

A document's main language is the one with most letters in its paragraphs. Labels are read through a table of codes and
names. Text is brought into one form, and damaged lines are restored, before it is scored.

Defined results: a null or blank content has no language; a document without enough letters to score has a null language, and its label is
not judged; paragraphs without letters, or with too few to differ from the document with confidence, have the document's main
language; ties go to the language first in alphabetical order; rows delivered twice stay in ``paragraphs`` and count once in ``found``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import encoding
from quire.llm.lookalikes import one_form
from quire.partitioning import spread

LONGEST = 4
#: Landmarks of each language at most, drawn by the hash of their text; samples beyond these are fitted, but are no landmarks.
LANDMARKS = 20
#: Characters that the samples may hold.
MOST_CHARACTERS = (1 << 15) - 1
RIDGE = 1e-3
#: Labelled samples that are fitted at most.
MOST_SAMPLES = 20_000
#: Stretches scored by one product.
BATCH = 256
#: A longer text is scored by stretches of so many characters at most, as the presence of n-grams saturates.
STRETCH = 600
_SLOTS = 21
_ODD = np.uint64(0x9E3779B97F4A7C15)

# Names and three-letter codes of the languages, by two-letter code.
NAMES = {
    "zh": "zho chi cmn chinese mandarin 中文 汉语 漢語 chinesisch chinois chino",
    "en": "eng english anglais englisch inglés ingles inglese",
    "de": "deu ger german deutsch allemand alemán aleman tedesco",
    "fr": "fra fre french français francais französisch francés frances francese",
    "es": "spa esp spanish español espanol castellano espagnol spanisch spagnolo",
    "ja": "jpn japanese 日本語 japanisch japonais japonés",
    "ru": "rus russian русский russisch russe ruso",
    "pt": "por portuguese português portugues portugiesisch portugais",
    "it": "ita italian italiano italienisch italien",
}
_BY_NAME = {n: code for code, names in NAMES.items() for n in [code, *names.split()]}


def label_language(label: str | None) -> str | None:
    """The two-letter code that a label names, whatever its spelling; None if it names none of the languages."""
    if not label:
        return None
    name = label.strip().lower()
    return _BY_NAME.get(name) or _BY_NAME.get(re.split(r"[-_\s(,.;]", name, maxsplit=1)[0])


def _characters() -> np.ndarray:
    """Each character's lower-case letter; blanks, digits and signs are one blank."""
    table = np.full(0x110000, 32, np.uint32)
    for o in range(0x30000):
        c = chr(o)
        if c.isalpha():
            table[o] = ord(c.lower()[0])
    return table


_lower: list[np.ndarray] = []


def _points(text: str) -> np.ndarray:
    if not _lower:
        _lower.append(_characters())
    p = _lower[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = np.ones(len(p), bool)
    keep[1:] = (p[1:] != 32) | (p[:-1] != 32)
    return p[keep]


class Model:
    """Weights of each n-gram for each language."""

    def __init__(self, samples: list[tuple[str, str]]):
        samples = sorted({(lang, one_form(text)) for lang, text in samples if lang and text}, key=lambda x: (x[0], hashlib.blake2b(x[1].encode("utf-8", "surrogatepass")).digest()))
        self.languages = sorted({lang for lang, _ in samples})
        points = [_points(f" {t} ") for _, t in samples]
        alphabet = np.unique(np.concatenate(points)) if points else np.empty(0, np.uint32)
        if len(alphabet) > MOST_CHARACTERS:
            raise ValueError(f"the samples hold more than {MOST_CHARACTERS} different characters")
        self.alphabet = alphabet
        self._index_characters()
        sets = [self._grams(p) for p in points]
        taken: dict[str, int] = {}
        landmarks = []
        for i, (lang, _) in enumerate(samples):
            taken[lang] = taken.get(lang, 0) + 1
            if taken[lang] <= LANDMARKS:
                landmarks.append(i)
        keys, seen = np.unique(np.concatenate([sets[i] for i in landmarks]), return_counts=True) if landmarks else (np.empty(0, np.uint64), np.empty(0, int))
        keys = keys[seen >= 2]
        self.size = len(keys)
        self.keys = keys
        self._index_keys()
        rows = np.zeros((len(samples), self.size), np.float32)
        for i, s in enumerate(sets):
            rows[i, np.searchsorted(keys, s[np.isin(s, keys)])] = 1
        rows /= np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))
        marks = rows[landmarks].astype(np.float64)
        if not samples:
            self.weights = np.ones((0, 1), np.float32)
            return
        kernel = marks @ marks.T
        values, vectors = np.linalg.eigh(kernel + 1e-9 * np.eye(len(marks)))
        good = values > 1e-6
        whiten = vectors[:, good] / np.sqrt(values[good])
        phi = rows @ marks.T @ whiten
        target = np.array([[lang == x for x in self.languages] for lang, _ in samples], float)
        solve = np.linalg.solve(phi.T @ phi + RIDGE * np.eye(phi.shape[1]), phi.T @ target)
        self.weights = np.hstack([marks.T @ (whiten @ solve), np.ones((self.size, 1))]).astype(np.float32)

    def _index_characters(self) -> None:
        self.ids = np.zeros(0x110000, np.uint64)
        self.ids[self.alphabet] = np.arange(1, len(self.alphabet) + 1)

    def _index_keys(self) -> None:
        """A table of slots; n-grams that meet another one in their slot are looked up by bisection."""
        slot = self._slot(self.keys)
        _, first = np.unique(slot, return_index=True)
        self.slots = np.full(1 << _SLOTS, -1, np.int32)
        self.slots[slot[first]] = first
        self.others = np.setdiff1d(np.arange(self.size), first)  # in the order of their keys, as these are sorted

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("ids", "slots", "others")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        if hasattr(self, "keys"):
            self._index_characters()
            self._index_keys()

    def _spans(self, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each n: the keys of the n-grams from every place, and where all their characters are known."""
        c = self.ids[points]
        key, ok = c, c > 0
        for n in range(1, LONGEST + 1):
            if n > 1:
                if len(c) < n:
                    return
                key = (key[:-1] << np.uint64(15)) | c[n - 1 :]
                ok = ok[:-1] & (c[n - 1 :] > 0)
            yield key | np.uint64(n) << np.uint64(60), ok

    def _grams(self, points: np.ndarray) -> np.ndarray:
        """The set of n-grams of a text."""
        return np.unique(np.concatenate([key[ok] for key, ok in self._spans(points)]))

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys * _ODD) >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each text in each language, and the number of its n-grams that the model knows."""
        points = [_points(f" {t} ") for t in texts]
        lengths = np.array([len(p) for p in points])
        # texts are parted by a character without an id, so that no n-gram spans two
        joined = np.concatenate([np.append(p, 0) for p in points]).astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), lengths + 1)
        present = np.zeros((len(texts), self.size), np.float32)
        for key, ok in self._spans(joined):
            at = self.slots[self._slot(key)]
            hit = np.flatnonzero(ok & (at >= 0))
            same = self.keys[at[hit]] == key[hit]
            missed, hit = hit[~same], hit[same]
            present[owner[hit], at[hit]] = 1
            if len(self.others) and len(missed):
                place = np.minimum(np.searchsorted(self.keys[self.others], key[missed]), len(self.others) - 1)
                good = self.keys[self.others[place]] == key[missed]
                present[owner[missed[good]], self.others[place[good]]] = 1
        product = present @ self.weights
        known = product[:, -1]
        return product[:, :-1] / np.sqrt(np.maximum(known, 1))[:, None], known

    def classify(self, texts: list[str]) -> list[tuple[np.ndarray, float]]:
        """``scores`` of any number of texts of any length, by batches of stretches."""
        parts = [max(1, -(-len(t) // STRETCH)) for t in texts]
        stretches = [t[len(t) * k // n : len(t) * (k + 1) // n] for t, n in zip(texts, parts) for k in range(n)]
        scored: list[tuple[np.ndarray, float]] = []
        for at in range(0, len(stretches), BATCH):
            scored.extend(zip(*self.scores(stretches[at : at + BATCH])))
        if len(scored) == len(texts):
            return scored
        out, at = [], 0
        for n in parts:
            own = scored[at : at + n]
            at += n
            out.append(own[0] if n == 1 else (np.mean([s for s, _ in own], 0), sum(k for _, k in own)))
        return out


#: A paragraph differs from its document by this score at least, and has so many known n-grams, and so many for each letter.
MARGIN, LEAST_KNOWN, KNOWN_PER_LETTER = 0.45, 24, 0.8
#: Sharpness of the confidence: the share of a language's score among all, as exponents.
SHARPNESS = 8.0


def _letters(text: str) -> int:
    return sum(map(str.isalpha, text))


def languages_of(contents: list[str], model: Model, restorer: encoding.Restorer) -> list[list[tuple[str | None, float]]]:
    """Of each content: its main language and confidence, then those of each paragraph."""
    paragraphs = [one_form(p) for c in contents for p in c.split("\n\n")]
    letters = [_letters(p) for p in paragraphs]
    scored = model.classify(paragraphs)
    garbled = [i for i, ((_, known), n) in enumerate(zip(scored, letters)) if known < n * KNOWN_PER_LETTER and not paragraphs[i].isascii()]
    raw = [p for c in contents for p in c.split("\n\n")] if garbled else []
    mended = [one_form(restorer.restore(raw[i])[0]) for i in garbled]
    for i, text, score in zip(garbled, mended, model.classify(mended)):
        scored[i], letters[i] = score, _letters(text)
    out, at = [], 0
    for c in contents:
        n = c.count("\n\n") + 1
        rows = list(zip(scored[at : at + n], letters[at : at + n]))
        at += n
        weight = np.zeros(len(model.languages))
        for (score, known), size in rows if model.languages else []:
            if known >= LEAST_KNOWN and known >= size * KNOWN_PER_LETTER:
                weight[score.argmax()] += size
        if model.languages and not weight.any():  # only short paragraphs
            for (score, known), size in rows:
                if known >= size * KNOWN_PER_LETTER and size > 1:
                    weight[score.argmax()] += size
        if not model.languages or not weight.any():
            out.append([(None, 0.0)] * (n + 1))
            continue
        main = int(weight.argmax())
        result: list[tuple[str | None, float]] = [(model.languages[main], float(weight[main] / weight.sum()))]
        for (score, known), size in rows:
            best = int(score.argmax())
            if not (score[best] - score[main] >= MARGIN and known >= LEAST_KNOWN and known >= size * KNOWN_PER_LETTER):
                best = main
            share = np.exp(SHARPNESS * (score - score.max()))
            result.append((model.languages[best], float(share[best] / share.sum())))
        out.append(result)
    return out


def paragraphs(contracts: DataFrame, samples: DataFrame) -> DataFrame:
    """``document_id, label, main, para_no, lang, confidence`` of ``contracts`` (``document_id, label, text``): number 0 is the whole content.

    ``samples`` (``lang, text``) are the sure examples, of which ``MOST_SAMPLES`` at most are fitted, drawn by their hash.
    """
    session = contracts.sparkSession
    rows = samples.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL").distinct().orderBy(F.xxhash64("lang", "text"), "lang", "text").limit(MOST_SAMPLES)
    model = Model([(r[0], r[1]) for r in rows.collect()])  # fitted once; the workers get its weights
    shared = session.sparkContext.broadcast((model, encoding.unit_costs(encoding.count_units(contracts))))
    made: list = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            model, costs = shared.value
            made.extend((model, encoding.Restorer(costs)))
        for whole in batches:
            for start in range(0, len(whole), 100):
                b = whole.slice(start, 100)
                contents = b.column(2).to_pylist()
                found = languages_of(contents, *made)
                counts = [len(x) for x in found]
                ids, labels = (np.repeat(b.column(i).to_numpy(zero_copy_only=False), counts) for i in (0, 1))
                flat = [y for x in found for y in x]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.string()),
                        pa.array(labels, pa.string()),
                        pa.array(np.repeat(np.array([x[0][0] for x in found], object), counts), pa.string()),
                        pa.array(np.concatenate([np.arange(n) for n in counts]), pa.int32()),
                        pa.array([x for x, _ in flat], pa.string()),
                        pa.array([x for _, x in flat], pa.float64()),
                    ],
                    ["document_id", "label", "main", "para_no", "lang", "confidence"],
                )

    rows = spread(contracts.select("document_id", "label", "text").where("text IS NOT NULL AND trim(text) <> ''"))
    return rows.mapInArrow(run, "document_id STRING, label STRING, main STRING, para_no INT, lang STRING, confidence DOUBLE")


def found(contracts: DataFrame, samples: DataFrame) -> DataFrame:
    """``document_id, para_no, lang``: contracts with a missing or wrong label, and paragraphs in another language than the main one."""
    spelled = F.create_map(*[F.lit(x) for pair in _BY_NAME.items() for x in pair])
    low = F.lower(F.trim("label"))
    named = F.coalesce(F.try_element_at(spelled, low), F.try_element_at(spelled, F.regexp_replace(low, r"[-_\s(,.;].*$", "")))
    rows = paragraphs(contracts, samples)
    wrong = F.col("para_no").eqNullSafe(0) & (named.isNull() | (named != F.col("lang")))
    other = (F.col("para_no") > 0) & (F.col("lang") != F.col("main"))
    return rows.where("lang IS NOT NULL").where(wrong | other).select("document_id", "para_no", "lang").distinct()
