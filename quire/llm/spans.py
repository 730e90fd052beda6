"""Long exact spans shared between records.

Compact windows: the tokens of a text are its overlapping grams of ``GRAM`` characters, each with a random
64-bit hash. In the Cartesian tree of these hashes every node stands for the subsequences of which it is the minimum;
the nodes that span a whole window of ``SPAN`` characters group all windows of that length by
their min-hash, about two groups per window length. They are found for a whole batch at once, by
doubling minima. Equal windows have equal minima, so one hash function finds every shared span.

Groups whose min-hash occurs in one record only are dropped. Of the rest, a group that occurs
as a whole in another record is shared as a whole; of the others the windows are
compared one by one by 96 bits of two hashes, with two records standing for all that hold a group whole. All comparisons are aggregates (least and greatest record of a key), so no pair of
records is ever formed, and equal keys combine before they are shuffled.

Defined results: records with a null id or text, or one shorter than the span, share nothing; a span repeated inside one
record only is not shared; rows with the same id count as one record; touching stretches are one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.checkpoint import checkpoint
from quire.partitioning import spread

SPAN = 200
GRAM = 140
#: Characters hashed at once; a longer text is hashed by itself.
CHUNK = 1 << 20

#: Bases of two independent hashes: 64 bits of the first and 32 of the second tell stretches apart.
_BASE, _CHECK_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_state: dict[str, np.ndarray] = {}


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2^64."""
    up, down = f"up {base}", f"down {base}"
    if up not in _state or len(_state[up]) < n:
        for name, factor in ((up, base), (down, pow(base, -1, 1 << 64))):
            p = np.full(max(n, CHUNK + 1), factor, np.uint64)
            p[0] = 1
            _state[name] = np.multiply.accumulate(p)
    return _state[up][:n], _state[down][:n]


def _values(base: int) -> np.ndarray:
    """A random number for each character."""
    name = f"values {base}"
    if name not in _state:
        _state[name] = _mix(_mix(np.arange(0x110000, dtype=np.uint64) * np.uint64(base) + np.uint64(12345)) + np.uint64(base))
    return _state[name]


class Hashes:
    """Prefix sums from which the hash of any stretch of the joined texts follows in one step."""

    def __init__(self, texts: list[str]):
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.n = len(points)
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.sums, self.down = self._sums(points, _BASE)
        self.check_sums, self.check_down = self._sums(points, _CHECK_BASE)

    def _sums(self, points: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
        up, down = _powers(self.n + 1, base)
        sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_values(base)[points] * up[: self.n], out=sums[1:])
        return sums, down

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def check(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """32 more bits of the same stretches."""
        h = _mix((self.check_sums[end] - self.check_sums[start]) * self.check_down[start] + (end - start).astype(np.uint64))
        return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def grams(self, k: int) -> np.ndarray:
        return _mix((self.sums[k:] - self.sums[:-k]) * self.down[: self.n - k + 1])


def window_groups(texts: list[str], span: int = SPAN, gram: int = GRAM):
    """Of each maximal group of windows with one min-hash: text number, first and last window start, min-hash, hash of the covered stretch and its check."""
    h = Hashes(texts)
    empty = np.empty(0, np.int64)
    if h.n < span:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64), empty.astype(np.int32)
    width = span - gram + 1
    m, reach = h.grams(gram), 1
    while reach * 2 <= width:
        m = np.minimum(m[:-reach], m[reach:])
        reach *= 2
    if width - reach:
        m = np.minimum(m[: reach - width], m[width - reach :])
    full = h.lengths >= span
    inside = np.zeros(len(m) + 1, np.int32)
    np.add.at(inside, h.starts[full], 1)
    np.add.at(inside, h.ends[full] - span + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    begins = np.ones(len(m), bool)
    begins[1:] = m[1:] != m[:-1]
    begins[h.starts[full]] = True
    at = np.flatnonzero(begins & inside)
    text = np.searchsorted(h.ends, at, side="right")
    last = np.minimum(np.append(at[1:], len(m)) - 1, h.ends[text] - span)
    return text, at - h.starts[text], last - h.starts[text], m[at], h.of(at, last + span), h.check(at, last + span)


def _chunks(ids: list, texts: list, *more: list) -> Iterator[tuple]:
    """Rows in runs of about CHUNK characters."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield ids[begin:i], texts[begin:i], *(m[begin:i] for m in more)
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield ids[begin:], texts[begin:], *(m[begin:] for m in more)


def groups(documents: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``doc_id, first, last, h, whole, checked``: the window groups of all records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in _chunks(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text, first, last, h, whole, checked = window_groups(texts, span, gram)
                doc = np.array(ids, np.int64)[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(checked)],
                    ["doc_id", "first", "last", "h", "whole", "checked"],
                )

    rows = documents.select("doc_id", "text").where(f"doc_id IS NOT NULL AND length(text) >= {span}")
    return spread(rows).mapInArrow(run, "doc_id BIGINT, first INT, last INT, h BIGINT, whole BIGINT, checked INT")


def _in_several(df: DataFrame, *key: str) -> DataFrame:
    """The keys that occur in more than one record, with two of the records, ``a`` and ``z``."""
    return df.groupBy(*key).agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z")


def _windows(rows: DataFrame, span: int) -> DataFrame:
    """``doc_id, first, window, checked``: start, hash and check of every window of the stretches ``parts`` of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = (b.column(i).to_pylist() for i in range(4))
            for ids, texts, firsts, lasts in _chunks(*columns):
                h = Hashes(texts)
                counts = [sum(z - a + 1 for a, z in zip(x, y)) for x, y in zip(firsts, lasts)]
                start = np.concatenate([np.arange(a, z + 1) for x, y in zip(firsts, lasts) for a, z in zip(x, y)])
                at = start + np.repeat(h.starts, counts)
                doc = np.repeat(np.array(ids, np.int64), counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), pa.array(start.astype(np.int32)), pa.array(h.of(at, at + span).view(np.int64)), pa.array(h.check(at, at + span))], ["doc_id", "first", "window", "checked"]
                )

    return rows.select("doc_id", "text", "firsts", "lasts").mapInArrow(run, "doc_id BIGINT, first INT, window BIGINT, checked INT")


def merged(stretches: DataFrame) -> DataFrame:
    """Overlapping and touching stretches ``doc_id, first, end`` of a record joined into ``doc_id, span_start, span_end``."""
    order = Window.partitionBy("doc_id").orderBy("first", "end")
    return (
        stretches.withColumn("reached", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("no", F.sum(F.expr("IF(first <= reached, 0, 1)")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "no")
        .agg(F.min("first").cast("long").alias("span_start"), F.max("end").cast("long").alias("span_end"))
        .drop("no")
    )


def shared_spans(documents: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``doc_id, span_start, span_end``: the maximal runs of characters that lie in a stretch of at least ``span`` characters
    found verbatim in another record."""
    found = groups(documents, span, gram)
    candidates = checkpoint(found.join(_in_several(found, "h"), "h", "left_semi"))
    flagged = candidates.join(_in_several(candidates, "h", "whole", "checked"), ["h", "whole", "checked"], "left")
    entire = flagged.where("a IS NOT NULL").selectExpr("doc_id", "first", f"last + {span} AS end")
    # of a group that is shared as a whole, two records stand for all where others may share a part of it
    partly = flagged.where("a IS NULL")
    standing = flagged.where("doc_id IN (a, z)").join(partly.select("h"), "h", "left_semi")
    parts = (
        partly.select("doc_id", "first", "last")
        .unionByName(standing.select("doc_id", "first", "last"))
        .groupBy("doc_id")
        .agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    )
    texts = documents.select("doc_id", "text").where(f"length(text) >= {span}")
    windows = _windows(texts.join(parts, "doc_id"), span)
    single = windows.join(_in_several(windows, "window", "checked"), ["window", "checked"], "left_semi").selectExpr("doc_id", "first", f"first + {span} AS end")
    return merged(entire.unionByName(single))


def shares(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, n_chars, shared_chars, share``: how much of each record is shared; a record without text has null ``share``."""
    of = spans.groupBy("doc_id").agg(F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars"))
    sizes = documents.groupBy("doc_id").agg(F.max(F.length("text")).cast("long").alias("n_chars"))
    return sizes.join(of, "doc_id", "left").select(
        "doc_id", "n_chars", F.coalesce("shared_chars", F.lit(0)).alias("shared_chars"),
        (F.coalesce("shared_chars", F.lit(0)) / F.expr("nullif(n_chars, 0)")).alias("share"),
    )
