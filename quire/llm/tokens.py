"""Encoding with a public byte-level BPE vocabulary by a compiled automaton.

The automaton's arcs carry tokens, its paths are the token sequences that BPE can give. It starts
as one state that accepts every sequence of byte tokens; then every merge ``u v`` is applied in
rank order by a gadget: the target of the ``u`` arcs is replaced by a copy without its ``v`` arc, and
every state with a ``u`` arc gets an arc ``uv`` to the old target of ``v``. A copy stores only what it lost,
so the compiled automaton has a constant size per merge. A byte trie of the labels drives the
encoding of pre-split words: from each reached position the labels that begin there are followed, and
the one that the automaton allows after the last arc is the only one that can end where it ends.

Defined results: a null or empty text has the empty list of ids; a blank text has the ids of its
blanks; strings that look like special tokens are ordinary text; repeated rows stay repeated.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quire.partitioning import spread

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"

# Fixed value: the pattern that splits text before the merges.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Words kept with their ids per worker; when full, the store is emptied and filled anew.
WORD_STORE = 400_000
#: Answers of the automaton kept per worker; when full, they are forgotten.
ANSWER_STORE = 2_000_000
#: Longer words are encoded each time.
WORD_LENGTH = 200


class MergeAutomaton:
    """The automaton of one vocabulary, ``labels[id]`` being the bytes of each token in rank order."""

    def __init__(self, labels: list[bytes]):
        self.labels = labels
        n = len(labels)
        # a state is a lineage and a time; a lineage has lost arcs at times, and starts from a state of another lineage
        self._lost: list[dict[int, int]] = [{}]
        self._start: list[tuple[int, int]] = [(-1, -1)]
        self._from: list[int] = [-1]
        self._own: dict[int, int] = {}
        self._target: list[tuple[int, int]] = [(0, -1)] * n
        self._left = [-1] * n
        self._known: dict[tuple[int, int, int], bool] = {}
        self._next: dict[int, int] = {}
        self._label: list[int] = [-1]
        singles = sorted((i for i in range(n) if len(labels[i]) == 1))
        for i in singles:
            self._add_label(i)
        for i in range(n):
            if len(labels[i]) > 1:
                u, v = self.encode(labels[i])
                self._gadget(u, v, i)
                self._add_label(i)

    def _add_label(self, token: int) -> None:
        node = 0
        for byte in self.labels[token]:
            key = node << 8 | byte
            node = self._next.get(key, -1)
            if node < 0:
                node = self._next[key] = len(self._label)
                self._label.append(-1)
        self._label[node] = token

    def _gadget(self, u: int, v: int, uv: int) -> None:
        at = self._target[v]
        lineage = self._own.get(u)
        if lineage is None:
            lineage = self._own[u] = len(self._lost)
            self._lost.append({})
            self._start.append(self._target[u])
            self._from.append(uv)
        self._lost[lineage][v] = uv
        self._target[u] = (lineage, uv)
        self._target[uv] = at
        self._left[uv] = u

    def allows(self, lineage: int, time: int, token: int) -> bool:
        """Whether the state has an arc with this label."""
        key = (lineage, time, token)
        known = self._known.get(key)
        if known is None:
            if len(self._known) >= ANSWER_STORE:
                self._known.clear()
            known = self._known[key] = self._find(lineage, time, token)
        return known

    def _find(self, lineage: int, time: int, token: int) -> bool:
        while lineage > 0:
            if self._lost[lineage].get(token, time + 1) <= time:
                return False
            if self._left[token] >= 0 and self._from[lineage] <= token:
                # the arc was given to this state when the token arose, if it had the left part's arc then
                time = min(time, token)
                token = self._left[token]
            else:
                lineage, time = self._start[lineage]
        return True

    def encode(self, word: bytes) -> tuple[int, ...]:
        """The ids on the only path whose labels spell ``word``."""
        n = len(word)
        step, label, target, known, allows = self._next, self._label, self._target, self._known, self.allows
        last = [-1] * (n + 1)
        for start in range(n):
            if start:
                if last[start] < 0:
                    continue
                lineage, time = target[last[start]]
            else:
                lineage, time = 0, -1
            node, i = 0, start
            while i < n:
                node = step.get(node << 8 | word[i], -1)
                if node < 0:
                    break
                i += 1
                token = label[node]
                if token >= 0 and last[i] < 0:
                    if lineage == 0:
                        last[i] = token
                    else:
                        ok = known.get((lineage, time, token))
                        if allows(lineage, time, token) if ok is None else ok:
                            last[i] = token
        out = []
        while n:
            out.append(last[n])
            n -= len(self.labels[last[n]])
        return tuple(reversed(out))

    def decode(self, ids) -> str:
        """The labels of the arcs, as text; ids of whole texts give the text back."""
        return b"".join([self.labels[i] for i in ids]).decode("utf-8", errors="replace")


class _Words(dict):
    """Ids of the words met so far."""

    def __init__(self, automaton: MergeAutomaton):
        self.automaton = automaton

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.automaton.encode(word.encode("utf-8", errors="surrogatepass"))
        if len(word) <= WORD_LENGTH:
            if len(self) >= WORD_STORE:
                self.clear()
            self[word] = ids
        return ids


_loaded: dict[bytes, tuple] = {}


def read_vocabulary(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> bytes:
    """The vocabulary file, which the driver alone needs to have."""
    with open(f"{folder}/{vocabulary}", "rb") as f:
        return f.read()


def compiled(content: bytes) -> tuple[MergeAutomaton, _Words, regex.Pattern]:
    """The automaton of a vocabulary file, its word store and the split pattern; compiled once in each Python worker."""
    key = hashlib.blake2b(content).digest()
    if key not in _loaded:
        ranks = sorted((int(b), base64.b64decode(a)) for a, b in map(bytes.split, content.splitlines()))
        automaton = MergeAutomaton([x for _, x in ranks])
        _loaded[key] = automaton, _Words(automaton), regex.compile(SPLIT_PATTERN)
    return _loaded[key]


def load(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> tuple[MergeAutomaton, _Words, regex.Pattern]:
    """``compiled`` of a file at hand."""
    return compiled(read_vocabulary(folder, vocabulary))


def _ids(text: str | None, words: _Words, split: regex.Pattern) -> np.ndarray:
    if not text:
        return np.empty(0, np.int32)
    return np.fromiter(itertools.chain.from_iterable(map(words.__getitem__, split.findall(text))), np.int32)


def encode(documents: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids``: the token ids of each text."""
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(folder, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, words, split = compiled(shared.value)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                ids = [_ids(t, words, split) for t in part.column(1).to_pylist()]
                ends = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=ends[1:])
                values = pa.array(np.concatenate(ids)) if ids else pa.array([], pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(ends), values)
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "ids"])

    return spread(documents.select("doc_id", "text")).mapInArrow(run, "doc_id BIGINT, ids ARRAY<INT>")


def sizes(documents: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, tokens``: the number of token ids of each text."""
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(folder, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, words, split = compiled(shared.value)
        get = words.__getitem__
        for batch in batches:
            counts = [sum(map(len, map(get, split.findall(t)))) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["doc_id", "tokens"])

    return spread(documents.select("doc_id", "text")).mapInArrow(run, "doc_id BIGINT, tokens BIGINT")


def decode(encoded: DataFrame, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``; a null list stays null, an empty one gives the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(folder, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, _, _ = compiled(shared.value)
        for batch in batches:
            texts = [None if x is None else automaton.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id BIGINT, text STRING")
