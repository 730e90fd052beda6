import random

import pytest

from quire.llm import tokens

PIECES = ["a", "the", " ", "  ", "\n", "é", "中文", "😀", "ing", "​", "1", "23", "'s", "<|endoftext|>", "aaaa", "\t", "ß", "и", "🇩🇪", "́"]


@pytest.fixture(scope="module")
def loaded():
    return tokens.load()


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_ids_equal_the_library(vocabulary):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"{tokens.TOKENIZERS}/{vocabulary}", "rb"))}
    other = tiktoken.Encoding("own", pat_str=tokens.SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
    automaton, words, split = tokens.load(vocabulary=vocabulary)
    rng = random.Random(5)
    for _ in range(400):
        t = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40)))
        ids = list(tokens._ids(t, words, split))
        assert ids == other.encode_ordinary(t)
        assert automaton.decode(ids) == t


def test_long_word(loaded):
    automaton, words, split = loaded
    t = "ab" * 50_000
    ids = tokens._ids(t, words, split)
    assert automaton.decode(ids) == t and t not in words


def test_only_allowed_paths(loaded):
    automaton, _, _ = loaded
    # "ab" followed by "c" must not be a path where BPE would have merged otherwise: encodings of prefixes are unique
    for w in (b"hello", b" unbelievable", "здравствуйте".encode()):
        ids = automaton.encode(w)
        assert b"".join(automaton.labels[i] for i in ids) == w


def test_defined_results(spark):
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "hi"), (4, "hi"), (None, "x")]
    df = spark.createDataFrame([(*r, [0], "h") for r in rows], "doc_id BIGINT, text STRING, ids ARRAY<INT>, tokens STRING")
    got = [(r["doc_id"], r["ids"]) for r in tokens.encode(df).collect()]
    assert len(got) == 6 and (1, []) in got and (2, []) in got and got.count((4, got[[g[0] for g in got].index(4)][1])) == 2
    assert {(r[0], r[1]) for r in tokens.sizes(df).collect()} >= {(1, 0), (2, 0)}
    assert tokens.encode(df.limit(0)).count() == 0
    assert [r["text"] for r in tokens.decode(tokens.encode(df.where("doc_id = 3"))).collect()] == ["  \n"]
