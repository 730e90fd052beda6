import random

import numpy as np
import pytest

from quire.llm import spans


def brute(rows, span):
    first, several = {}, set()
    for i, t in rows:
        if i is None or t is None:
            continue
        for a in range(len(t) - span + 1):
            if first.setdefault(t[a : a + span], i) != i:
                several.add(t[a : a + span])
    out = set()
    for i, t in rows:
        shared = [False] * len(t or "")
        for a in range(len(t or "") - span + 1):
            if i is not None and t[a : a + span] in several:
                shared[a : a + span] = [True] * span
        start = None
        for p, x in enumerate([*shared, False]):
            if x and start is None:
                start = p
            elif not x and start is not None:
                out.add((i, start, p))
                start = None
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choices("abcdефг中文\n é😀", k=rng.randint(10, 90))) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choices("abcd 中", k=rng.randint(0, 60))) for _ in range(rng.randint(1, 6))]
        rows.append((i, "".join(parts)))
    rows += [(100 + i, passages[0] * 3) for i in range(30)]  # a third are copies
    rows += [(200, "ab" * 60), (201, "ab" * 40), (202, "x" * 70), (203, ("q" * 25 + passages[1]) * 4)]
    df = spark.createDataFrame([(*r, "h", 0) for r in rows], "doc_id BIGINT, text STRING, h STRING, first INT")
    got = {tuple(r) for r in spans.shared_spans(df, span=30, gram=15).collect()}
    assert got == brute(rows, 30)


def test_defined_results(spark):
    t = "".join(random.Random(9).choices("abcdefgh", k=250))
    rows = [(1, t), (1, t), (2, None), (None, t), (3, ""), (4, t[:199])]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert spans.shared_spans(df).count() == 0  # rows of one id are one record
    both = df.unionByName(spark.createDataFrame([(5, "zz" + t + "yy")], df.schema))
    found = spans.shared_spans(both)
    assert {tuple(r) for r in found.collect()} == {(1, 0, 250), (5, 2, 252)}
    share = {r["doc_id"]: r["share"] for r in spans.shares(both, found).collect()}
    assert share[1] == 1.0 and share[2] is None and share[4] == 0.0
    assert spans.shared_spans(df.limit(0)).count() == 0


def test_long_text(spark):
    t = "".join(random.Random(4).choices("abcdefghij ", k=1_200_000))
    df = spark.createDataFrame([(1, t), (2, t[300_000:900_000])], "doc_id BIGINT, text STRING")
    assert {tuple(r) for r in spans.shared_spans(df).collect()} == {(1, 300_000, 900_000), (2, 0, 600_000)}


def test_groups_are_the_wide_nodes_of_the_cartesian_tree():
    rng = random.Random(2)
    text = "".join(rng.choices("abcdef", k=400))
    _, first, last, h, _, _ = spans.window_groups([text], span=40, gram=20)
    grams = spans.Hashes([text]).grams(20)
    width = 21
    want = [(int(grams[i : i + width].argmin()) + i) for i in range(len(text) - 39)]
    covered = np.concatenate([np.arange(a, z + 1) for a, z in zip(first, last)])
    assert (covered == np.arange(len(text) - 39)).all()
    assert all(grams[want[i]] == h[np.searchsorted(first, i, side="right") - 1] for i in range(len(want)))
