import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import packing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=12))
def test_plan_places_every_item_once(histogram):
    bins, fitted = packing.plan(histogram, [8, 16, 64])
    placed: Counter = Counter()
    for b, c in zip(bins, fitted):
        assert b.used <= c
        assert all(smaller < b.used for smaller in (8, 16, 64) if smaller < c)
        for size, each in b.contents:
            placed[size] += each * b.count
    assert placed == Counter(histogram)


def check(rows, sizes, capacities):
    """No container is overfull, no item is split unless it must be, and all tokens are placed."""
    used: Counter = Counter()
    caps = {}
    for doc, piece, tokens, container, capacity in rows:
        used[container] += tokens
        caps.setdefault(container, capacity)
        assert caps[container] == capacity
    assert all(used[c] <= caps[c] for c in used)
    pieces: dict = {}
    for doc, piece, tokens, *_ in rows:
        pieces.setdefault(doc, []).append(tokens)
    for doc, n in sizes:
        assert sum(pieces[doc]) == (n or 0) and len(pieces[doc]) == max(1, -(-(n or 0) // max(capacities)))
    return sum(caps.values())


def test_fill(spark):
    rng = random.Random(3)
    sizes = [(i, rng.choice([0, None, 5, 5, 5, 17, 100, 130, rng.randint(1, 99)])) for i in range(3000)]
    df = spark.createDataFrame([(*s, 1, 2) for s in sizes], "doc_id BIGINT, tokens BIGINT, rank INT, part INT")
    rows = [tuple(r) for r in packing.fill(df, [16, 32, 100]).collect()]
    total = check(rows, sizes, [16, 32, 100])
    tokens = sum(n or 0 for _, n in sizes)
    assert total <= 1.01 * tokens


def test_fill_against_brute_force(spark):
    sizes = [(1, 6), (2, 5), (3, 5), (4, 4)]
    rows = [tuple(r) for r in packing.fill(spark.createDataFrame(sizes, "doc_id BIGINT, tokens BIGINT"), [10]).collect()]
    assert check(rows, sizes, [10]) == 20  # the optimum


def test_empty_and_zero(spark):
    schema = "doc_id BIGINT, tokens BIGINT"
    assert packing.fill(spark.createDataFrame([], schema), [8]).count() == 0
    rows = packing.fill(spark.createDataFrame([(1, 0), (2, None), (None, 0)], schema), [8]).collect()
    assert len(rows) == 3 and all(r["container_id"] is None and r["tokens"] == 0 for r in rows)


def test_one_size_holds_a_third(spark):
    sizes = [(i, 7) for i in range(2000)] + [(5000 + i, 1 + i % 50) for i in range(4000)]
    rows = [tuple(r) for r in packing.fill(spark.createDataFrame(sizes, "doc_id BIGINT, tokens BIGINT"), [64, 256]).collect()]
    check(rows, sizes, [64, 256])


def test_bins_are_opened_by_the_cost_of_an_item():
    bins, fitted = packing.plan({6: 1, 5: 2, 3: 2}, [6, 10])  # one preferred capacity gives 24 or 26
    assert sum(c * b.count for c, b in zip(fitted, bins)) == 22


def test_each_opening_weighs_all_capacities():
    histogram = {300: 50, 700: 40, 212: 60, 1848: 10, 100: 30, 12: 200}
    bins, fitted = packing.plan(histogram, [512, 2048, 8192])
    placed: dict = {}
    for b in bins:
        assert b.used <= b.room
        for size, each in b.contents:
            placed[size] = placed.get(size, 0) + each * b.count
    assert placed == histogram and packing.gap(histogram, bins, fitted) < 0.02
    assert packing.gap({512: 7, 2048: 3}, *packing.plan({512: 7, 2048: 3}, [512, 2048])) == 0
    assert packing.plan({}, [512]) == ([], []) and packing.gap({}, [], []) == 0
