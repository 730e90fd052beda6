"""Filling containers of a few permitted capacities with items of whole sizes.

Variable-capacity best fit over the histogram of sizes. Sizes are whole and at most the largest
capacity, so the histogram has at most that many entries whatever the number of items, and equal items
and equal bins are placed as one. Sizes are taken in falling order. At every opening all permitted capacities are weighed: each is filled
with the largest items left that fit, and the one that costs least, thus leaves the least share of itself unused, is opened, as often as the
items last. At the end each bin is downsized to the smallest capacity that holds its contents. Plain best fit with one
capacity preferred throughout is planned beside it, and the cheapest plan is kept; no plan can take less than the sum of all sizes, and
``gap`` tells by how much the plan exceeds it. Items are then
matched with the plan's slots by their rank among the items of their size, found by a two-step count in which
no group of equal sizes is held by one task.

Defined results: an item above the largest capacity is cut into pieces of that capacity and a rest; any
other has one piece. An item of size 0 has one piece and gets a container by its key, as it needs no room (null
where no container is open); null sizes count as 0. Repeated rows are items of their own.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Parts into which the items of one size are ranked apart at least, and pieces of a part at most if all items have one size.
RANK_PARTS, PART_PIECES = 64, 500_000


@dataclass
class Bins:
    """``count`` equal bins with the same contents."""

    room: int
    count: int
    contents: list[tuple[int, int]] = field(default_factory=list)  # size, items of it per bin

    @property
    def used(self) -> int:
        return sum(s * m for s, m in self.contents)


def best_fit(histogram: dict[int, int], opening: dict[int, int]) -> list[Bins]:
    """Best fit in falling order of size; ``opening`` gives the capacity to open for each size."""
    by_room: dict[int, list[Bins]] = {}
    rooms: list[int] = []
    closed: list[Bins] = []

    def put(b: Bins) -> None:
        if b.room == 0:
            closed.append(b)
            return
        if b.room not in by_room:
            by_room[b.room] = []
            bisect.insort(rooms, b.room)
        by_room[b.room].append(b)

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                group = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
            else:
                room = opening[size]
                group = Bins(room, -(-left // (room // size)))
            each = min(room // size, max(1, left // group.count))
            take = min(group.count, left // each)
            if take < group.count:
                put(Bins(group.room, group.count - take, list(group.contents)))
            put(Bins(group.room - each * size, take, [*group.contents, (size, each)]))
            left -= take * each
    return closed + [b for r in rooms for b in by_room[r]]


def least_cost(histogram: dict[int, int], capacities: list[int]) -> list[Bins]:
    """Bins opened one kind after another, each of the capacity that leaves the least share unused when it is filled with the largest items left that fit."""
    left = dict(histogram)
    sizes = sorted(left)  # those of which items are left
    bins: list[Bins] = []
    while sizes:
        largest = sizes[-1]
        best: tuple[float, int, list[tuple[int, int]]] | None = None
        for capacity in capacities:
            if capacity < largest:
                continue
            room, contents, at = capacity, [], len(sizes) - 1
            while at >= 0:
                size = sizes[at]
                each = min(room // size, left[size])
                if each:
                    contents.append((size, each))
                    room -= size * each
                at = min(at, bisect.bisect_right(sizes, room)) - 1
            unused = room / capacity
            if best is None or (unused, -capacity) < (best[0], -best[1]):
                best = unused, capacity, contents
        _, capacity, contents = best
        count = min(left[size] // each for size, each in contents)
        bins.append(Bins(capacity, count, contents))
        for size, each in contents:
            left[size] -= each * count
            if not left[size]:
                sizes.pop(bisect.bisect_left(sizes, size))
    return bins


def plan(histogram: dict[int, int], capacities: list[int]) -> tuple[list[Bins], list[int]]:
    """The cheapest plan, and each group's capacity after downsizing."""
    capacities = sorted(set(capacities))
    best: tuple[int, list[Bins], list[int]] | None = None
    openings = [{s: preferred if s <= preferred else capacities[bisect.bisect_left(capacities, s)] for s in histogram} for preferred in capacities]
    for bins in (least_cost(histogram, capacities), *(best_fit(histogram, x) for x in openings)):
        bins = [b for b in bins if b.contents]
        fitted = [capacities[bisect.bisect_left(capacities, b.used)] for b in bins]
        cost = sum(c * b.count for c, b in zip(fitted, bins))
        if best is None or cost < best[0]:
            best = cost, bins, fitted
    return (best[1], best[2]) if best else ([], [])


def gap(histogram: dict[int, int], bins: list[Bins], fitted: list[int]) -> float:
    """By which share the plan's capacity exceeds the sum of all sizes, below which no plan can be."""
    whole = sum(s * n for s, n in histogram.items())
    return sum(c * b.count for c, b in zip(fitted, bins)) / whole - 1 if whole else 0.0


def _slots(bins: list[Bins], fitted: list[int]) -> tuple[np.ndarray, ...]:
    """By size, then rank: size, first rank, items per bin, first container, capacity; and the number of containers."""
    rows, taken, first = [], {}, 0
    for b, capacity in zip(bins, fitted):
        for size, each in b.contents:
            rows.append((size, taken.get(size, 0), each, first, capacity))
            taken[size] = taken.get(size, 0) + each * b.count
        first += b.count
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return (*table.T, first)


def fill(sizes: DataFrame, capacities: list[int], key: str = "doc_id", size: str = "tokens") -> DataFrame:
    """``key, piece_no, tokens, container_id, capacity``: the pieces of all items with their containers.

    ``sizes`` is read four times; pass a written or checkpointed table.
    """
    largest = max(capacities)
    items = sizes.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("tokens")).selectExpr(
        "doc_id",
        f"posexplode(transform(sequence(0, greatest(0, (tokens - 1) div {largest})), i -> least({largest}, tokens - i * {largest}))) AS (piece_no, tokens)",
    )
    parts = max(RANK_PARTS, -(-(items.agg(F.count("*")).collect()[0][0]) // PART_PIECES))
    items = items.withColumn("part", F.expr(f"pmod(xxhash64(doc_id, piece_no), {parts})"))
    counts = items.groupBy("tokens", "part").count()
    counted = {r["tokens"]: r["n"] for r in counts.groupBy("tokens").agg(F.sum("count").alias("n")).collect()}  # as many as the largest capacity at most
    counted.pop(0, None)
    bins, fitted = plan(counted, capacities)
    of_size, of_rank, each, first, capacity, containers = _slots(bins, fitted)
    shared = sizes.sparkSession.sparkContext.broadcast((of_size * (1 << 40) + of_rank, of_rank, each, first, capacity, containers))  # slots of at most as many sizes as the largest capacity

    before = Window.partitionBy("tokens").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("tokens", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("tokens", "part").orderBy("doc_id", "piece_no")
    ranked = items.withColumn("rank", F.row_number().over(within) - 1).join(offsets, ["tokens", "part"])
    ranked = ranked.select("doc_id", "piece_no", "tokens", (F.col("rank") + F.col("before")).cast("long").alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot_size, of_rank, each, first, capacity, containers = shared.value
        for b in batches:
            doc, tokens, rank = (pc.fill_null(b.column(i), 0).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 2, 3))
            if len(slot_size):
                at = np.searchsorted(slot_size, tokens * (1 << 40) + rank, side="right") - 1
                at = np.maximum(at, 0)
                container = np.where(tokens > 0, first[at] + (rank - of_rank[at]) // each[at], doc % containers)
                zero = tokens == 0
                if zero.any():
                    starts = np.unique(np.stack([first, capacity], 1), axis=0)
                    where = np.searchsorted(starts[:, 0], container, side="right") - 1
                    kept = np.where(zero, starts[where, 1], capacity[at])
                else:
                    kept = capacity[at]
                columns = [pa.array(container), pa.array(kept)]
            else:
                columns = [pa.nulls(len(b), pa.int64()), pa.nulls(len(b), pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), *columns], ["doc_id", "piece_no", "tokens", "container_id", "capacity"]
            )

    return ranked.mapInArrow(place, "doc_id BIGINT, piece_no INT, tokens BIGINT, container_id BIGINT, capacity BIGINT")


def capacities_of(specs: DataFrame) -> list[int]:
    """The distinct positive capacities of ``container_specs``."""
    rows = specs.where("capacity_tokens > 0").select("capacity_tokens").distinct().collect()  # a fixed table of a few rows
    if not rows:
        raise ValueError("container_specs names no capacity")
    return sorted(r[0] for r in rows)
