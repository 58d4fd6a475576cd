"""Problem 6: whole texts into containers of fixed capacity by best-fit decreasing.

Best fit only looks at sizes, and sizes are whole numbers up to the capacity, so the corpus is counted per size in
parallel and the driver packs counts instead of documents: equal texts are placed in runs, a segment tree over
the remaining capacities gives the tightest open containers in logarithmic time, and what comes out are rules
"texts of this size with these ranks go to those containers". Histogram, tree and rules are bounded by the
capacity, not by the corpus. Every document then finds its container by its exact rank among those of its size,
from a range-partitioned sort with partition offsets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import checkpointed
from .tokens import TOKENIZER, token_counts

#: Largest capacity that is taken; the driver's plan is bounded by it.
MAX_CAPACITY = 1_000_000
PACKED = "pack string, capacity int, container long, doc_id long, part int, n_tokens int"


class TightestFit:
    """Segment tree over remaining capacities 0 … capacity: whether any container with so much room is open."""

    def __init__(self, capacity: int):
        self.width = 1
        while self.width < capacity + 1:
            self.width *= 2
        self.any = bytearray(2 * self.width)
        self.runs: dict[int, list[list[int]]] = {}

    def _set(self, room: int, value: int) -> None:
        node = self.width + room
        self.any[node] = value
        while node > 1:
            node //= 2
            value = self.any[2 * node] | self.any[2 * node + 1]
            if self.any[node] == value:
                break
            self.any[node] = value

    def add(self, room: int, first: int, count: int) -> None:
        """Containers first … first + count - 1 now have `room` left; full ones are closed."""
        if room > 0 and count > 0:
            runs = self.runs.setdefault(room, [])
            if runs and runs[-1][0] + runs[-1][1] == first:
                runs[-1][1] += count
            else:
                runs.append([first, count])
            if len(runs) == 1:
                self._set(room, 1)

    def tightest(self, size: int) -> int:
        """The least room of at least `size` that an open container has, or -1."""
        node = self.width + size
        if self.any[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.width:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.width
            node //= 2
        return -1

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to `most` containers with that room: the first one's number and how many."""
        runs = self.runs[room]
        first, count = runs[-1]
        used = min(count, most)
        if used == count:
            runs.pop()
        else:
            runs[-1] = [first + used, count - used]
        if not runs:
            self._set(room, 0)
        return first, used


def packing_rules(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Best-fit decreasing on counts per size (1 … capacity): rules (size, first rank, first container, texts per
    container), and the number of containers. A rule holds up to the next rule's first rank of its size.

    Texts of one size are alike, and a container that took one is again the tightest for the next as long as it
    has room, so whole runs of containers are filled alike."""
    open_ones, rules, containers = TightestFit(capacity), [], 0
    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0
        while left:
            room = open_ones.tightest(size)
            if room < 0:
                room, fresh = capacity, True
            else:
                fresh = False
            each = room // size
            wanted = max(1, left // each)
            if fresh:
                first, count = containers, wanted
                containers += count
            else:
                first, count = open_ones.take(room, wanted)
            placed = min(left, each * count)
            rules.append((size, rank, first, each))
            whole, rest = divmod(placed, each)
            open_ones.add(room - each * size, first, whole)
            if rest:
                open_ones.add(room - rest * size, first + whole, 1)
            rank, left = rank + placed, left - placed
    return rules, containers


def _pieces(sizes: DataFrame, packs: dict[str, int]) -> DataFrame:
    """(pack, capacity, doc_id, part, size): whole texts, or pieces of the capacity and a rest."""
    listed = F.array(*(F.struct(F.lit(p).alias("pack"), F.lit(c).alias("capacity")) for p, c in sorted(packs.items())))
    each = sizes.withColumn("p", F.explode(listed)).select("doc_id", "n_tokens", "p.pack", "p.capacity")
    parts = F.greatest(F.ceil(F.col("n_tokens") / F.col("capacity")), F.lit(1)).cast("int")
    size = F.least(F.col("capacity").cast("long"), F.col("n_tokens") - F.col("part").cast("long") * F.col("capacity")).cast("int")
    return each.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select("pack", "capacity", "doc_id", "part", size.alias("size"))


def packed(documents: DataFrame, pack_sizes: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(pack, capacity, container, doc_id, part, n_tokens): the container of each document in each pack.

    A text above the capacity is split into parts of the capacity and a rest, no other is; part numbers count
    from 0. Empty and null texts, with no tokens, are in container 0. A null doc_id is left out, one that occurs
    more than once counts as so many documents; packs with null, nonpositive or repeated names or capacities are
    left out (of a repeated name the largest capacity is used). `pack_sizes` must be a handful of rows."""
    packs = {}
    for row in pack_sizes.where(F.col("capacity") > 0).groupBy("pack").agg(F.max("capacity").alias("capacity")).limit(1001).collect():
        if row.pack is not None:
            packs[row.pack] = int(row.capacity)
    if len(packs) > 1000 or max(packs.values(), default=0) > MAX_CAPACITY:
        raise ValueError("too many packs or too large a capacity for a plan on the driver")
    if not packs:
        return documents.sparkSession.createDataFrame([], PACKED)
    sizes = checkpointed(token_counts(documents.where("doc_id is not null"), {"doc_id": "bigint"}, tokenizer))
    pieces = _pieces(sizes, packs)
    counts = pieces.groupBy("pack", "size").agg(F.count("*").alias("n")).collect()  # at most packs x capacities rows

    names = sorted(packs)
    rules, starts = [], []
    for place, pack in enumerate(names):
        histogram = {r["size"]: r["n"] for r in counts if r["pack"] == pack and r["size"] > 0}
        for size, rank, container, each in packing_rules(histogram, packs[pack])[0]:
            starts.append((place, size, rank))
            rules.append((container, each))
    order = sorted(range(len(starts)), key=lambda i: starts[i])
    key = np.array([(starts[i][0] << 20 | starts[i][1]) for i in order], np.int64)
    rank_from = np.array([starts[i][2] for i in order], np.int64)
    container, each = np.array([rules[i] for i in order], np.int64).reshape(-1, 2).T

    def placed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {pack: i for i, pack in enumerate(names)}
        for batch in source:
            size, rank = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
            wanted = np.array([index[p] for p in batch.column("pack").to_pylist()], np.int64) << 20 | size
            low, high = np.searchsorted(key, wanted, "left"), np.searchsorted(key, wanted, "right")
            while (wide := high - low > 1).any():  # by halves: the last rule of the size that begins at or before the rank
                middle = (low + high) // 2
                later = wide & (rank_from[np.minimum(middle, len(key) - 1)] <= rank)
                low, high = np.where(later, middle, low), np.where(wide & ~later, middle, high)
            at = np.minimum(low, max(0, len(key) - 1))
            number = np.where(size > 0, container[at] + (rank - rank_from[at]) // each[at], 0) if len(key) else np.zeros(len(size), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("pack"), batch.column("capacity"), pa.array(number), batch.column("doc_id"), batch.column("part"), batch.column("size")], names=["pack", "capacity", "container", "doc_id", "part", "n_tokens"])

    return ranked(pieces, ["pack", "size"], ["doc_id", "part"]).mapInArrow(placed, PACKED)


def ranked(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """`rows` with `rank`, counted from 0 in each group `by`: rows are range-partitioned, so that a large group
    spreads over partitions, sorted, and numbered from their partition's offset."""
    ordered = rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("_at", F.monotonically_increasing_id())
    numbered = checkpointed(ordered)
    part = F.shiftrightunsigned("_at", 33)
    starts = numbered.groupBy(*by, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a group's rows lie in neighbouring partitions: there are no more of these than groups and partitions
    offsets = starts.select(*by, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    found = numbered.withColumn("_part", part).join(offsets, [*by, "_part"])
    return found.withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_part", "_first", "_before")


def fill_report(packs: DataFrame) -> DataFrame:
    """Per pack: documents, split documents, containers, tokens, the share of room used and the fewest
    containers that any packing needs."""
    per_pack = packs.groupBy("pack", "capacity").agg(
        F.count(F.when(F.col("part") == 0, 1)).alias("documents"), F.count(F.when(F.col("part") == 1, 1)).alias("split_documents"),
        (F.max("container") + 1).alias("containers"), F.sum("n_tokens").alias("tokens"),
    )
    return per_pack.withColumn("used_share", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 6)).withColumn("fewest_possible", F.ceil(F.col("tokens") / F.col("capacity")))
