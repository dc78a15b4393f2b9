"""Best-fit packing of documents into training sequences of several permitted lengths.

A document takes as many tokens as it has words, and one that ends it; longer ones are cut into pieces at words, so nothing
is dropped. Pieces of one length are interchangeable, so the packing is decided on the number of pieces of each length, a
table bounded by the largest permitted length: lengths go from the largest down, each piece into the open bin it fits most
tightly. If it fits none, a bin is opened: for each permitted length the bin is filled on trial with the largest pieces that
are left, and the length with the least cost per token placed wins. At the end every bin shrinks to the smallest permitted
length that holds its contents. Equal bins are handled as groups with a count, so the plan does not grow with the documents.

Pieces then learn their bin from their rank among the pieces of their length. Ranks come from salted groups of bounded
size and running sums over their counts, so a length that holds most pieces is still counted by many tasks.

Null texts and texts without words take one token. Repeated rows are packed one by one. Rows without an id are packed, too.
Other columns are not read. An empty table gives no row.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql import types as T

from lexiloom.llm.common import append_columns, small, stored

CAPACITIES = (512, 1024, 2048, 4096)
#: What a bin costs besides its length, in tokens: for being there, and for attention, which grows with the square.
BIN_COST, ATTENTION = 64, 1 / 16_384
#: Pieces of one length that are ranked together.
GROUP_ROWS = 100_000


def cost(capacity: int) -> float:
    return capacity + BIN_COST + capacity * capacity * ATTENTION


_WORD = re.compile(r"[^\x20\x09-\x0D]+")

PIECE = T.StructType([T.StructField(name, T.LongType()) for name in ("piece", "start_char", "end_char", "n_tokens")])
PIECES = T.StructType([T.StructField("_pieces", T.ArrayType(PIECE))])
SEGMENTS = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in ("n_tokens", "first_rank", "end_rank", "per_bin", "first_bin", "bin_capacity", "first_offset")
    ]
)


def pieces_of(text: str | None, most: int) -> list[tuple[int, int, int, int]]:
    """(number, start, end, tokens) of the pieces of a text, which join to the whole text."""
    text = text or ""
    n = len(text.encode("utf-8", "surrogatepass").split())
    if n < most:
        return [(0, 0, len(text), n + 1)]
    starts = [match.start() for match in _WORD.finditer(text)]
    firsts = list(range(0, n, most - 1))
    cuts = [0, *[starts[i] for i in firsts[1:]], len(text)]
    return [(k, cuts[k], cuts[k + 1], min(n - first, most - 1) + 1) for k, first in enumerate(firsts)]


@dataclass
class Bins:
    """``count`` bins with the same contents: pieces by length, in the order in which they were placed."""

    capacity: int
    room: int
    count: int
    contents: list[tuple[int, int]] = field(default_factory=list)

    def take(self, count: int, length: int, each: int) -> "Bins":
        """Split ``count`` bins off and put ``each`` pieces of ``length`` into each of them."""
        self.count -= count
        return Bins(self.capacity, self.room - each * length, count, [*self.contents, (length, each)])


def _trial(counts: dict[int, int], lengths: list[int], room: int) -> dict[int, int]:
    """What a bin would hold if the largest pieces that are left and fit were put into it."""
    used: dict[int, int] = {}
    at = bisect_right(lengths, room)
    while at and room:
        at -= 1
        length = lengths[at]
        number = min(counts[length], room // length)
        if number:
            used[length] = number
            room -= number * length
            at = min(at, bisect_right(lengths, room))
    return used


def plan(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES, price: Callable[[int], float] = cost) -> list[Bins]:
    """Best-fit decreasing over counts of lengths, none above the largest capacity."""
    capacities = tuple(sorted(capacities))
    left = {length: n for length, n in histogram.items() if n > 0}
    lengths = sorted(left)
    open_bins: dict[int, list[Bins]] = {}
    rooms: list[int] = []
    closed: list[Bins] = []

    def put(bins: Bins) -> None:
        if bins.count and bins.room < lengths[0]:
            closed.append(bins)
        elif bins.count:
            if bins.room not in open_bins:
                rooms.insert(bisect_left(rooms, bins.room), bins.room)
                open_bins[bins.room] = []
            open_bins[bins.room].append(bins)

    for length in reversed(lengths):
        while left[length]:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
            else:
                best = None
                for capacity in capacities:
                    if capacity >= length:
                        used = _trial(left, lengths, capacity)
                        value = price(capacity) / sum(k * n for k, n in used.items())
                        if best is None or value <= best[0]:
                            best = (value, capacity, min(left[k] // n for k, n in used.items()))
                bins = Bins(best[1], best[1], best[2])
            each = min(bins.room // length, left[length])
            count = min(bins.count, left[length] // each)
            left[length] -= count * each
            put(bins.take(count, length, each))
            put(bins)
    closed += [bins for room in rooms for bins in open_bins[room]]
    # A bin opened in a batch may have stayed empty.
    closed = [bins for bins in closed if bins.contents]
    for bins in closed:
        used = sum(k * n for k, n in bins.contents)
        bins.capacity = next(c for c in capacities if c >= used)
        bins.room = bins.capacity - used
    return closed


def segments(bins: list[Bins]) -> list[tuple[int, ...]]:
    """Rows of SEGMENTS: which ranks among the pieces of a length go to which bins."""
    rank: dict[int, int] = {}
    rows, first_bin = [], 0
    for group in bins:
        offset = 0
        for length, each in group.contents:
            start = rank.get(length, 0)
            rank[length] = start + group.count * each
            rows.append((length, start, rank[length], each, first_bin, group.capacity, offset))
            offset += length * each
        first_bin += group.count
    return rows


def pack(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, price: Callable[[int], float] = cost) -> DataFrame:
    """One row per piece: doc_id, piece, start_char, end_char, n_tokens, bin_id, bin_capacity, bin_offset."""
    most = max(capacities)
    cut = append_columns(
        docs.select("doc_id", "text"), ["text"], PIECES, lambda lists: [[pieces_of(text, most) for text in lists[0]]]
    )
    pieces = stored(cut.select("doc_id", F.explode("_pieces").alias("p")).select("doc_id", "p.*"), "pieces")
    # At most as many rows as the largest capacity.
    histogram = {r["n_tokens"]: r["count"] for r in pieces.groupBy("n_tokens").count().collect()}
    rows = segments(plan(histogram, capacities, price))
    table = docs.sparkSession.createDataFrame(
        pd.DataFrame(rows, columns=SEGMENTS.names) if rows else [], SEGMENTS
    )

    sizes = docs.sparkSession.createDataFrame(
        [(length, -(-n // GROUP_ROWS)) for length, n in histogram.items()], "n_tokens long, salts long"
    )
    salted = pieces.join(F.broadcast(sizes), "n_tokens").withColumn("salt", F.expr("pmod(xxhash64(doc_id, piece), salts)"))
    before = W.partitionBy("n_tokens").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    groups = salted.groupBy("n_tokens", "salt").count()
    groups = groups.select("n_tokens", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    inside = W.partitionBy("n_tokens", "salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("number", F.row_number().over(inside) - 1).join(small(groups), ["n_tokens", "salt"])
    ranked = ranked.withColumn("rank", F.col("earlier") + F.col("number"))
    placed = ranked.join(
        small(table), (ranked.n_tokens == table.n_tokens) & (ranked["rank"] >= table.first_rank) & (ranked["rank"] < table.end_rank)
    )
    step = F.col("rank") - F.col("first_rank")
    return placed.select(
        "doc_id", "piece", "start_char", "end_char", ranked.n_tokens,
        (F.col("first_bin") + F.floor(step / F.col("per_bin"))).alias("bin_id"),
        "bin_capacity",
        (F.col("first_offset") + step % F.col("per_bin") * ranked.n_tokens).alias("bin_offset"),
    )
