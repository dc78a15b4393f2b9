"""Benchmark decontamination: SimHash of windows of the items' sizes, Hamming blocks, exact confirmation.

Texts are lower-cased (A-Z) and cut into words. Windows have the sizes of the items, rounded down to a geometric grid; the
fingerprint of an item is that of as many of its first words, and a window that meets it is compared in the item's full
size. Every window of every document is fingerprinted: the texts of a batch are laid end to end, the counts of set bits of
a window are differences of running sums kept in lanes of 64-bit integers, and windows that reach over the end of their
text are left out.

A fingerprint is cut into four blocks of 16 bits. Two fingerprints within ``RADIUS`` = 11 bits have a block that differs
in two bits at most (else they would differ in 4 * 3 = 12), so looking a window's blocks up in a table of all item blocks
with up to two bits changed finds every item within the radius.

A run of changed words can take a similar window beyond the radius, so parts of the items, laid end to end, have fingerprints
too. A window of the full size that is similar enough lacks at most a seventh of the item's shingles. A changed run of r
words takes r + 4 of them, or r at an end of the item, so with parts of ``PART_WORDS`` words (a third of short items) some
part of every such window is unchanged and has an equal fingerprint. All windows that reach over such a part are candidates.

Candidates are then confirmed exactly: the weighted similarity of their five-word shingles (each weighted by its number of
occurrences; the whole sequence if shorter), the sum of the smaller weights over the sum of the greater ones, must be at
least ``THRESHOLD``. The distance of a window is that of its fingerprint; if a part led to it, it can exceed the radius.

The items are handled in slices of about a bounded size, which go along with the tasks; more items mean more passes over
the documents. Items are made distinct and dealt into slices by Spark, so the driver holds one slice at a time. Items without
words are not searched; items without an id are, and are reported with a null id. Null or empty texts contain nothing. Rows
are judged one by one, with or without an id; repeated items are searched under the smallest id of their words. Without items
no document contains one, and empty documents give no row. Other columns of the documents are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from lexiloom.llm.common import append_columns, shingle_hashes, stored, word_hashes
from lexiloom.operators.staging import free_name

SHINGLE_WORDS = 5
THRESHOLD = 0.75
RADIUS = 11
BLOCKS = 4
BLOCK_BITS = 16
FLIPS = RADIUS // BLOCKS
#: Items, and words of items, that one pass over the documents searches for.
SLICE_ITEMS = 20_000
SLICE_WORDS = 2_000_000
#: Ratio of neighbouring window sizes.
SIZE_RATIO = 1.35
#: Words of a part of an item, and of a part of the smallest items that have parts. Smaller ones must be met unchanged.
PART_WORDS, LEAST_PART_WORDS = 12, 3
#: Candidates that are made of parts at a time, unless one stretch of text has more.
CANDIDATES = 1_000_000
#: Words of one run of fingerprints, unless a single text has more.
RUN_WORDS = 32_768
#: Bits of the table that tells which shingles may belong to an item.
FILTER_BITS = 20

#: All changes of at most FLIPS bits of a block.
_ONE = [1 << i for i in range(BLOCK_BITS)]
CHANGES = np.array(sorted({0, *_ONE, *[a | b for a in _ONE for b in _ONE]}), dtype=np.uint32)

#: For each byte, its eight bits spread over the lanes of one integer (8 bits wide), low bit first.
_BYTES = np.arange(256, dtype=np.uint64)
NARROW = np.bitwise_or.reduce([((_BYTES >> np.uint64(i)) & np.uint64(1)) << np.uint64(8 * i) for i in range(8)])
#: For each half byte, the same over lanes of 16 bits.
WIDE = np.bitwise_or.reduce([((_BYTES[:16] >> np.uint64(i)) & np.uint64(1)) << np.uint64(16 * i) for i in range(4)])
NARROW_TOP, WIDE_TOP = np.uint64(0x8080808080808080), np.uint64(0x8000800080008000)
#: Most words of a window whose counts fit lanes of 8 bits, with the bias that turns a majority into a top bit.
NARROW_WORDS, WIDE_WORDS = 127, 32_767


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class Sums:
    """Running sums of the bits of word hashes, from which SimHashes of all windows follow."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.sums: dict[bool, list[np.ndarray]] = {}

    def _lanes(self, narrow: bool) -> list[np.ndarray]:
        if narrow not in self.sums:
            width, table = (8, NARROW) if narrow else (4, WIDE)
            mask = np.uint64(len(table) - 1)
            found = []
            for at in range(0, 64, width):
                spread = table[((self.hashes >> np.uint64(at)) & mask).astype(np.intp)]
                total = np.zeros(len(spread) + 1, dtype=np.uint64)
                np.cumsum(spread, out=total[1:])  # modulo 2^64; differences of near sums are exact
                found.append(total)
            self.sums[narrow] = found
        return self.sums[narrow]

    def windows(self, size: int) -> np.ndarray:
        """SimHash of every window of ``size`` words: a bit is set if more than half of the words set it.

        The order of the bits depends on the size of the lanes only.
        """
        if size > WIDE_WORDS:
            return self._long_windows(size)
        narrow = size <= NARROW_WORDS
        top, width, lane = (NARROW_TOP, 8, 8) if narrow else (WIDE_TOP, 4, 16)
        bias = np.uint64(sum(((1 << (lane - 1)) - 1 - size // 2) << (lane * i) for i in range(width)))
        result = np.zeros(len(self.hashes) - size + 1, dtype=np.uint64)
        count = np.empty_like(result)
        for place, total in enumerate(self._lanes(narrow)):
            np.subtract(total[size:], total[:-size], out=count)
            np.add(count, bias, out=count)
            np.bitwise_and(count, top, out=count)
            np.right_shift(count, np.uint64(lane - 1 - place), out=count)
            np.bitwise_or(result, count, out=result)
        return result

    def _long_windows(self, size: int) -> np.ndarray:
        result = np.zeros(len(self.hashes) - size + 1, dtype=np.uint64)
        for bit in range(64):
            total = np.concatenate([[0], np.cumsum((self.hashes >> np.uint64(bit)) & np.uint64(1))])
            result |= (total[size:] - total[:-size] > size // 2).astype(np.uint64) << np.uint64(bit)
        return result


def shingle_weights(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingle_hashes(hashes, SHINGLE_WORDS), return_counts=True)


def weighted_similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller weights over the sum of the greater ones."""
    _, i, j = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(one[1][i], two[1][j]).sum())
    high = int(one[1].sum() + two[1].sum()) - low
    return low / high if high else 0.0


def grid_size(words: int) -> int:
    """The largest window size of the grid that is not above ``words``."""
    size = 1
    while (larger := max(size + 1, int(size * SIZE_RATIO))) <= words:
        size = larger
    return size


class Blocks:
    """Fingerprints of the items of one window size, with a table from block values to items."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.tables = []
        for block in range(BLOCKS):
            near = (_block(prints, block).astype(np.int64)[:, None] ^ CHANGES[None, :]).ravel()
            member = np.repeat(np.arange(len(prints)), len(CHANGES))
            order = np.argsort(near, kind="stable")
            ends = np.searchsorted(near[order], np.arange(2**BLOCK_BITS + 1))
            count = np.diff(ends)
            self.tables.append((ends[:-1].astype(np.int64), count, count > 0, member[order]))

    def within(self, windows: np.ndarray, possible: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions in ``windows``, items and distances of all pairs within the radius, each pair once.

        Only positions marked in ``possible`` count.
        """
        found = []
        for block, (first, count, mark, members) in enumerate(self.tables):
            values = _block(windows, block)
            at = np.flatnonzero(mark[values] & possible)
            value = values[at]
            times = count[value]
            ends = np.cumsum(times)
            inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - times, times)
            member = members[np.repeat(first[value], times) + inside]
            start = np.repeat(at, times)
            distance = np.bitwise_count(windows[start] ^ self.prints[member])
            near = distance <= RADIUS
            found.append((start[near], member[near], distance[near]))
        start, member, distance = (np.concatenate(x) for x in zip(*found, strict=True))
        _, once = np.unique(start * len(self.prints) + member, return_index=True)
        return start[once], member[once], distance[once].astype(np.int64)


def part_size(size: int) -> int:
    """Words of the parts of the items of a window size, 0 if they have none."""
    return 0 if size < 8 else max(LEAST_PART_WORDS, min(PART_WORDS, size // 3))


def _folded(prints: np.ndarray) -> np.ndarray:
    return ((prints ^ (prints >> np.uint64(20)) ^ (prints >> np.uint64(40))) & np.uint64(2**FILTER_BITS - 1)).astype(np.intp)


class Parts:
    """Fingerprints of the parts of the items of one window size."""

    def __init__(self, items: list[np.ndarray], words: int):
        self.words = words
        prints = [Sums(h).windows(words)[::words] for h in items]
        member = np.repeat(np.arange(len(items)), [len(x) for x in prints])
        pairs = np.unique(np.rec.fromarrays([np.concatenate(prints), member], names="print,member"))
        self.member = np.ascontiguousarray(pairs["member"])
        self.prints, self.first, self.count = np.unique(pairs["print"], return_index=True, return_counts=True)
        self.mark = np.zeros(2**FILTER_BITS, dtype=bool)
        self.mark[_folded(self.prints)] = True

    def stretches(
        self, windows: np.ndarray, lengths: np.ndarray, shared: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(member, first start, last start) of all stretches of windows that reach over a part of the member.

        Parts with too few shingles of items around them are passed over.
        """
        at = np.flatnonzero(self.mark[_folded(windows)])
        place = np.minimum(np.searchsorted(self.prints, windows[at]), len(self.prints) - 1)
        equal = self.prints[place] == windows[at]
        at, place = at[equal], place[equal]
        times = self.count[place]
        ends = np.cumsum(times)
        inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - times, times)
        member = self.member[np.repeat(self.first[place], times) + inside]
        last = np.repeat(at, times)
        first = np.maximum(last - lengths[member] + self.words, 0)
        most = shared[np.minimum(last + lengths[member], len(shared) - 1)] - shared[first]
        enough = most >= THRESHOLD * (lengths[member] - SHINGLE_WORDS + 1) - 1e-9
        member, first, last = member[enough], first[enough], last[enough]
        order = np.lexsort((last, member))
        member, first, last = member[order], first[order], last[order]
        new = np.ones(len(member), dtype=bool)
        new[1:] = (member[1:] != member[:-1]) | (first[1:] > last[:-1] + 1)
        return member[new], first[new], last[np.roll(new, -1)]


def _spelt_out(
    member: np.ndarray, first: np.ndarray, last: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, member) of all starts of the stretches, a bounded number at a time."""
    times = last - first + 1
    chunk = (np.cumsum(times) - 1) // CANDIDATES
    for one in np.unique(chunk):
        mine = chunk == one
        n = times[mine]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(first[mine], n) + inside, np.repeat(member[mine], n)


def _best_window(
    hashes: np.ndarray, first: int, last: int, length: int, item: tuple[np.ndarray, np.ndarray]
) -> tuple[float, int]:
    """Similarity and start of the best window of ``length`` words, or up to the end, that starts from ``first`` to ``last``."""
    if length < SHINGLE_WORDS:
        found = ((weighted_similarity(shingle_weights(hashes[s : s + length]), item), -s) for s in range(first, last + 1))
        likeness, start = max(found)
        return likeness, -start
    shingles = shingle_hashes(hashes[first : last + length], SHINGLE_WORDS)
    place = np.minimum(np.searchsorted(item[0], shingles), len(item[0]) - 1)
    places = np.where(item[0][place] == shingles, place, -1).tolist()
    # Occurrences in the item less those in the window: below zero, a window's further occurrences are not shared.
    left = item[1].tolist()
    total, size = sum(left), length - SHINGLE_WORDS + 1
    shared = stop = 0
    best = (-1.0, first)
    for start in range(last - first + 1):
        for p in places[stop : start + size]:
            if p >= 0:
                shared += left[p] > 0
                left[p] -= 1
        stop = max(stop, min(start + size, len(places)))
        likeness = shared / (total + stop - start - shared)
        if likeness > best[0]:
            best = (likeness, first + start)
        if (p := places[start]) >= 0:
            left[p] += 1
            shared -= left[p] > 0
    return best


def _block(prints: np.ndarray, block: int) -> np.ndarray:
    return np.ascontiguousarray(prints).view(np.uint16)[block::BLOCKS]


class Index:
    """The items of one slice."""

    def __init__(self, items: list[tuple[int, list[bytes]]]):
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for number, words in items:
            by_size.setdefault(grid_size(len(words)), []).append((number, word_hashes(words)))
        self.blocks: dict[int, Blocks] = {}
        self.parts: dict[int, Parts] = {}
        self.ids: dict[int, list[int]] = {}
        self.lengths: dict[int, np.ndarray] = {}
        self.weights: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.filter = np.zeros(2**FILTER_BITS, dtype=np.int32)
        for size, members in by_size.items():
            self.blocks[size] = Blocks(np.array([Sums(h).windows(size)[0] for _, h in members], dtype=np.uint64))
            if words := part_size(size):
                self.parts[size] = Parts([h for _, h in members], words)
            self.ids[size] = [number for number, _ in members]
            self.lengths[size] = np.array([len(h) for _, h in members])
            self.weights[size] = [shingle_weights(h) for _, h in members]
            for shingles, _ in self.weights[size]:
                self.filter[(shingles & np.uint64(2**FILTER_BITS - 1)).astype(np.int64)] = 1

    def hits(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int, float]]]:
        """For each text (item, first word, words, distance, similarity) of the best window for each item in it."""
        result: list[list[tuple[int, int, int, int, float]]] = []
        run: list[list[bytes]] = []
        total = 0
        for text in texts:
            words = words_of(text)
            if run and total + len(words) > RUN_WORDS:
                result += self._run(run)
                run, total = [], 0
            run.append(words)
            total += len(words)
        return result + self._run(run)

    def _run(self, texts: list[list[bytes]]) -> list[list[tuple[int, int, int, int, float]]]:
        hashes = word_hashes([word for words in texts for word in words])
        ends = np.cumsum([len(words) for words in texts])
        best: list[dict[int, tuple[float, int, int, int]]] = [{} for _ in texts]
        sums = Sums(hashes)
        # How many shingles of each prefix may belong to an item: a bound on what a window can share with one.
        shared = np.zeros(len(hashes) + 1, dtype=np.int32)
        if len(hashes) >= SHINGLE_WORDS:
            shingles = shingle_hashes(hashes, SHINGLE_WORDS) & np.uint64(2**FILTER_BITS - 1)
            np.cumsum(self.filter[shingles.astype(np.int64)], out=shared[1 : len(shingles) + 1])
            shared[len(shingles) + 1 :] = shared[len(shingles)]
        part_windows: dict[int, np.ndarray] = {}
        for size, blocks in self.blocks.items():
            n = len(hashes) - size + 1
            if n < 1:
                continue
            lengths = self.lengths[size]
            whole = size >= SHINGLE_WORDS
            possible = np.ones(n, dtype=bool)
            if whole:
                possible = shared[np.minimum(np.arange(n) + int(lengths.max()), len(hashes))] > shared[:n]
            windows = sums.windows(size)
            found = [self._likely(size, *blocks.within(windows, possible)[:2], ends, shared)]
            if parts := self.parts.get(size):
                if parts.words not in part_windows:
                    part_windows[parts.words] = sums.windows(parts.words)
                stretches = parts.stretches(part_windows[parts.words], lengths, shared)
                found += [self._likely(size, *pairs, ends, shared) for pairs in _spelt_out(*stretches)]
            start, member = (np.concatenate(x) for x in zip(*found, strict=True))
            text = np.searchsorted(ends, start, side="right")
            order = np.lexsort((start, member, text))
            start, member, text = start[order], member[order], text[order]
            # Windows of short items, which have no parts, are compared one by one.
            gap = lengths[member[1:]] if size in self.parts else 0
            new = np.ones(len(start), dtype=bool)
            new[1:] = (text[1:] != text[:-1]) | (member[1:] != member[:-1]) | (start[1:] - start[:-1] > gap)
            last = start[np.roll(new, -1)]
            for s, e, m, t in zip(*(x.tolist() for x in (start[new], last, member[new], text[new])), strict=True):
                low, high = int(ends[t - 1]) if t else 0, int(ends[t])
                length = int(lengths[m])
                likeness, s = _best_window(hashes[:high], s, e, length, self.weights[size][m])
                if likeness >= THRESHOLD:
                    item = self.ids[size][m]
                    distance = int(np.bitwise_count(windows[s] ^ blocks.prints[m]))
                    one = (likeness, low - s, min(s + length, high) - s, distance)
                    best[t][item] = max(best[t].get(item, (-1.0, 0, 0, 0)), one)
        return [
            [(item, -first, size, distance, likeness) for item, (likeness, first, size, distance) in sorted(x.items())]
            for x in best
        ]

    def _likely(
        self, size: int, start: np.ndarray, member: np.ndarray, ends: np.ndarray, shared: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose window lies in one text and may share enough shingles with the item."""
        inside = start + size <= ends[-1]
        start, member = start[inside], member[inside]
        end = ends[np.searchsorted(ends, start, side="right")]
        inside = start + size <= end
        start, member, end = start[inside], member[inside], end[inside]
        if size < SHINGLE_WORDS:
            return start, member
        stop = np.minimum(start + self.lengths[size][member], end)
        most = shared[stop - SHINGLE_WORDS + 1] - shared[start]
        both = (stop - start) + self.lengths[size][member] - 2 * (SHINGLE_WORDS - 1)
        likely = most >= THRESHOLD * (both - most) - 1e-9
        return start[likely], member[likely]


HIT = T.StructType(
    [
        T.StructField("item_id", T.LongType()), T.StructField("first_word", T.LongType()),
        T.StructField("n_words", T.LongType()), T.StructField("distance", T.LongType()),
        T.StructField("similarity", T.DoubleType()),
    ]
)
Item = tuple[int | None, list[bytes]]


def slices(items: DataFrame) -> Iterator[list[Item]]:
    """The items by slices of bounded size, each read when it is needed; each distinct sequence of words once, under its
    smallest id, or without one if none of its rows has an id."""
    outputs = T.StructType([T.StructField("_words", T.BinaryType()), T.StructField("_n", T.LongType())])

    def cut(lists: list[list]) -> list[list]:
        found = [words_of(text) for text in lists[0]]
        return [[b" ".join(words) for words in found], [len(words) for words in found]]

    rows = append_columns(items.where("text is not null").select("item_id", "text"), ["text"], outputs, cut)
    rows = rows.where("_n > 0").groupBy(F.sha2("_words", 256).alias("_key")).agg(
        F.min("item_id").alias("item_id"), F.first("_words").alias("_words"), F.first("_n").alias("_n")
    )
    rows = stored(rows, "items")
    size = rows.agg(F.count(F.lit(1)).alias("items"), F.coalesce(F.sum("_n"), F.lit(0)).alias("words")).first()
    n = max(-(-size["items"] // SLICE_ITEMS), -(-size["words"] // SLICE_WORDS))
    for number in range(n):
        part = rows.where(F.pmod(F.xxhash64("_key"), F.lit(n)) == number).select("item_id", "_words").collect()
        if part:
            order = sorted(part, key=lambda row: (row["item_id"] is None, row["item_id"] or 0, row["_words"]))
            yield [(row["item_id"], bytes(row["_words"]).split(b" ")) for row in order]


def _searched(docs: DataFrame, items: list[Item], name: str) -> DataFrame:
    """``docs`` with the hits of ``items`` in the column ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    kept: list[Index] = []

    def search(lists: list[list]) -> list[list]:
        if not kept:
            kept.append(Index([(at, words) for at, (_, words) in enumerate(shared.value)]))
        ids = [item_id for item_id, _ in shared.value]
        return [[[(ids[at], *rest) for at, *rest in hits] for hits in kept[0].hits(lists[0])]]

    return append_columns(docs, ["text"], T.StructType([T.StructField(name, T.ArrayType(HIT))]), search)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document row and item that it contains: doc_id, item_id, first_word, n_words, distance, similarity."""
    result = docs.sparkSession.createDataFrame([], T.StructType([T.StructField("doc_id", T.LongType()), *HIT]))
    for part in slices(items):
        found = _searched(docs.select("doc_id", "text"), part, "_hits")
        result = result.union(found.select("doc_id", F.explode("_hits").alias("hit")).select("doc_id", "hit.*"))
    return result


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    columns, name = docs.columns, free_name(docs, "_hits")
    for part in slices(items):
        docs = _searched(docs, part, name).where(F.size(name) == 0).select(*[f"`{column}`" for column in columns])
    return docs
