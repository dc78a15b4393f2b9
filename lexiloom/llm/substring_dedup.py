"""Repeated passages by recompression: words in windows that occur more than once are removed.

1. Each text is parsed in rounds. A round gives every run of equal symbols a name, then every pair whose left symbol is of the
   left kind and whose right one is of the right kind. A name is a hash of what it stands for, so it is the same in all tasks
   and no dictionary travels. Every symbol knows its extent: the words that decide that it exists. A window that holds the
   extent holds the symbol, wherever it stands, so equal windows hold equal interior symbols.
2. Each window is given to one anchor: of the highest round that has a symbol with its extent inside the window, the symbol
   of most words (ties: by name, then leftmost). Equal windows have equal anchors at the same offset. Neighbouring windows share
   an anchor; the words of all of them are its context.
3. Spark counts the names and contexts of all anchors, cut by ranges of the name. An anchor whose name occurs once has no
   repeated window. One whose context occurs again has nothing but repeated windows: most long repeats end here. For the rest
   (edges of repeats, chance meetings) the windows themselves are counted, together with those of one anchor of each
   repeated context of that name.
4. The words of repeated windows leave the text.

Texts are read by units of a bounded number of words, which send each name and context once, however often it occurs; so a
passage in a third of all rows adds one entry per unit. The number of ranges follows the number of entries. Contexts and windows are
compared by 128-bit digests made from 128-bit hashes of the words. What must stay the same between two reads is written to the
shared folder; texts move only if the positions to look at, or to remove, exceed the measured limit for broadcasts.

Null and empty texts have no words; texts shorter than a window stay whole. Every row is returned; rows that repeat, with or
without an id, are repeats of each other. An empty table gives no row. Other columns are not read. Memory follows what is
parsed at a time, the anchors of a unit (about a tenth of its words) or the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from lexiloom.llm.common import append_columns, mixed, small, stored

WINDOW_WORDS = 35
ROUNDS = 5
#: Words of a unit, and entries of a range, about.
UNIT_WORDS, RANGE_ENTRIES = 1_000_000, 250_000
#: Words that are parsed at a time, unless a single text has more, and rows whose texts are unpacked at a time.
PARSE_WORDS, ROWS = 100_000, 256

_U = np.uint64
_RUN, _COUNT, _LEFT, _RIGHT = (_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
#: Odd bases of the two halves of a digest, and their inverses modulo 2^64.
_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_INVERSES = tuple(pow(base, -1, 1 << 64) for base in _BASES)

Batches = Iterator[pa.RecordBatch]


def hashes_of(words: list[bytes]) -> np.ndarray:
    """128-bit hashes of words, as two columns."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), dtype="<u8").reshape(-1, 2).astype(np.uint64)


@dataclass
class Symbols:
    """Symbols of one round, in the order of the text; a mark stands between texts."""

    name: np.ndarray
    #: Words that the symbol stands for: start and end.
    start: np.ndarray
    end: np.ndarray
    #: The extent: words that decide that the symbol exists.
    low: np.ndarray
    high: np.ndarray
    #: Hashes of the first and the last word.
    first: np.ndarray
    last: np.ndarray
    mark: np.ndarray


def words_as_symbols(hashes: np.ndarray, sizes: np.ndarray, gap: int) -> Symbols:
    """Texts one after another, with ``gap`` places and a mark in the middle before, between and after them."""
    names = hashes[:, 0]
    bases = np.cumsum(sizes + gap) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(names)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + bases[text]
    marks = np.append(bases, bases[-1] + sizes[-1] + gap) - gap // 2
    place = np.concatenate([inside, marks])
    order = np.argsort(place, kind="stable")
    mark = (np.arange(len(place)) >= len(names))[order]
    place = place[order]
    name = np.concatenate([names, np.zeros(len(marks), dtype=np.uint64)])[order]
    end = place + ~mark
    return Symbols(name, place, end, place, end, name, name, mark)


def _name_runs(x: Symbols, number: int) -> Symbols:
    """Every run of equal symbols becomes one. It ends where the next word, or else the next symbol, differs."""
    first = np.flatnonzero(np.concatenate([[True], (x.name[1:] != x.name[:-1]) | x.mark[1:] | x.mark[:-1]]))
    last = np.append(first[1:], len(x.name)) - 1
    size = (last - first + 1).astype(np.uint64)
    with np.errstate(over="ignore"):
        runs = mixed(x.name[first] * _RUN + size * _COUNT + _U(number))
    name = np.where(size > 1, runs, x.name[first])
    before, after = np.maximum(first - 1, 0), np.minimum(last + 1, len(x.name) - 1)
    low, high = x.low[first], x.high[last]
    clear = (x.last[before] != x.last[first]) & ~x.mark[before]
    low = np.minimum(low, np.where(clear, x.start[first] - 1, x.low[before]))
    clear = (x.first[after] != x.first[last]) & ~x.mark[after]
    high = np.maximum(high, np.where(clear, x.end[last] + 1, x.high[after]))
    mark = x.mark[first]
    low, high = np.where(mark, x.low[first], low), np.where(mark, x.high[last], high)
    return Symbols(name, x.start[first], x.end[last], low, high, x.first[first], x.last[last], mark)


def _name_pairs(x: Symbols, number: int) -> Symbols:
    """A symbol of the left kind and a following one of the right kind become one; which kind a name is changes by round."""
    with np.errstate(over="ignore"):
        left = mixed(x.name + _U(number) * _COUNT) >> _U(63) == 1
    joins = np.append(left[:-1] & ~left[1:] & ~x.mark[1:] & ~x.mark[:-1], False)
    joined = np.concatenate([[False], joins[:-1]])
    kept = np.flatnonzero(~joined)
    pair = joins[kept]
    other = np.minimum(kept + 1, len(x.name) - 1)
    with np.errstate(over="ignore"):
        names = mixed(x.name[kept] * _LEFT + mixed(x.name[other] + _RIGHT) + _U(number))
    end = np.where(pair, other, kept)
    # What stays alone depends on the neighbour that it might have joined.
    before = np.maximum(kept - 1, 0)
    mark = x.mark[kept]
    low = np.where(~pair & ~left[kept] & ~mark, np.minimum(x.low[kept], x.low[before]), x.low[kept])
    high = np.where(~pair & left[kept] & ~mark, np.maximum(x.high[kept], x.high[other]), x.high[end])
    name = np.where(pair, names, x.name[kept])
    return Symbols(name, x.start[kept], x.end[end], low, high, x.first[kept], x.last[end], mark)


def _best(value: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The leftmost position of the largest of value[first..last], for each pair of bounds."""
    size = last - first + 1
    level = np.zeros(len(size), dtype=np.int64)
    tables = [np.arange(len(value))]
    width = 1
    while 2 * width <= size.max(initial=1):
        table = tables[-1]
        a, b = table[:-width], table[width:]
        tables.append(np.where(value[a] >= value[b], a, b))
        width *= 2
        level[size >= width] += 1
    found = np.empty(len(size), dtype=np.int64)
    for at, table in enumerate(tables):
        here = level == at
        a, b = table[first[here]], table[last[here] - (1 << at) + 1]
        found[here] = np.where(value[a] >= value[b], a, b)
    return found


def anchors(hashes: np.ndarray, sizes: np.ndarray, window: int, rounds: int) -> tuple[np.ndarray, ...]:
    """(name, text, first window, last window, start) of the anchors of all windows; places count from the start of a text."""
    gap = 2 * window + 2
    symbols = words_as_symbols(hashes, sizes, gap)
    levels = [symbols]
    for number in range(1, rounds + 1):
        symbols = _name_pairs(_name_runs(symbols, number), number)
        levels.append(symbols)
    bases = np.cumsum(sizes + gap) - sizes
    counts = np.maximum(sizes - window + 1, 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    begin = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + bases[text]
    name, start = np.zeros(len(begin), dtype=np.uint64), np.zeros(len(begin), dtype=np.int64)
    height = np.zeros(len(begin), dtype=np.int64)
    left = np.arange(len(begin))
    for at in range(rounds, -1, -1):
        x = levels[at]
        fit = np.flatnonzero(~x.mark & (x.high - x.low <= window))
        first = np.searchsorted(x.low[fit], begin[left], side="left")
        last = np.searchsorted(x.high[fit], begin[left] + window, side="right") - 1
        held = first <= last
        words = (x.end - x.start)[fit].astype(np.uint64)
        value = words << _U(57) | mixed(x.name[fit]) >> _U(7)
        chosen = fit[_best(value, first[held], last[held])]
        here = left[held]
        name[here], start[here], height[here] = x.name[chosen], x.start[chosen], at
        left = left[~held]
    assert not len(left)
    new = np.concatenate([[True], (start[1:] != start[:-1]) | (height[1:] != height[:-1]) | (text[1:] != text[:-1])])[: len(begin)]
    one = np.flatnonzero(new)
    last = np.append(one[1:], len(begin)) - 1
    shift = bases[text[one]]
    return name[one], text[one], begin[one] - shift, begin[last] - shift, start[one] - shift


class Digests:
    """128-bit digests of any stretch of words of a row of texts."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.sums, self.back = [], []
        with np.errstate(over="ignore"):
            for half in range(2):
                powers = np.cumprod(np.concatenate([[_U(1)], np.full(n, _U(_BASES[half]))]))
                self.back.append(np.cumprod(np.concatenate([[_U(1)], np.full(n, _U(_INVERSES[half]))])))
                self.sums.append(np.concatenate([[_U(0)], np.cumsum(mixed(hashes[:, half]) * powers[:n])]))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            halves = [mixed((sums[end] - sums[start]) * back[start]) for sums, back in zip(self.sums, self.back, strict=True)]
        return np.stack(halves, axis=1)


UNIT = "unit long, keys binary, texts binary, first binary, last binary, entry binary, name binary, context binary, several binary"


def _unit(keys: list[bytes], text, first, last, name, context, number: int) -> pa.RecordBatch:
    """One unit: where its items are, and each distinct (name, context) once, in order."""
    order = np.lexsort((context[:, 1], context[:, 0], name))
    sorted_name, sorted_context = name[order], context[order]
    new = np.concatenate([[True], (sorted_name[1:] != sorted_name[:-1]) | (sorted_context[1:] != sorted_context[:-1]).any(axis=1)])[: len(name)]
    one = np.flatnonzero(new)
    entry = np.empty(len(name), dtype=np.int32)
    entry[order] = np.cumsum(new) - 1
    several = np.diff(np.append(one, len(name))) > 1
    columns = [
        b"".join(keys), text.astype(np.int32).tobytes(), first.astype(np.int32).tobytes(), last.astype(np.int32).tobytes(),
        entry.tobytes(), sorted_name[one].tobytes(), sorted_context[one].tobytes(), several.tobytes(),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), *[pa.array([x], pa.binary()) for x in columns]],
        names=[part.split()[0] for part in UNIT.split(", ")],
    )


def _units(rows: DataFrame, least_words: int, unit_words: int, items: Callable) -> DataFrame:
    """Rows (key, text, ...) as units; ``items`` gives (text, first, last, name, context) for hashes, sizes and other columns."""

    def read(batches: Batches) -> Batches:
        number = TaskContext.get().partitionId() << 33
        keys: list[bytes] = []
        done: list[tuple[np.ndarray, ...]] = []
        found: list[np.ndarray] = []
        more: list[tuple] = []
        waiting = size = 0

        def parse() -> None:
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            text, *rest = items(np.concatenate(found), sizes, more)
            done.append((text + (len(keys) - len(found)), *rest))
            found.clear()
            more.clear()

        def closed() -> Batches:
            columns = [np.concatenate(parts) for parts in zip(*done, strict=True)]
            if len(columns[0]):
                yield _unit(keys, *columns, number)
            keys.clear()
            done.clear()

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                for key, text, *rest in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                    words = text.encode("utf-8", "surrogatepass").split()
                    if len(words) < least_words:
                        continue
                    keys.append(key)
                    found.append(hashes_of(words))
                    more.append(tuple(rest))
                    waiting += len(words)
                    size += len(words)
                    if waiting >= PARSE_WORDS or size >= unit_words:
                        parse()
                        waiting = 0
                    if size >= unit_words:
                        yield from closed()
                        number, size = number + 1, 0
        if found:
            parse()
        if done:
            yield from closed()

    return rows.mapInArrow(read, UNIT)


#: What the count says of an entry: its name is alone, its context occurs again, only its name does, and like the second,
#: and its windows are to be counted for others.
ALONE, AGAIN, OPEN, AGAIN_SENT = range(4)


def _codes(units: DataFrame, range_entries: int) -> DataFrame:
    """(unit, codes): one code for each entry of a unit, in its order."""
    entries = units.agg(F.coalesce(F.sum(F.octet_length("several")), F.lit(0))).first()[0]
    ranges = max(1, -(-entries // range_entries))

    def send(batches: Batches) -> Batches:
        bounds = np.array([-(-(i << 64) // ranges) for i in range(1, ranges)], dtype=np.uint64)
        for batch in batches:
            for unit, name, context, several in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                names = np.frombuffer(name, dtype=np.uint64)
                cuts = [0, *np.searchsorted(names, bounds).tolist(), len(names)]
                for at, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if a < b:
                        parts = name[8 * a : 8 * b], context[16 * a : 16 * b], several[a:b]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([at], pa.int32()), pa.array([unit], pa.int64()), *[pa.array([x], pa.binary()) for x in parts]],
                            names=["range", "unit", "name", "context", "several"],
                        )

    def judge(table: pa.Table) -> pa.Table:
        join = lambda column, kind: np.frombuffer(b"".join(table[column].to_pylist()), dtype=kind)
        name, context, several = join("name", np.uint64), join("context", np.uint64).reshape(-1, 2), join("several", bool)
        order = np.lexsort((context[:, 1], context[:, 0], name))
        name, context = name[order], context[order]
        new_name = np.concatenate([[True], name[1:] != name[:-1]])
        new = new_name | np.concatenate([[True], (context[1:] != context[:-1]).any(axis=1)])
        of_name, of_context = np.cumsum(new_name) - 1, np.cumsum(new) - 1
        again = (np.bincount(of_context, weights=1 + several[order]) > 1)[of_context]
        mixed_name = (np.bincount(of_name, weights=new) > 1)[of_name]
        codes = np.where(again, np.where(mixed_name & new, AGAIN_SENT, AGAIN), np.where(mixed_name, OPEN, ALONE))
        back = np.empty(len(codes), dtype=np.uint8)
        back[order] = codes
        sizes = [len(x.as_py()) for x in table["several"]]
        ends = np.cumsum(sizes).tolist()
        parts = [back[end - size : end].tobytes() for size, end in zip(sizes, ends, strict=True)]
        return pa.table({"range": table["range"], "unit": table["unit"], "codes": pa.array(parts, pa.binary())})

    sent = units.select("unit", "name", "context", "several").mapInArrow(
        send, "range int, unit long, name binary, context binary, several binary"
    )
    judged = sent.groupBy("range").applyInArrow(judge, "range int, unit long, codes binary")
    parts = F.sort_array(F.collect_list(F.struct("range", "codes")))
    return judged.groupBy("unit").agg(parts.alias("parts")).select("unit", F.expr("aggregate(parts, X'', (a, x) -> concat(a, x.codes))").alias("codes"))


def merged(starts: np.ndarray, ends: np.ndarray) -> list[int]:
    """Stretches that cover the same places, apart from each other, as start, end, start, end, ..."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    one = np.flatnonzero(new)
    return np.stack([starts[one], ends[np.append(one[1:], len(ends)) - 1]], axis=1).ravel().tolist()


def _found(units: DataFrame, codes: DataFrame, window: int) -> DataFrame:
    """(key, covered, asked): words of repeated windows, and windows that are still to be counted, of each text."""

    def read(batches: Batches) -> Batches:
        for batch in batches:
            for keys, *arrays, codes in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                text, first, last, entry = (np.frombuffer(x, dtype=np.int32).astype(np.int64) for x in arrays)
                code = np.frombuffer(codes, dtype=np.uint8)[entry]
                repeated = (code == AGAIN) | (code == AGAIN_SENT)
                asked = code == OPEN
                # One anchor speaks for all of the unit with its context.
                sent = np.flatnonzero(code == AGAIN_SENT)
                asked[sent[np.unique(entry[sent], return_index=True)[1]]] = True
                rows: dict[int, list] = {}
                for column, chosen, reach in ((1, repeated, window), (2, asked, 1)):
                    places = np.flatnonzero(chosen)
                    if not len(places):
                        continue
                    places = places[np.argsort(text[places], kind="stable")]
                    cuts = np.flatnonzero(np.diff(text[places])) + 1
                    for some in np.split(places, cuts):
                        at = int(text[some[0]])
                        row = rows.setdefault(at, [keys[16 * at : 16 * at + 16], [], []])
                        row[column] = merged(first[some], last[some] + reach)
                if rows:
                    key, covered, left = zip(*rows.values(), strict=True)
                    kind = pa.list_(pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key, pa.binary()), pa.array(covered, kind), pa.array(left, kind)], names=["key", "covered", "asked"]
                    )

    places = units.select("unit", "keys", "texts", "first", "last", "entry").join(small(codes), "unit").drop("unit")
    return places.mapInArrow(read, "key binary, covered array<int>, asked array<int>")


def _key() -> Column:
    """128 bits that tell rows with different ids or texts apart."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")))


def repeats(
    docs: DataFrame,
    window: int = WINDOW_WORDS,
    rounds: int = ROUNDS,
    unit_words: int = UNIT_WORDS,
    range_entries: int = RANGE_ENTRIES,
) -> DataFrame:
    """(key, covered): for each text with repeated windows, the stretches of words that they cover."""
    texts = docs.where("text is not null").select(_key().alias("key"), "text")

    def all_anchors(hashes: np.ndarray, sizes: np.ndarray, _: list) -> tuple:
        name, text, first, last, start = anchors(hashes, sizes, window, rounds)
        at = (np.cumsum(sizes) - sizes)[text]
        context = Digests(hashes).of(at + first, at + last + window)
        with np.errstate(over="ignore"):
            shape = mixed(((last - first) << 32 | (start - first)).astype(np.uint64) + _RUN)
        context[:, 0] ^= shape
        return text, first, last, name, context

    def windows(hashes: np.ndarray, sizes: np.ndarray, asked: list[tuple]) -> tuple:
        text, first = [], []
        for at, (stretches,) in enumerate(asked):
            for a, b in zip(stretches[::2], stretches[1::2]):
                text.append(np.full(b - a, at))
                first.append(np.arange(a, b))
        text, first = np.concatenate(text), np.concatenate(first)
        at = (np.cumsum(sizes) - sizes)[text] + first
        digest = Digests(hashes).of(at, at + window)
        context = np.stack([digest[:, 1], np.zeros(len(at), dtype=np.uint64)], axis=1)
        return text, first, first, digest[:, 0], context

    units = stored(_units(texts, window, unit_words, all_anchors), "units")
    found = stored(_found(units, _codes(units, range_entries), window), "found")
    # Rows that are equal in all have the same anchors, so any of them tells what to ask.
    asked = found.where("size(asked) > 0").groupBy("key").agg(F.flatten(F.collect_set("asked")).alias("asked"))
    left = stored(_units(texts.join(small(asked), "key"), window, unit_words, windows), "windows")
    more = _found(left, _codes(left, range_entries), window)
    both = found.select("key", "covered").union(more.select("key", "covered")).where("size(covered) > 0")
    return stored(both.groupBy("key").agg(F.flatten(F.collect_set("covered")).alias("covered")), "covered")


KEPT = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
)


def _without(lists: list[list]) -> list[list]:
    """Counts of words, of removed ones, and the kept words joined by a space."""
    out: list[list] = [[], [], []]
    for text, covered in zip(*lists, strict=True):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if covered:
            keep = np.ones(len(words), dtype=bool)
            for a, b in zip(covered[::2], covered[1::2]):
                keep[a:b] = False
            kept = [words[i] for i in np.flatnonzero(keep).tolist()]
        else:
            kept = words
        for column, value in zip(out, (len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "replace")), strict=True):
            column.append(value)
    return out


def remove_repeats(docs: DataFrame, **options: int) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text of every row of ``docs`` (doc_id long, text)."""
    source = docs.select("doc_id", "text")
    covered = repeats(source, **options)
    rows = source.withColumn("key", _key()).join(small(covered), "key", "left").select("doc_id", "text", "covered")
    return append_columns(rows, ["text", "covered"], KEPT, _without).select("doc_id", *KEPT.names)


def report(cleaned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of the result of :func:`remove_repeats`."""
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
