"""Weighted acyclic automata over words: how often every run of one to three words occurs.

The automaton has three layers. Arcs from the start carry first words, arcs from there second words, and so on; the weight
of an arc is the count of the words on the path to it. States of the second layer with the same arcs and weights are one
state, which is found from the last layer upwards over sorted paths. Arcs are numpy arrays, layer by layer, so that
building, union and composition are sorts and searches over whole layers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard

from lexiloom.llm.common import mixed

_LOW = np.int64(0xFFFFFFFF)


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of the weights of each."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(weights[order], starts)


def _spread(sizes: np.ndarray) -> np.ndarray:
    """Positions of slices of these sizes in one row of arcs, relative to their own starts."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


@dataclass
class Paths:
    """What an automaton says, sorted: single words, pairs (first << 32 | second), and triples by the pair's number."""

    words: list[bytes]
    singles: np.ndarray
    single_counts: np.ndarray
    pairs: np.ndarray
    pair_counts: np.ndarray
    triple_pairs: np.ndarray
    thirds: np.ndarray
    triple_counts: np.ndarray

    def at_least(self, count: int) -> "Paths":
        """Without the paths that are counted less often. A longer path never counts more than its beginning."""
        single, pair, triple = (x >= count for x in (self.single_counts, self.pair_counts, self.triple_counts))
        number = np.cumsum(pair) - 1
        return Paths(
            self.words, self.singles[single], self.single_counts[single], self.pairs[pair], self.pair_counts[pair],
            number[self.triple_pairs[triple]], self.thirds[triple], self.triple_counts[triple],
        ).with_used_words()

    def with_used_words(self) -> "Paths":
        firsts, seconds = self.pairs >> 32, self.pairs & _LOW
        used = np.unique(np.concatenate([self.singles, firsts, seconds, self.thirds]))
        at = lambda x: np.searchsorted(used, x)
        self.words = [self.words[i] for i in used.tolist()]
        self.singles, self.thirds = at(self.singles), at(self.thirds)
        self.pairs = at(firsts) << 32 | at(seconds)
        return self

    def renamed(self, numbers: np.ndarray) -> "Paths":
        """The same paths with other numbers for the words, not sorted by them."""
        pairs = numbers[self.pairs >> 32] << 32 | numbers[self.pairs & _LOW]
        return Paths(
            self.words, numbers[self.singles], self.single_counts, pairs, self.pair_counts,
            self.triple_pairs, numbers[self.thirds], self.triple_counts,
        )


def union(parts: list[Paths]) -> Paths:
    """All paths of ``parts``; weights of equal paths are added."""
    words = sorted(set().union(*(part.words for part in parts)))
    number = {word: i for i, word in enumerate(words)}
    named = [
        part.renamed(np.fromiter(map(number.__getitem__, part.words), dtype=np.int64, count=len(part.words)))
        for part in parts
    ]
    join = lambda field: np.concatenate([getattr(part, field) for part in named])
    singles, single_counts = summed(join("singles"), join("single_counts"))
    pairs, pair_counts = summed(join("pairs"), join("pair_counts"))
    places = np.concatenate([np.searchsorted(pairs, part.pairs)[part.triple_pairs] for part in named])
    triples, triple_counts = summed(places << 32 | join("thirds"), join("triple_counts"))
    return Paths(words, singles, single_counts, pairs, pair_counts, triples >> 32, triples & _LOW, triple_counts)


def compose(asked: Paths, counted: Paths) -> Paths:
    """The single words and pairs of ``asked`` with their weights in ``counted``, 0 where it has no such path."""
    number = {word: i for i, word in enumerate(counted.words)}
    numbers = np.fromiter((number.get(word, -1) for word in asked.words), dtype=np.int64, count=len(asked.words))
    named = asked.renamed(numbers)

    def weights(keys: np.ndarray, of: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(of):
            return np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(of, keys), len(of) - 1)
        return np.where(of[at] == keys, counts[at], 0)

    asked.single_counts = weights(named.singles, counted.singles, counted.single_counts)
    asked.pair_counts = weights(named.pairs, counted.pairs, counted.pair_counts)
    return asked


def acceptor(words: list[bytes], singles: np.ndarray, pairs: np.ndarray) -> Paths:
    """An automaton without weights for some single words and pairs, by numbers of ``words``."""
    none = np.zeros(0, dtype=np.int64)
    singles, pairs = np.unique(singles), np.unique(pairs)
    nothing = np.zeros(len(singles), dtype=np.int64), np.zeros(len(pairs), dtype=np.int64)
    return Paths(words, singles, nothing[0], pairs, nothing[1], none, none, none).with_used_words()


def _merged_states(sizes: np.ndarray, thirds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(state of each pair, first pair of each state): pairs with the same arcs have the same state."""
    starts = np.cumsum(sizes) - sizes
    with np.errstate(over="ignore"):
        arcs = mixed(thirds.astype(np.uint64) << np.uint64(32) ^ mixed(counts.astype(np.uint64) + _spread(sizes).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        total = np.concatenate([[np.uint64(0)], np.cumsum(arcs)])
        marks = mixed(total[starts + sizes] - total[starts] + sizes.astype(np.uint64))
    _, first, state = np.unique(marks, return_index=True, return_inverse=True)
    # Equal hashes are not trusted: arcs are compared with those of the state's first pair.
    of = first[state]
    same = sizes == sizes[of]
    arc_pair = np.repeat(np.arange(len(sizes)), sizes)
    other = np.minimum(starts[of][arc_pair] + _spread(sizes), max(len(thirds) - 1, 0))
    differs = (thirds != thirds[other]) | (counts != counts[other])
    same[arc_pair[differs]] = False
    alone = np.flatnonzero(~same)
    state[alone] = len(first) + np.arange(len(alone))
    first = np.concatenate([first, alone])
    # States are numbered in the order of their first use.
    order = np.argsort(first, kind="stable")
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    return number[state], first[order]


def _plain(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers from 0 as bytes, the low bytes of all numbers first, and so on."""
    out = []
    for array in arrays:
        width = max(1, (int(array.max()).bit_length() + 7) // 8) if len(array) else 1
        planes = np.ascontiguousarray(array.astype("<u8")).view(np.uint8).reshape(-1, 8).T[:width]
        out += [len(array).to_bytes(6, "little"), width.to_bytes(1, "little"), planes.tobytes()]
    return b"".join(out)


def _arrays(data: bytes) -> list[np.ndarray]:
    at, found = 0, []
    while at < len(data):
        n, width = int.from_bytes(data[at : at + 6], "little"), data[at + 6]
        planes = np.zeros((n, 8), dtype=np.uint8)
        planes[:, :width] = np.frombuffer(data, dtype=np.uint8, count=n * width, offset=at + 7).reshape(width, n).T
        found.append(planes.view("<i8").ravel().astype(np.int64))
        at += 7 + n * width
    return found


def to_bytes(paths: Paths) -> bytes:
    """The minimal automaton of ``paths``."""
    sizes = np.bincount(paths.triple_pairs, minlength=len(paths.pairs)).astype(np.int64)
    if len(sizes):
        state, first = _merged_states(sizes, paths.thirds, paths.triple_counts)
        chosen = np.zeros(len(sizes), dtype=bool)
        chosen[first] = True
        arcs = np.repeat(chosen, sizes)
        sizes, thirds, counts = sizes[first], paths.thirds[arcs], paths.triple_counts[arcs]
        # 0 for the next new state, else how far back it is.
        seen = np.maximum.accumulate(state)
        new = np.concatenate([[True], seen[1:] > seen[:-1]])
        state = np.where(new, 0, seen - state + 1)
    else:
        state, thirds, counts = sizes, paths.thirds, paths.triple_counts
    steps = np.diff(paths.singles, prepend=0)
    body = _plain(steps, paths.single_counts, *_steps(paths.pairs), paths.pair_counts, state, sizes, thirds, counts)
    words = b"\n".join(paths.words)
    return zstandard.ZstdCompressor(level=3).compress(len(words).to_bytes(6, "little") + words + body)


def _steps(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted pairs as steps between first words, and second words as steps where the first one stays."""
    firsts, seconds = np.diff(pairs >> 32, prepend=0), pairs & _LOW
    before = np.concatenate([[0], seconds[:-1]])
    return firsts, np.where((firsts == 0) & (np.arange(len(pairs)) > 0), seconds - before, seconds)


def from_bytes(data: bytes) -> Paths:
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(data[:6], "little")
    words = data[6 : 6 + n].split(b"\n") if n else []
    singles, single_counts, firsts, seconds, pair_counts, state, sizes, thirds, counts = _arrays(data[6 + n :])
    if len(firsts):
        starts = np.flatnonzero((firsts > 0) | (np.arange(len(firsts)) == 0))
        total = np.cumsum(seconds)
        base = np.repeat(total[starts] - seconds[starts], np.diff(np.append(starts, len(firsts))))
        seconds = total - base
        new = state == 0
        seen = np.cumsum(new) - 1
        state = np.where(new, seen, seen - state + 1)
        begins = np.cumsum(sizes) - sizes
        fans = sizes[state]
        arcs = np.repeat(begins[state], fans) + _spread(fans)
        triple_pairs = np.repeat(np.arange(len(fans)), fans)
        thirds, counts = thirds[arcs], counts[arcs]
    else:
        triple_pairs = np.zeros(0, dtype=np.int64)
    pairs = np.cumsum(firsts) << 32 | seconds
    return Paths(words, np.cumsum(singles), single_counts, pairs, pair_counts, triple_pairs, thirds, counts)


def from_windows(words: list[bytes], first: np.ndarray, second: np.ndarray, third: np.ndarray) -> Paths:
    """Paths of windows of three word numbers (0 to len(words) - 1 in byte order; -1: the piece has ended)."""
    singles, single_counts = summed(first, np.ones(len(first), dtype=np.int64))
    long = second >= 0
    windows = first[long] << 42 | second[long] << 21 | third[long] + 1
    windows, counts = summed(windows, np.ones(len(windows), dtype=np.int64))
    keys = windows >> 42 << 32 | windows >> 21 & 0x1FFFFF
    pairs, pair_counts = summed(keys, counts)
    thirds = (windows & 0x1FFFFF) - 1
    full = thirds >= 0
    return Paths(words, singles, single_counts, pairs, pair_counts, np.searchsorted(pairs, keys[full]), thirds[full], counts[full])
