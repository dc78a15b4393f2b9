"""Phrase collocations from weighted acyclic automata.

1. Each task reads texts into shards of a bounded number of words. The sorted n-grams of a shard become one count transducer
   per language (see automata.py), cut by ranges of the hash of the first words: pairs and what follows them by the hash of
   both words, single words by their own. A frequent first word is thus spread over all ranges.
2. The automata of a range are united one after another and their weights added; paths below the least count are cut off. That
   is exact: a phrase never occurs more often than its parts, so no part of a candidate is lost.
3. Parts of candidates whose counts lie in other ranges are asked for by acceptors, one for each pair of ranges, which are
   composed with the transducer of the range. Each part is asked for once, however many candidates share it.
4. Scores are computed in unbounded integers; a phrase inside a longer candidate that occurs half as often or more is dropped.

The number of ranges follows the size of the texts, so a range fits a task whatever the size of the corpus. The united counts
are written to the shared folder.

A null language is ``und``, a null or empty text has no words; repeated rows count one by one. A language without candidates
has no row, and neither has an empty table. Other columns are not read. Memory follows a shard, a range or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count as counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lexiloom.llm import automata
from lexiloom.llm.automata import Paths
from lexiloom.llm.common import MIX_2, mixed, stored, word_hashes

LEAST_COUNT = 10
TOP = 2000
#: Words of a shard (below 2^21, as three numbers of words share 63 bits).
SHARD_WORDS = 2_000_000
#: Bytes of text that one range stands for, about.
RANGE_BYTES = 32 << 20
#: Paths of three words that are read before they are united.
WAITING_PATHS = 2_000_000
#: Rows whose texts are split at a time.
ROWS = 512

_MARKS = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b"......... ")
_TABLE = pa.schema([("lang", pa.string()), ("range", pa.int32()), ("data", pa.binary())])


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words, with ``.`` between pieces."""
    return text.lower().translate(_MARKS).replace(b".", b" . ").split()


class _Shard:
    """Windows of up to three words of one language, by numbers of words in the order of their first use; 0 ends a piece."""

    def __init__(self):
        new = counter()
        self.numbers: dict[bytes, int] = {b".": next(new)}
        self.new = new
        self.windows: list[np.ndarray] = []

    def add(self, words: list[bytes], starts: int) -> None:
        """The windows that begin at the first ``starts`` of ``words``."""
        numbers, new = self.numbers, self.new
        for word in words:
            if word not in numbers:
                numbers[word] = next(new)
        ids = np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words))
        padded = np.concatenate([ids, np.zeros(2, dtype=np.int32)])
        first, second, third = (padded[i : i + starts] for i in range(3))
        inside = first > 0
        self.windows.append(np.stack([first, second, np.where(second > 0, third, 0)])[:, inside])

    def paths(self) -> Paths:
        words = list(self.numbers)
        order = sorted(range(1, len(words)), key=words.__getitem__)
        rank = np.full(len(words), -1, dtype=np.int64)
        rank[order] = np.arange(len(order))
        first, second, third = rank[np.concatenate(self.windows, axis=1)]
        return automata.from_windows([words[i] for i in order], first, second, third)


def _ranges(paths: Paths, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The range of each single word and of each pair."""
    hashes = word_hashes(paths.words)
    with np.errstate(over="ignore"):
        pairs = mixed(hashes[paths.pairs >> 32] * MIX_2 + hashes[paths.pairs & 0xFFFFFFFF])
    place = lambda x: ((x >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    return place(mixed(hashes[paths.singles])), place(pairs)


def _cut(paths: Paths, ranges: int) -> Iterator[tuple[int, Paths]]:
    """The part of an automaton that belongs to each range."""
    of_single, of_pair = _ranges(paths, ranges)
    of_triple = of_pair[paths.triple_pairs]
    for at in range(ranges):
        single, pair, triple = of_single == at, of_pair == at, of_triple == at
        if single.any() or pair.any():
            number = np.cumsum(pair) - 1
            yield at, Paths(
                paths.words, paths.singles[single], paths.single_counts[single], paths.pairs[pair], paths.pair_counts[pair],
                number[paths.triple_pairs[triple]], paths.thirds[triple], paths.triple_counts[triple],
            ).with_used_words()


def _shards(docs: DataFrame, ranges: int, shard_words: int) -> DataFrame:
    """(lang, range, data): count transducers of all shards."""

    def closed(shards: dict[str, _Shard]) -> Iterator[pa.RecordBatch]:
        for lang, shard in shards.items():
            for at, part in _cut(shard.paths(), ranges):
                yield pa.RecordBatch.from_arrays([[lang], pa.array([at], pa.int32()), [automata.to_bytes(part)]], schema=_TABLE)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, _Shard] = {}
        size = 0
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts: dict[str, list[bytes]] = {}
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    texts.setdefault(lang, []).append(text)
                for lang, some in texts.items():
                    words = tokens(b".".join(some))
                    for start in range(0, len(words), shard_words):
                        piece = words[start : start + shard_words + 2]
                        starts = min(shard_words, len(words) - start)
                        if size and size + starts > shard_words:
                            yield from closed(shards)
                            shards, size = {}, 0
                        shards.setdefault(lang, _Shard()).add(piece, starts)
                        size += starts
        yield from closed(shards)

    lang = F.coalesce("lang", F.lit("und")).alias("lang")
    return docs.where("text is not null").select(lang, "text").mapInArrow(read, "lang string, range int, data binary")


def _united(shards: DataFrame, least: int) -> DataFrame:
    """(lang, range, n, data): one transducer per range, without rare paths; n counts the words of the range."""

    def unite(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Parts are united many at a time, so that a path is moved and a word is numbered a few times only.
        runs: list[Paths] = []
        waiting: list[Paths] = []
        paths = 0
        for batch in batches:
            for data in batch.column("data"):
                waiting.append(automata.from_bytes(data.as_py()))
                paths += len(waiting[-1].triple_counts)
                if paths >= WAITING_PATHS:
                    runs.append(automata.union(waiting))
                    waiting, paths = [], 0
                    # Runs of like sizes are united, so this happens a logarithmic number of times.
                    while len(runs) > 1 and 2 * len(runs[-1].triple_counts) >= len(runs[-2].triple_counts):
                        runs.append(automata.union([runs.pop(), runs.pop()]))
        whole = automata.union([*runs, *waiting])
        n = int(whole.single_counts.sum())
        data = automata.to_bytes(whole.at_least(least))
        yield pa.RecordBatch.from_arrays(
            [[key[0].as_py()], pa.array([key[1].as_py()], pa.int32()), pa.array([n], pa.int64()), [data]],
            names=["lang", "range", "n", "data"],
        )

    return shards.groupBy("lang", "range").applyInArrow(unite, "lang string, range int, n long, data binary")


def _asked(counts: DataFrame, ranges: int) -> DataFrame:
    """(lang, range, origin, data): acceptors of the parts that candidates of a range need from each range."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, origin, data in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                paths = automata.from_bytes(data)
                firsts, seconds = paths.pairs >> 32, paths.pairs & 0xFFFFFFFF
                needed = automata.acceptor(
                    paths.words, np.concatenate([firsts, seconds, paths.thirds]), seconds[paths.triple_pairs] << 32 | paths.thirds
                )
                for at, part in _cut(needed, ranges):
                    yield pa.RecordBatch.from_arrays(
                        [[lang], pa.array([at], pa.int32()), pa.array([origin], pa.int32()), [automata.to_bytes(part)]],
                        names=["lang", "range", "origin", "data"],
                    )

    return counts.select("lang", "range", "data").mapInArrow(ask, "lang string, range int, origin int, data binary")


def _answered(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, origin, data): the acceptors with the counts of the range that they went to."""

    def answer(requests: pa.Table, known: pa.Table) -> pa.Table:
        counted = automata.from_bytes(known["data"][0].as_py()) if known.num_rows else None
        found = []
        for data in requests["data"]:
            part = automata.from_bytes(data.as_py())
            found.append(automata.to_bytes(automata.compose(part, counted) if counted else part))
        return pa.table({"lang": requests["lang"], "origin": requests["origin"], "data": pa.array(found, pa.binary())})

    groups = asked.groupBy("lang", "range").cogroup(counts.select("lang", "range", "data").groupBy("lang", "range"))
    return groups.applyInArrow(answer, "lang string, origin int, data binary")


def _scored(counts: DataFrame, answered: DataFrame) -> DataFrame:
    """(lang, phrase, first_pair, last_pair, a, l, r, score) of all candidates; the pairs only of three words."""

    def score(known: pa.Table, answers: pa.Table) -> pa.Table:
        rows = {name: [] for name in ("phrase", "first_pair", "last_pair", "a", "l", "r", "score")}
        if known.num_rows and answers.num_rows:
            paths = automata.from_bytes(known["data"][0].as_py())
            words = paths.words
            single: dict[bytes, int] = {}
            pair: dict[bytes, int] = {}
            for data in answers["data"]:
                part = automata.from_bytes(data.as_py())
                single.update(zip((part.words[i] for i in part.singles.tolist()), part.single_counts.tolist(), strict=True))
                for key, n in zip(part.pairs.tolist(), part.pair_counts.tolist(), strict=True):
                    pair[part.words[key >> 32] + b" " + part.words[key & 0xFFFFFFFF]] = n

            def add(phrase: bytes, pairs: tuple[bytes, bytes] | None, a: int, cuts: list[tuple[int, int]]) -> None:
                worth = [(1_000_000 * a * a // (left * right), k) for k, (left, right) in enumerate(cuts)]
                least, k = min(worth)
                values = (phrase, *(pairs or (None, None)), a, *cuts[k], least)
                for column, value in zip(rows.values(), values, strict=True):
                    column.append(value)

            pair_counts = paths.pair_counts.tolist()
            names = []
            for key, a in zip(paths.pairs.tolist(), pair_counts, strict=True):
                one, two = words[key >> 32], words[key & 0xFFFFFFFF]
                names.append((one, two))
                add(one + b" " + two, None, a, [(single[one], single[two])])
            triples = zip(paths.triple_pairs.tolist(), paths.thirds.tolist(), paths.triple_counts.tolist(), strict=True)
            for number, third, a in triples:
                (one, two), three = names[number], words[third]
                first_pair, last_pair = one + b" " + two, two + b" " + three
                cuts = [(single[one], pair[last_pair]), (pair_counts[number], single[three])]
                add(first_pair + b" " + three, (first_pair, last_pair), a, cuts)
        texts = {name: pa.array(rows[name], pa.binary()).cast(pa.string()) for name in ("phrase", "first_pair", "last_pair")}
        numbers = {name: pa.array(rows[name], pa.int64()) for name in ("a", "l", "r", "score")}
        lang = pa.array([known["lang"][0].as_py() if known.num_rows else None] * len(rows["a"]), pa.string())
        return pa.table({"lang": lang, **texts, **numbers})

    groups = counts.select("lang", "range", "data").groupBy("lang", "range").cogroup(answered.groupBy("lang", "origin"))
    return groups.applyInArrow(
        score, "lang string, phrase string, first_pair string, last_pair string, a long, l long, r long, score long"
    )


def candidates(
    docs: DataFrame, least: int = LEAST_COUNT, range_bytes: int = RANGE_BYTES, shard_words: int = SHARD_WORDS
) -> tuple[DataFrame, DataFrame]:
    """All candidate phrases with their scores, and the words of each language (lang, n)."""
    if not 0 < shard_words < 1 << 21:
        raise ValueError("shard_words must be below 2^21")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(1, -(-size // range_bytes))
    counts = stored(_united(_shards(docs, ranges, shard_words), least), "counts")
    found = stored(_scored(counts, _answered(_asked(counts, ranges), counts)), "candidates")
    return found, counts.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(
    docs: DataFrame,
    least: int = LEAST_COUNT,
    top: int = TOP,
    inside_share: int = 50,
    range_bytes: int = RANGE_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` phrases of each language.

    ``inside_share``: a phrase is dropped if a longer candidate around it has at least this share (in hundredths) of its count.
    """
    found, totals = candidates(docs, least, range_bytes, shard_words)
    around = (
        found.where("first_pair is not null")
        .select("lang", "a", F.explode(F.array("first_pair", "last_pair")).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    free = found.join(around, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {inside_share} * a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = free.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = f"""
with texts as (
  select row_number() over () as doc, coalesce(lang, 'und') as lang,
    string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n-\\r]') as pieces
  from documents where text is not null),
pieces as (select doc, lang, unnest(pieces) as piece, generate_subscripts(pieces, 1) as p from texts),
words as (
  select doc, lang, p, unnest(w) as w, generate_subscripts(w, 1) as i
  from (select doc, lang, p, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') as w from pieces)),
runs as (
  select lang, w, lead(w) over s as w2, lead(w, 2) over s as w3 from words window s as (partition by doc, p order by i)),
f1 as (select lang, w, count(*) as n from runs group by lang, w),
f2 as (select lang, w, w2, count(*) as n from runs where w2 is not null group by lang, w, w2 having count(*) >= {LEAST_COUNT}),
f3 as (select lang, w, w2, w3, count(*) as n from runs where w3 is not null group by all having count(*) >= {LEAST_COUNT}),
cuts as (
  select lang, w || ' ' || w2 as phrase, 1 as k, f2.n as a, x.n as l, y.n as r
  from f2 join f1 x using (lang, w) join (select lang, w as w2, n from f1) y using (lang, w2)
  union all
  select f3.lang, f3.w || ' ' || f3.w2 || ' ' || f3.w3, 1, f3.n, x.n, y.n
  from f3 join f1 x on x.lang = f3.lang and x.w = f3.w join f2 y on y.lang = f3.lang and y.w = f3.w2 and y.w2 = f3.w3
  union all
  select f3.lang, f3.w || ' ' || f3.w2 || ' ' || f3.w3, 2, f3.n, x.n, y.n
  from f3 join f2 x on x.lang = f3.lang and x.w = f3.w and x.w2 = f3.w2 join f1 y on y.lang = f3.lang and y.w = f3.w3),
scored as (select *, (1000000::hugeint * a * a) // (l::hugeint * r) as score from cuts),
chosen as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
around as (
  select lang, phrase, max(n) as longer
  from (select lang, w || ' ' || w2 as phrase, n from f3 union all select lang, w2 || ' ' || w3, n from f3) group by lang, phrase),
ranked as (
  select c.*, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from chosen c left join around o using (lang, phrase) where longer is null or 100 * longer < 50 * a),
totals as (select lang, sum(n) as n from f1 group by lang)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, t.n::bigint as n, score::bigint as score
from ranked join totals t using (lang) where rank <= {TOP}
"""
