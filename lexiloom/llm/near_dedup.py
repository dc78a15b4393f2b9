"""Near-duplicate documents: MinHash signatures, banding, exact verification, connected components.

A document's set holds the 64-bit hashes of its distinct shingles of words (the whole sequence if it is shorter).
Documents with equal sets form a class that is represented by its smallest id; only representatives go on.

1. A signature has one minimum for each of many universal hash functions. Bands of it are bucket keys. Most keys have one
   member: they are counted as packed ranges of sorted keys, once per unit of documents, and only the others become rows.
2. Rounds of stars: each bucket whose members lie in several components so far picks a pivot (the smallest member first,
   then another one by a hash), which is paired with the members of other components. Pairs whose signatures agree too
   little are left out; the likeliest pair of each member is confirmed on the full sets, and components grow. Pairs grow
   with the members of a bucket, not with their square.
3. Only buckets whose members still lie in several components can hold a link that matters. Their members are dealt into
   blocks by a hash, and two blocks of a bucket meet once. First only sketches of the signatures meet: they tell which
   members can have a partner in another component. Then these meet with their full sets and are confirmed right there,
   each pair in the first bucket that it shares. Only links that join two components leave a block.

The chance that a pair at the threshold shares no band is (1 - t^rows)^bands, about 1e-6; that its signatures agree too
little is below 1e-6.

Null or empty texts, and texts without words, have an empty set and are linked with nothing. Every row is returned. Rows
that repeat an id are one document, linked with what any of its texts is linked with. Rows without an id are returned
with a null component and are kept. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from lexiloom.llm.common import append_columns, shingle_hashes, small, stored, word_hashes
from lexiloom.llm.components import components
from lexiloom.llm.substring_dedup import ALONE, UNIT, _codes, _unit

SHINGLE_WORDS = 5
#: Least similarity of linked documents, in hundredths.
THRESHOLD = 75
BANDS = 50
BAND_ROWS = 5
#: Least share of equal minima; lower ones come from a pair at the threshold with a chance below 1e-6.
LEAST_AGREEMENT = 0.62
#: Rounds of stars before blocks meet.
ROUNDS = 2
#: Members of a block, and bytes of their sets, about.
BLOCK_MEMBERS, BLOCK_BYTES = 512, 8_000_000
#: Documents whose keys are counted together, and keys of a range.
UNIT_DOCUMENTS, RANGE_KEYS = 4_000, 250_000

SIGNED = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_hash", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.BinaryType()),
    ]
)


def shingle_set(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of the lower-cased (A-Z) text."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    return np.unique(shingle_hashes(word_hashes(tokens), words))


#: Factors (odd) and offsets of the universal hash functions a * x + b modulo 2^32.
_RANDOM = np.random.default_rng(20)
FACTORS = _RANDOM.integers(0, 2**32, (BANDS * BAND_ROWS, 1), dtype=np.uint32) | np.uint32(1)
OFFSETS = _RANDOM.integers(0, 2**32, (BANDS * BAND_ROWS, 1), dtype=np.uint32)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minima of all hash functions over a set that is not empty."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    found = np.full(BANDS * BAND_ROWS, 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(low), 512):
        np.minimum(found, (FACTORS * low[at : at + 512] + OFFSETS).min(axis=1), out=found)
    return found


def band_keys(minima: np.ndarray) -> list[int]:
    rows = minima.reshape(BANDS, BAND_ROWS)
    return [xxhash.xxh3_64_intdigest(row.tobytes(), seed=at) - 2**63 for at, row in enumerate(rows)]


def _sign(lists: list[list]) -> list[list]:
    sizes, digests, bands, sketches = [], [], [], []
    for text in lists[0]:
        found = shingle_set(text)
        sizes.append(len(found))
        if len(found):
            minima = signature(found)
            digests.append(xxhash.xxh3_128_digest(found.tobytes()))
            bands.append(band_keys(minima))
            # Minima of large sets are small numbers; a mixed byte still tells them apart.
            sketches.append(((minima * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes())
        else:
            digests.append(None)
            bands.append(None)
            sketches.append(None)
    return [sizes, digests, bands, sketches]


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity from one byte of each minimum."""
    equal = (a == b).mean(axis=-1)
    return (equal - 1 / 256) / (1 - 1 / 256)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough; ``texts``: id, text."""
    rows = (
        pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def check(lists: list[list]) -> list[list]:
        sets: dict[str, np.ndarray] = {}

        def of(text: str) -> np.ndarray:
            if text not in sets:
                sets[text] = shingle_set(text)
            return sets[text]

        linked = []
        for x, y in zip(*lists, strict=True):
            linked.append(_similar(of(x), of(y)))
        return [linked]

    outputs = T.StructType([T.StructField("linked", T.BooleanType())])
    return append_columns(rows, ["text_a", "text_b"], outputs, check).where("linked").select("a", "b")


AGREEMENT = T.StructType([T.StructField("agreement", T.DoubleType())])


def _agreed(rows: DataFrame) -> DataFrame:
    """Those of ``rows`` (sketch_a, sketch_b, ...) whose signatures agree enough to be worth a full check."""

    def check(lists: list[list]) -> list[list]:
        one, two = (np.frombuffer(b"".join(x), dtype=np.uint8).reshape(len(x), -1) for x in lists)
        return [_agreement(one, two).tolist()]

    rows = append_columns(rows, ["sketch_a", "sketch_b"], AGREEMENT, check, 2048)
    return rows.where(F.col("agreement") >= LEAST_AGREEMENT).drop("sketch_a", "sketch_b")


def _similar(one: np.ndarray, two: np.ndarray) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both > 0 and 100 * both >= THRESHOLD * (len(one) + len(two) - both)


def _root(parents: dict[int, int], node: int) -> int:
    while node in parents:
        node = parents[node]
    return node


def _buckets(classes: DataFrame) -> DataFrame:
    """(key, id) of the bands of ``classes`` (id, bands) whose key has more than one member.

    Keys travel packed and sorted, each once per unit; what comes back is a code for each.
    """

    def read(batches):
        number = TaskContext.get().partitionId() << 33
        ids: list[int] = []
        bands: list[np.ndarray] = []

        def closed() -> pa.RecordBatch:
            name = np.concatenate(bands).view(np.uint64)
            text = np.repeat(np.arange(len(ids)), [len(x) for x in bands])
            keys = [i.to_bytes(16, "little", signed=True) for i in ids]
            nothing = np.zeros(len(name), dtype=np.int32)
            return _unit(keys, text, nothing, nothing, name, np.zeros((len(name), 2), dtype=np.uint64), number)

        for batch in batches:
            lists = batch.column(1)
            for at, i in enumerate(batch.column(0).to_pylist()):
                ids.append(i)
                bands.append(lists[at].values.to_numpy())
                if len(ids) == UNIT_DOCUMENTS:
                    yield closed()
                    number, ids, bands = number + 1, [], []
        if ids:
            yield closed()

    def members(batches):
        for batch in batches:
            for keys, texts, entries, names, codes in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                entry = np.frombuffer(entries, dtype=np.int32)
                shared = np.flatnonzero((np.frombuffer(codes, dtype=np.uint8) != ALONE)[entry])
                text = np.frombuffer(texts, dtype=np.int32)[shared]
                ids = np.frombuffer(keys, dtype=np.int64).reshape(-1, 2)[text, 0]
                key = np.frombuffer(names, dtype=np.int64)[entry[shared]]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids)], names=["key", "id"])

    units = stored(classes.select("id", "bands").mapInArrow(read, UNIT), "units")
    codes = _codes(units, RANGE_KEYS)
    joined = units.select("unit", "keys", "texts", "entry", "name").join(small(codes), "unit")
    return joined.select("keys", "texts", "entry", "name", "codes").mapInArrow(members, "key long, id long").distinct()


def _met(members: DataFrame, *carried: str) -> DataFrame:
    """(key, members, own): the members of two blocks of a bucket, or of one (own), with the columns ``carried``."""
    packed = (
        members.withColumn("block", F.expr("pmod(xxhash64(id), blocks)"))
        .groupBy("key", "blocks", "block")
        .agg(F.collect_list(F.struct("id", "component", "block", *carried)).alias("members"))
    )
    # Two blocks meet once, under the pair of their numbers; a block also meets itself.
    others = "transform(sequence(0L, blocks - 1), x -> struct(least(x, block) as i, greatest(x, block) as j))"
    return (
        packed.withColumn("meeting", F.explode(F.expr(others)))
        .groupBy("key", "meeting")
        .agg(F.flatten(F.collect_list("members")).alias("members"))
        .select("key", "members", F.expr("meeting.i = meeting.j").alias("own"))
    )


def _possible(members: DataFrame) -> DataFrame:
    """Distinct (id) of the members that may be similar to a member of their bucket in another component.

    ``members``: key, id, component, n_shingles, sketch, blocks. Only sketches travel, no sets.
    """

    def find(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.column(1)[at].as_py()
                ids, kinds, sizes = (np.array([x[name] for x in row]) for name in ("id", "component", "n_shingles"))
                bits = np.frombuffer(b"".join(x["sketch"] for x in row), dtype=np.uint8).reshape(len(row), -1)
                found = np.zeros(len(row), dtype=bool)
                for i in range(len(row) - 1):
                    low, high = np.minimum(sizes[i + 1 :], sizes[i]), np.maximum(sizes[i + 1 :], sizes[i])
                    rest = np.flatnonzero((kinds[i + 1 :] != kinds[i]) & (100 * low >= THRESHOLD * high)) + i + 1
                    rest = rest[_agreement(bits[i], bits[rest]) >= LEAST_AGREEMENT] if len(rest) else rest
                    if len(rest):
                        found[i] = found[rest] = True
                if found.any():
                    yield pa.RecordBatch.from_arrays([pa.array(ids[found], pa.int64())], names=["id"])

    return _met(members, "n_shingles", "sketch").mapInArrow(find, "id long").distinct()


def _block_links(members: DataFrame) -> DataFrame:
    """Links (a, b) between components, among the members of each bucket.

    ``members``: key, id, component, sketch, bands, hashes (the full set), blocks (number of blocks of the bucket).
    """
    met = _met(members, "sketch", "bands", "hashes")

    def links_of(key: int, row: list[dict], own: bool) -> list[tuple[int, int]]:
        ids, kinds, blocks = (np.array([x[name] for x in row]) for name in ("id", "component", "block"))
        bits = np.frombuffer(b"".join(x["sketch"] for x in row), dtype=np.uint8).reshape(len(row), -1)
        bands = np.array([x["bands"] for x in row])
        sets = [np.frombuffer(x["hashes"], dtype=np.uint64) for x in row]
        sizes = np.array([len(x) for x in sets])
        parents: dict[int, int] = {}
        found = []
        for at in range(len(row) - 1):
            other = kinds[at + 1 :] != kinds[at]
            if not own:
                other &= blocks[at + 1 :] != blocks[at]
            # Sets of too different sizes cannot be similar.
            low, high = np.minimum(sizes[at + 1 :], sizes[at]), np.maximum(sizes[at + 1 :], sizes[at])
            rest = np.flatnonzero(other & (100 * low >= THRESHOLD * high)) + at + 1
            if not len(rest):
                continue
            rest = rest[_agreement(bits[at], bits[rest]) >= LEAST_AGREEMENT]
            first = (bands[rest] == bands[at]).argmax(axis=1)
            for i in rest[bands[at][first] == key].tolist():
                one, two = _root(parents, int(kinds[at])), _root(parents, int(kinds[i]))
                if one != two and _similar(sets[at], sets[i]):
                    parents[max(one, two)] = min(one, two)
                    found.append((min(ids[at], ids[i]), max(ids[at], ids[i])))
        return found

    def compare(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                key, row, own = (column[at].as_py() for column in batch.columns)
                if found := links_of(key, row, own):
                    a, b = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return met.mapInArrow(compare, "a long, b long").distinct()


class _Links:
    """Components of the links confirmed so far; new links are merged between components."""

    def __init__(self, texts: DataFrame, links: DataFrame | None):
        self.texts = texts
        self.found: DataFrame | None = None
        if links is not None:
            self.add(links)

    def add(self, links: DataFrame) -> None:
        if self.found is None:
            self.found = stored(components(links.select("a", "b")), "components")
            return
        links = stored(links.select("a", "b"), "links")
        ends = self.component_of(self.component_of(links, "a", "u"), "b", "v")
        # Few edges: one for each pair of components that a new link joins.
        merged = components(ends.where("u <> v").select("u", "v").distinct())
        merged = merged.select(F.col("node").alias("component"), F.col("component").alias("_merged"))
        new = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(self.found, "node", "left_anti")
        known = self.found.union(new.select("node", F.col("node").alias("component")))
        known = known.join(merged, "component", "left")
        self.found = stored(known.select("node", F.coalesce("_merged", "component").alias("component")), "components")

    def component_of(self, rows: DataFrame, column: str, name: str) -> DataFrame:
        """``rows`` with the component of an id column; an id without links is its own."""
        if self.found is None:
            return rows.withColumn(name, F.col(column))
        known = self.found.select(F.col("node").alias(column), F.col("component").alias("_known"))
        return rows.join(known, column, "left").withColumn(name, F.coalesce("_known", column)).drop("_known")

    def confirm(self, pairs: DataFrame) -> None:
        """Check ``pairs`` (a, b; stored) on the full sets and extend the components."""
        ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
        self.add(_verified(pairs, self.texts.join(small(ids), "id", "left_semi")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id long, text)."""
    source = docs.select("doc_id", "text")
    signed = stored(append_columns(source, ["text"], SIGNED, _sign).drop("text"), "signed")
    known = signed.where("doc_id is not null and set_hash is not null")
    # Equal sets have equal signatures, so any row of a class will do.
    classes = stored(
        known.groupBy("set_hash").agg(
            F.min("doc_id").alias("id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
            F.first("n_shingles").alias("n_shingles"),
        ),
        "classes",
    )
    repeated = stored(
        known.groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("set_hash").alias("low"), F.max("set_hash").alias("high"))
        .where("n > 1"),
        "repeated",
    )
    members = stored(_buckets(classes), "members")
    ids = stored(members.select("id").distinct(), "ids")
    texts = source.where("text is not null").withColumnRenamed("doc_id", "id").join(small(ids), "id", "left_semi")
    own = None
    if not repeated.isEmpty():
        # Each text of an id once; the sets of one document belong together.
        texts = texts.groupBy("id", F.xxhash64("text"), F.md5("text")).agg(F.first("text").alias("text"))
        several = repeated.where("low <> high").select("doc_id")
        own = known.join(several, "doc_id", "left_semi").join(classes.select("set_hash", "id"), "set_hash")
        own = own.select(F.col("id").alias("a"), F.col("doc_id").alias("b")).where("a <> b").distinct()
    state = _Links(stored(texts.select("id", "text"), "texts"), own)

    sketches = stored(classes.select("id", "sketch").join(small(ids), "id", "left_semi"), "sketches")
    for number in range(ROUNDS):
        placed = state.component_of(members.select("key", "id"), "id", "component")
        order = F.xxhash64("id", "key", F.lit(number)) if number else F.col("id")
        pivot = F.min_by(F.struct("id", "component"), order).alias("pivot")
        open_keys = placed.groupBy("key").agg(pivot, F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key", "pivot")
        members = stored(placed.join(open_keys, "key"), "members")
        pairs = members.where("component <> pivot.component").select("id", F.col("pivot.id").alias("other")).distinct()
        pairs = pairs.join(sketches.withColumnRenamed("sketch", "sketch_a"), "id")
        pairs = pairs.join(sketches.select(F.col("id").alias("other"), F.col("sketch").alias("sketch_b")), "other")
        best = _agreed(pairs).groupBy("id").agg(F.max(F.struct("agreement", "other")).alias("best"))
        best = stored(best.select(F.least("id", "best.other").alias("a"), F.greatest("id", "best.other").alias("b")).distinct(), "pairs")
        if not best.isEmpty():
            state.confirm(best)

    placed = state.component_of(members.select("key", "id"), "id", "component")
    weights = classes.select("id", "n_shingles", "sketch", "bands")
    sizes = classes.select("id", "n_shingles").join(small(ids), "id", "left_semi")
    ends = F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size")
    # As many blocks as their members and the bytes of their sets ask for.
    blocks = f"cast(greatest(ceil(size / {BLOCK_MEMBERS}), ceil(bytes / {BLOCK_BYTES})) as long) as blocks"
    sized = placed.join(sizes, "id")
    open_keys = sized.groupBy("key").agg(*ends, F.sum(8 * F.col("n_shingles")).alias("bytes")).where("low < high")
    open_members = stored(placed.join(open_keys.selectExpr("key", blocks), "key"), "members")
    if not open_members.isEmpty():
        # As often as blocks of a bucket meet, but without sets.
        ids = stored(_possible(open_members.join(sketches, "id").join(sizes, "id")), "ids")
        open_members = stored(open_members.join(small(ids), "id", "left_semi"), "members")
    if not open_members.isEmpty():
        hashes = T.StructType([T.StructField("hashes", T.BinaryType())])
        full = append_columns(
            state.texts.join(small(ids), "id", "left_semi"),
            ["text"], hashes, lambda lists: [[shingle_set(text).tobytes() for text in lists[0]]],
        ).drop("text")
        rows = open_members.join(weights.drop("n_shingles").join(full, "id"), "id")
        state.add(_block_links(rows.select("key", "id", "component", "sketch", "bands", "hashes", "blocks")))

    named = state.component_of(classes.select("set_hash", "id"), "id", "component_id").select("set_hash", "component_id")
    rows = signed.select("doc_id", "n_shingles", "set_hash")
    # Rows without words have no class; they must not meet under one missing key.
    wordless = rows.where("set_hash is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return (
        rows.where("set_hash is not null")
        .join(small(named), "set_hash", "left")
        .select("doc_id", "n_shingles", "component_id")
        .union(wordless)
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that represent their group of near duplicates, one for each; rows without an id stay."""
    kept = near_duplicates(docs).where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    kept = stored(kept, "kept")
    once = docs.join(small(kept.where("_n = 1 and doc_id is not null").select("doc_id")), "doc_id", "left_semi")
    rows = once.select(docs.columns).union(docs.where("doc_id is null"))
    again = kept.where("_n > 1 and doc_id is not null").select("doc_id")
    if again.isEmpty():
        return rows
    repeated = docs.join(again, "doc_id", "left_semi").select(docs.columns)
    # Of rows that repeat an id, the one with the smallest text stays.
    chosen = repeated.groupBy("doc_id").agg(F.min(F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])).alias("_row"))
    return rows.union(chosen.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"_row.`{c}`") for c in docs.columns]))
