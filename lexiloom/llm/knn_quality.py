"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is described by hashed counts: of its character trigrams, of runs of four character kinds (small and capital
letters, digits, white space, each punctuation mark) and of words that repeat one of the words just before them. The counts
are damped by logarithms and weighted by inverse document frequency. A truncated singular value decomposition of a bounded
sample of labelled texts gives the latent space, in which the labelled texts keep their vectors. These and the projection
are broadcast; every document is projected and compared with all labelled vectors in blocks, by exact cosine products. The
labels of the nearest ones, weighted by their similarity, give the score.

Labels with a null id or value, or with two values for one id, are not used; rows of the held-out part are never learned
from. Null texts and texts without characters score 0. Without labels the score is 0. Repeated rows are judged one by one.
Language, source and id are no inputs. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from lexiloom.llm.common import append_columns

#: Labelled rows that are compared with, at most; the first in the order of a hash of their id.
SAMPLE_ROWS = 3_000
DIMENSIONS = 64
NEIGHBOURS = 15
CUT = 0.7
TRIGRAM_BINS, KIND_BINS, REPEAT_BINS = 2_048, 2_048, 16
BINS = TRIGRAM_BINS + KIND_BINS + REPEAT_BINS

#: Kind of each byte: letters (and bytes beyond ASCII), capitals, digits, white space, and each mark by itself.
_KINDS = np.array(
    [
        1 if 97 <= c <= 122 or c > 127 else 2 if 65 <= c <= 90 else 3 if 48 <= c <= 57 else 4 if c in b" \t\n\r\x0b\x0c" else c + 5
        for c in range(256)
    ],
    dtype=np.uint32,
)


def counts_of(text: str | None) -> np.ndarray | None:
    """Damped counts of one text; None if it has no characters."""
    if not text:
        return None
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, dtype=np.uint8)
    letters = np.concatenate([[32], data, [32]]).astype(np.uint32)
    trigrams = (letters[:-2] * np.uint32(65_599) + letters[1:-1]) * np.uint32(65_599) + letters[2:]
    kinds = _KINDS[np.concatenate([[32, 32], data, [32]])]
    runs = ((kinds[:-3] * np.uint32(257) + kinds[1:-2]) * np.uint32(257) + kinds[2:-1]) * np.uint32(257) + kinds[3:]
    found = np.zeros(BINS, dtype=np.float32)
    shift = np.uint32(32 - 11)
    for bins, at, values in ((TRIGRAM_BINS, 0, trigrams), (KIND_BINS, TRIGRAM_BINS, runs)):
        found[at : at + bins] = np.bincount((values * np.uint32(2_654_435_761)) >> shift, minlength=bins)
    words = raw.split()
    if len(words) > 1:
        seen: dict[bytes, int] = {}
        again = 0
        for at, word in enumerate(words):
            if at - seen.get(word, -1_000) == 1:
                again += 1
            seen[word] = at
        share = again / len(words)
        # The share of immediate repeats, in steps, counted like a word of the text.
        found[TRIGRAM_BINS + KIND_BINS + min(int(share * REPEAT_BINS), REPEAT_BINS - 1)] = len(words) * share
    return np.log1p(found)


@dataclass(frozen=True)
class Space:
    """Weights of the bins, projection to the latent space, vectors and labels of the labelled texts."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


def space_of(counts: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Space:
    """Truncated singular value decomposition by power iteration from a fixed start."""
    weights = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    rows = _unit(counts * weights)
    start = np.random.default_rng(2).standard_normal((rows.shape[1], min(dimensions + 16, *rows.shape))).astype(np.float32)
    for _ in range(6):
        start, _ = np.linalg.qr(rows.T @ (rows @ start))
    left, values, right = np.linalg.svd(rows @ start, full_matrices=False)
    projection = (start @ right.T)[:, :dimensions].astype(np.float32)
    return Space(weights, projection, _unit(rows @ projection), labels.astype(np.float32))


def vote(space: Space, counts: list[np.ndarray | None], neighbours: int = NEIGHBOURS) -> list[float]:
    """Scores of a block of texts: labels of the nearest labelled vectors, weighted by similarity."""
    scores = [0.0] * len(counts)
    known = [i for i, row in enumerate(counts) if row is not None]
    if not known or not len(space.labels):
        return scores
    block = _unit(_unit(np.stack([counts[i] for i in known]) * space.weights) @ space.projection)
    cosine = block @ space.vectors.T
    most = min(neighbours, cosine.shape[1])
    nearest = np.argpartition(-cosine, most - 1, axis=1)[:, :most]
    near = np.clip(np.take_along_axis(cosine, nearest, axis=1), 0, None).astype(np.float64) ** 4 + 1e-9
    found = (near * space.labels[nearest]).sum(axis=1) / near.sum(axis=1)
    for i, value in zip(known, np.clip(found, 0, 1).tolist(), strict=True):
        scores[i] = value
    return scores


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Space:
    """The latent space of at most ``sample_rows`` labelled documents outside the held-out part."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where("low = high")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
        .select("doc_id", F.col("low").cast("int").alias("_quality"))
    )
    outputs = T.StructType([T.StructField("_counts", T.BinaryType())])

    def counted(lists: list[list]) -> list[list]:
        rows = [counts_of(text) for text in lists[0]]
        return [[None if row is None else row.astype(np.float16).tobytes() for row in rows]]

    # At most sample_rows rows of a fixed size reach the driver.
    found = append_columns(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), ["text"], outputs, counted)
    rows = found.where("_counts is not null").dropDuplicates(["doc_id"]).select("doc_id", "_quality", "_counts").collect()
    rows.sort(key=lambda r: r["doc_id"])
    if not rows:
        empty = np.zeros((0, DIMENSIONS), dtype=np.float32)
        return Space(np.ones(BINS, np.float32), np.zeros((BINS, DIMENSIONS), np.float32), empty, np.zeros(0, np.float32))
    counts = np.frombuffer(b"".join(r["_counts"] for r in rows), dtype=np.float16).reshape(len(rows), BINS)
    return space_of(counts.astype(np.float32), np.array([r["_quality"] for r in rows]))


def score(docs: DataFrame, space: Space) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text)."""
    # The sample's bound and the fixed number of bins bound what is broadcast.
    shared = docs.sparkSession.sparkContext.broadcast((space.weights, space.projection, space.vectors, space.labels))
    outputs = T.StructType([T.StructField("score", T.DoubleType())])

    def run(lists: list[list]) -> list[list]:
        return [vote(Space(*shared.value), [counts_of(text) for text in lists[0]])]

    scored = append_columns(docs.select("doc_id", "text"), ["text"], outputs, run).drop("text")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
