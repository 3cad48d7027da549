"""Quality of texts by their nearest labelled neighbours in a latent semantic space.

Terms are hashed byte trigrams and a few shapes of the text (steps of the share of repeated words, symbols, capitals),
weighed by frequency in the text and rarity in the corpus. The leading singular directions of the labelled texts span
the space. Every document is compared with all labelled vectors by exact cosines, in blocks, and its neighbours vote
with a weight that grows with their similarity.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from landfall.sources.staging import stage

#: Buckets of trigrams, singular directions, labelled documents at most (those with the least hashes of their ids).
BUCKETS, DIRECTIONS, SAMPLE = 2048, 48, 4000
#: Neighbours that vote, and the power of the similarity that is their weight.
NEIGHBOURS, POWER = 25, 8
#: Weight of a shape beside all trigrams together, and the steps that shares fall into.
SHAPE_WEIGHT = 0.6
STEPS = np.array([0.0, 0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75])
SHAPES = 4
#: Documents in a block of cosines.
BLOCK = 512
_WIDTH = BUCKETS + SHAPES * (len(STEPS) + 1)
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>!@^~=_{}[]\\")] = True


def terms(text: str | None) -> np.ndarray:
    """Frequencies of all terms of a whole text: logarithmic for trigrams, 0 or 1 for shapes; zeros without text."""
    found = np.zeros(_WIDTH, dtype=np.float32)
    if not text:
        return found
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    if len(raw) > 2:
        wide = raw.astype(np.uint32)
        codes = (wide[:-2] * np.uint32(0x9E3779B1) ^ wide[1:-1] * np.uint32(0x85EBCA77) ^ wide[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(21)
        found[:BUCKETS] = np.log1p(np.bincount(codes, minlength=BUCKETS))
    words = text.split()
    repeated = sum(map(operator.eq, words, words[1:])) / max(1, len(words) - 1)
    letters = np.count_nonzero(((raw | 32) >= 97) & ((raw | 32) <= 122)) or 1
    capitals = np.count_nonzero((raw >= 65) & (raw <= 90)) / letters
    symbols = np.count_nonzero(_SYMBOLS[raw]) / len(raw)
    bars = sum(1 for w in words if len(w) == 1 and not w.isalnum()) / max(1, len(words))
    for shape, share in enumerate((repeated, capitals, symbols, bars)):
        found[BUCKETS + shape * (len(STEPS) + 1) + int(np.searchsorted(STEPS, share, side="left"))] = 1.0
    return found


def weigh(found: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Rows of terms to unit vectors of weighed terms: trigrams and shapes are scaled to their shares."""
    grams = found[:, :BUCKETS] * rarity[:BUCKETS]
    grams /= np.maximum(np.linalg.norm(grams, axis=1, keepdims=True), 1e-12)
    shapes = found[:, BUCKETS:] * rarity[BUCKETS:] * SHAPE_WEIGHT
    rows = np.concatenate([grams, shapes], axis=1)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def rarities(docs: DataFrame) -> np.ndarray:
    """Inverse document frequencies of all terms over all documents."""
    width = _WIDTH

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = np.zeros(width + 1, dtype=np.int64)
            for text in batch.column(0):
                seen[:width] += terms(text.as_py()) > 0
                seen[width] += 1
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width + 1, dtype=np.int32)), pa.array(seen)], names=["term", "n"])

    counts = np.zeros(width + 1)
    for row in docs.select("text").mapInArrow(count, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row["term"]] = row["n"]  # one row per term
    return np.log((counts[width] + 1) / (counts[:width] + 1)).astype(np.float32) + 0.1


@dataclass
class Space:
    """Rarity of terms, singular directions, and labelled vectors with their labels."""

    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int = NEIGHBOURS

    def place(self, found: np.ndarray) -> np.ndarray:
        rows = weigh(found, self.rarity) @ self.directions
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)

    def score(self, found: np.ndarray) -> np.ndarray:
        """Share of the neighbours' weight with label 1; the share of all labels where nothing is similar."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(found), prior)
        cosines = self.place(found) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        least = np.partition(cosines, len(self.labels) - k, axis=1)[:, len(self.labels) - k]
        weights = np.where(cosines >= least[:, None], np.maximum(cosines, 0), 0) ** POWER  # ties at the edge all vote
        total = weights.sum(axis=1)
        return np.where(total > 1e-9, (weights @ self.labels) / np.maximum(total, 1e-9), prior)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, directions: int = DIRECTIONS) -> Space:
    """Space from ``labels`` (``doc_id, quality``; rows without either are left out) and the texts of ``docs``.

    Rarities count all documents; ``sample`` labelled documents, and as many distinct texts, at most span the space.
    Repeated texts count once, by their highest label, so reruns agree. Without documents or labels nothing is similar and
    all scores are one half.
    """
    rarity = rarities(docs)
    chosen = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = stage(chosen.withColumnRenamed("doc_id", "_labelled"), "quality-sample")

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "quality": batch["quality"], "terms": [terms(t).tobytes() for t in batch["text"]]})

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_labelled")).select(  # ``sample`` rows
        F.xxhash64("text").alias("key"), "quality", "text")
    counted = texts.mapInPandas(vectors, "key bigint, quality int, terms binary")
    once = counted.groupBy("key").agg(F.max("quality").alias("quality"), F.first("terms").alias("terms"))
    # An id may have many texts; ``sample`` at most come here.
    ordered = sorted(once.orderBy(F.xxhash64("key"), "key").limit(sample).toLocalIterator(), key=lambda r: r["key"])
    if not ordered:
        return Space(rarity, np.zeros((_WIDTH, 1), dtype=np.float32), np.zeros((0, 1), dtype=np.float32), np.zeros(0))
    matrix = weigh(np.stack([np.frombuffer(r["terms"], dtype=np.float32) for r in ordered]), rarity)
    space = Space(rarity, _directions(matrix, directions), matrix, np.array([float(r["quality"] > 0) for r in ordered]))
    rows = matrix @ space.directions
    space.vectors = (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    return space


def _directions(matrix: np.ndarray, count: int) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    count = min(count, *matrix.shape)
    basis = np.random.default_rng(7).standard_normal((matrix.shape[1], min(count + 8, *matrix.shape))).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ right[:count].T).astype(np.float32)


def quality_score(text: Column, space: Space) -> Column:
    """Score from 0 to 1 of each whole text; null and empty texts get the share of label 1."""

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [space.score(np.stack([terms(t) for t in texts.iloc[i:i + BLOCK]])) for i in range(0, len(texts), BLOCK)]
            yield pd.Series(np.clip(np.concatenate(parts), 0.0, 1.0) if parts else [], dtype="float64")

    return score(text)
