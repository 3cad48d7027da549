"""Ranked lexical search for many standing items at once: the items are indexed, the documents stream past.

The inverted index holds the items' terms, not the documents'. Each task runs its documents' term counts through the
index and keeps one bounded heap per item; heaps are merged by groups of tasks, then by item. An index is sent to the
tasks, so items are taken in blocks of a measured size: every block is one pass over the documents for the statistics
and one for the scores, and no answer depends on the blocks.
"""

from __future__ import annotations

import heapq
import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.sources.staging import stage

#: Documents returned per item.
BEST = 10
#: Terms (with repeats over items) and items of one block of the index: some 200 MB in a task at most.
BLOCK_TERMS, BLOCK_ITEMS = 2_000_000, 20_000
#: Cells of the table of scores (documents by items) that a task fills at once.
_CELLS = 1 << 21
#: Counts of terms that a task gathers before it fills the table, and those of the document that reaches the number.
_COUNTS = 50_000
#: Tasks whose heaps are merged first.
_GROUP = 256

_LETTERS = string.ascii_letters.encode() + string.digits.encode()
# Bytes of a term to themselves, A-Z to lower case, all other ASCII characters to blanks.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or c in _LETTERS else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters in UTF-8, only A-Z in lower case; null has none."""
    return text.translate(_FOLD).split() if text else []


@dataclass
class Index:
    """Postings of the terms of a block of items: term ``t`` is in the items ``items[starts[t]:starts[t + 1]]``."""

    numbers: np.ndarray  # of the items, by their place in the block
    terms: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    weights: np.ndarray | None = None
    documents: int = 0
    words: int = 0

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]]) -> Index:
        numbers = np.unique(np.array([n for n, _ in rows], dtype=np.int64))
        known = {term: at for at, term in enumerate(sorted({t for _, t in rows}))}
        of_term = np.array([known[t] for _, t in rows], dtype=np.int64)
        places = np.searchsorted(numbers, np.array([n for n, _ in rows], dtype=np.int64))
        order = np.lexsort((places, of_term))
        starts = np.concatenate([[0], np.cumsum(np.bincount(of_term, minlength=len(known)))]).astype(np.int64)
        return cls(numbers, known, starts, places[order])

    def weigh(self, holding: dict[int, int], documents: int, words: int) -> None:
        """Set the weights of the terms from the number of documents that hold each."""
        self.documents, self.words = documents, words
        self.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(t, 0) + 1)))
                                 for t in range(len(self.terms))], dtype=np.int64)

    def damping(self, length: int) -> int:
        """What a document's number of terms takes from the gain of each."""
        return 8 * (10 + 90 * length * self.documents // self.words)

    def scores(self, documents: int, counts: np.ndarray) -> np.ndarray:
        """Documents by items, from rows of ``document, term, times, damping``."""
        document, term, times, damping = counts
        out = np.zeros(documents * len(self.numbers), dtype=np.int64)
        gain = self.weights[term] * (1_000_000_000 * times // (1000 * times + damping))
        many = self.starts[term + 1] - self.starts[term]
        # Place of every posting of every term: its list's start, and on from there.
        posting = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.starts[term], many)
        np.add.at(out, np.repeat(document, many) * len(self.numbers) + self.items[posting], np.repeat(gain, many))
        return out.reshape(documents, len(self.numbers))


def _holding(index: Index):
    """Per task: how many documents hold each term of the index (-1: any term), and the terms of all (-2)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, documents, words = np.zeros(len(index.terms), dtype=np.int64), 0, 0
        for batch in batches:
            for value in batch.column(0):
                found = terms(value.as_py())
                documents, words = documents + bool(found), words + len(found)
                holding[[index.terms[t] for t in index.terms.keys() & set(found)]] += 1
        seen = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1, -2], seen]).astype(np.int64)),
                                          pa.array(np.concatenate([[documents, words], holding[seen]]).astype(np.int64))],
                                         names=["term", "documents"])

    return count


def _search(index: Index, best: int):
    """Per task: the ``best`` documents of every item among the task's."""
    last = -2**63  # sorts a document without id behind the others

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: list[list[tuple[int, int]]] = [[] for _ in index.numbers]
        least = np.ones(len(index.numbers), dtype=np.int64)  # a score below cannot enter the heap
        many = max(1, _CELLS // max(1, len(index.numbers)))

        def offer() -> None:
            table = index.scores(len(ids), np.array(counts, dtype=np.int64).reshape(-1, 4).T)
            for row, item in zip(*(part.tolist() for part in np.nonzero(table >= least))):
                heap, entry = heaps[item], (int(table[row, item]), ids[row])
                if len(heap) < best:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                else:
                    continue
                if len(heap) == best:
                    least[item] = heap[0][0]

        ids, counts = [], []
        for batch in batches:
            for doc, value in zip(batch.column(0), batch.column(1)):
                words = terms(value.as_py())
                if not words:
                    continue
                times, damping = Counter(words), index.damping(len(words))
                counts += [(len(ids), index.terms[t], times[t], damping) for t in index.terms.keys() & times.keys()]
                ids.append(-doc.as_py() if doc.is_valid else last)
                if len(ids) == many or len(counts) >= _COUNTS:
                    offer()
                    ids, counts = [], []
        offer()
        for start in range(0, len(heaps), 1000):
            rows = [(int(index.numbers[i]), score, None if key == last else -key)
                    for i in range(start, min(start + 1000, len(heaps))) for score, key in heaps[i]]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
                                             names=["item", "score", "doc_id"])

    return search


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(n.as_py(), t) for n, value in zip(batch.column(0), batch.column(1)) for t in sorted(set(terms(value.as_py())))]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                                         names=["item", "term"])


def rank_documents(docs: DataFrame, items: DataFrame, best: int = BEST, block_terms: int = BLOCK_TERMS,
                   block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The ``best`` documents of each item: ``item_id, rank, doc_id, score``; fewer where fewer score above 0.

    ``docs`` has ``doc_id`` (an integer) and ``text``, ``items`` has ``item_id, text``; other columns are not read. A
    term counts once per item; see :func:`terms`. Statistics cover all documents with a term. Equal scores are ranked by
    ascending id, documents without id last; repeated documents each have a rank. Every row of ``items`` is an item,
    with or without an id of its own; one without terms, or whose terms no document holds, has no rows. Without
    documents or items there are no rows. Documents are read twice per block of items, whatever their number.
    """
    numbered = stage(items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("binary").alias("text")),
                     "search-items")
    listed = stage(numbered.select("item", "text").mapInArrow(_item_terms, "item bigint, term binary"), "search-terms")
    size = listed.agg(F.count("*").alias("terms"), F.count_distinct("item").alias("items")).first()
    blocks = max(1, math.ceil(size["terms"] / block_terms), math.ceil(size["items"] / block_items))
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    heaps = []
    for block in range(blocks if size["terms"] else 0):
        mine = listed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        index = Index.of([(r["item"], bytes(r["term"])) for r in mine.toLocalIterator()])
        if not len(index.numbers):
            continue
        # One row per term of the block.
        counted = {r["term"]: r["documents"] for r in texts.mapInArrow(_holding(index), "term bigint, documents bigint").groupBy(
            "term").agg(F.sum("documents").alias("documents")).toLocalIterator()}
        if not counted.get(-1):
            continue
        index.weigh(counted, counted[-1], counted[-2])
        found = keyed.mapInArrow(_search(index, best), "item bigint, score bigint, doc_id bigint")
        heaps.append(stage(found.withColumn("part", F.floor(F.spark_partition_id() / _GROUP)), "search-heaps"))
    if not heaps:
        return numbered.where("false").select("item_id", F.lit(0).alias("rank"), F.lit(None).cast("bigint").alias("doc_id"),
                                              F.lit(0).cast("bigint").alias("score"))
    merged = heaps[0]
    for more in heaps[1:]:
        merged = merged.unionByName(more)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for group in (["item", "part"], ["item"]):
        merged = merged.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= best)
    return merged.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
