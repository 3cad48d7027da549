"""Licence scans with a positional index of rare words.

A file can only hold a phrase if it holds the phrase's rarest word, so that is the word a file is looked up by: of all
words that the file shares with the phrase it has the highest IDF, measured over all documents. Where it is found, the
postings of the other words are intersected by relative position: file position less template position must be one
number. Key phrases so verified give alignments of the file with the template, and the words that agree along these
give its share. The index depends on the templates alone; files are read one by one, whole.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.license_texts import TEMPLATES, Template
from landfall.llm.reversed_search import terms

#: Words by which the phrases of one template may be nearer to or farther from each other than in the template.
SLACK = 60

_PLACES = "array<struct<label: string, start: bigint>>"
_LICENSES = "array<struct<label: string, template: int, start: bigint, share: double>>"


def template_words(template: Template) -> list[bytes]:
    return terms(template.text.encode())


def phrase_spans(template: Template) -> list[tuple[int, int]]:
    """Start and length, in words, of each key phrase in its template."""
    text, spans = template_words(template), []
    for phrase in template.phrases:
        words = terms(phrase.encode())
        found = [i for i in range(len(text) - len(words) + 1) if words and text[i:i + len(words)] == words]
        if not found:
            raise ValueError(f"{phrase!r} is not in the text of {template.label}")
        spans.append((found[0], len(words)))
    return spans


@dataclass
class Index:
    """``anchors``: rarest word of a phrase to (template, phrase, where in the phrase the word stands)."""

    templates: Sequence[Template]
    words: list[list[bytes]]
    spans: list[list[tuple[int, int]]]
    numbers: dict[bytes, int]  # of all template words
    coded: list[np.ndarray]
    weights: list[np.ndarray]  # of each word of a template
    anchors: dict[bytes, list[tuple[int, int, int]]]
    slack: int

    @classmethod
    def of(cls, templates: Sequence[Template], holding: dict[bytes, int], documents: int, slack: int) -> Index:
        words = [template_words(t) for t in templates]
        numbers = {w: n for n, w in enumerate(sorted({w for text in words for w in text}))}
        weight = {w: 1 + math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(w, 0) + 1))) for w in numbers}
        spans, anchors = [phrase_spans(t) for t in templates], {}
        for t, text in enumerate(words):
            for p, (start, length) in enumerate(spans[t]):
                at = max(range(length), key=lambda k: (weight[text[start + k]], -k))
                anchors.setdefault(text[start + at], []).append((t, p, at))
        return cls(templates, words, spans, numbers, [np.array([numbers[w] for w in text]) for text in words],
                   [np.array([weight[w] for w in text], dtype=np.int64) for text in words], anchors, slack)

    def phrases(self, file: list[bytes]) -> dict[tuple[int, int], list[int]]:
        """Places of each (template, phrase) in a file, ascending."""
        found: dict[tuple[int, int], list[int]] = {}
        if self.anchors.keys().isdisjoint(file):
            return found
        for at, word in enumerate(file):
            for t, p, inside in self.anchors.get(word, ()):
                start, length = self.spans[t][p]
                place = at - inside
                if place >= 0 and file[place:place + length] == self.words[t][start:start + length]:
                    found.setdefault((t, p), []).append(place)
        return found

    def licenses(self, file: list[bytes]) -> tuple[list[tuple[str, int]], list[tuple[str, int, int, float]]]:
        """Places of base phrases, and of each template that is there: label, number, start, share of its words' weight."""
        found = self.phrases(file)
        if not found:
            return [], []
        coded = np.array([self.numbers.get(w, -1) for w in file])
        places = sorted((place, self.templates[t].label) for (t, _), at in found.items() if self.templates[t].base for place in at)
        licenses = []
        for t in sorted({t for t, _ in found}):
            best = None
            for start in found.get((t, 0), ()):
                shifts = self._shifts(found, t, start - self.spans[t][0][0])
                if shifts is not None:
                    share = self._share(coded, t, shifts)
                    if best is None or share > best[1]:
                        best = (start, share)
            if best is not None:
                licenses.append((self.templates[t].label, t, *best))
        return [(label, place) for place, label in places], licenses

    def _shifts(self, found: dict[tuple[int, int], list[int]], t: int, shift: int) -> set[int] | None:
        """Relative positions of all phrases where the first one has ``shift``; null if one has no place near enough."""
        shifts = {shift}
        for p in range(1, len(self.spans[t])):
            places, wanted = found.get((t, p), []), shift + self.spans[t][p][0]
            at = bisect_left(places, wanted)
            nearest = min(places[max(0, at - 1):at + 1], key=lambda place: (abs(place - wanted), place), default=None)
            if nearest is None or abs(nearest - wanted) > self.slack:
                return None
            shifts.add(nearest - self.spans[t][p][0])
        return shifts

    def _share(self, coded: np.ndarray, t: int, shifts: set[int]) -> float:
        agree = np.zeros(len(self.coded[t]), dtype=bool)
        for shift in shifts:
            first, last = max(0, -shift), min(len(agree), len(coded) - shift)
            agree[first:last] |= coded[first + shift:last + shift] == self.coded[t][first:last]
        return int(self.weights[t][agree].sum()) / int(self.weights[t].sum())


def _holding(words: dict[bytes, int]):
    """Per task: documents with a word (-1), and those that hold each template word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, documents = np.zeros(len(words), dtype=np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                found = terms(value.as_py())
                documents += bool(found)
                holding[[words[w] for w in words.keys() & set(found)]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(words)), pa.int64()), pa.array([documents, *holding.tolist()], pa.int64())],
                                         names=["word", "documents"])

    return count


def build_index(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, slack: int = SLACK) -> Index:
    """The index, with document frequencies of the template words over all of ``docs`` (column ``text``)."""
    listed = sorted({w for t in templates for w in template_words(t)})
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    # One row per template word.
    counted = {r["word"]: r["documents"] for r in texts.mapInArrow(_holding({w: n for n, w in enumerate(listed)}), "word bigint, documents bigint")
               .groupBy("word").agg(F.sum("documents").alias("documents")).collect()}
    return Index.of(templates, {w: counted.get(n, 0) for n, w in enumerate(listed)}, counted.get(-1, 0), slack)


def find_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, slack: int = SLACK) -> DataFrame:
    """Licences of every document: ``doc_id, n_words, places, licenses``.

    ``docs`` has ``doc_id, text``; other columns are not read. ``places`` are ``label, start`` of all places of base
    phrases, ``start`` counting words from 0, overlapping ones included. ``licenses`` are ``label, template, start,
    share`` of every template whose key phrases all stand in the file, in any order, at most ``slack`` words nearer to or
    farther from the first one than in the template; ``start`` is where the first phrase stands in the alignment of the
    greatest share (the first of equal ones), ``share`` the part of the template's words that agree along the phrases'
    relative positions, weighted by IDF. Null and empty texts have no words and nothing is found in them. Repeated rows
    each get their row; an empty table gives none. What is found in one text is one row.
    """
    index = build_index(docs, templates, slack)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = [terms(value.as_py()) for value in batch.column(1)]
            found = [index.licenses(file) for file in files]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(file) for file in files], pa.int64()),
                pa.array([[{"label": label, "start": start} for label, start in places] for places, _ in found],
                         pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))),
                pa.array([[{"label": label, "template": t, "start": start, "share": share} for label, t, start, share in licenses]
                          for _, licenses in found], pa.list_(pa.struct([
                              ("label", pa.string()), ("template", pa.int32()), ("start", pa.int64()), ("share", pa.float64())])))],
                names=["doc_id", "n_words", "places", "licenses"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        scan, f"doc_id {kind}, n_words bigint, places {_PLACES}, licenses {_LICENSES}")
