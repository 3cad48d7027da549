"""Toxicity of whole texts after undoing disguises: leetspeak, spaced-out letters, stretched letters.

A noisy channel: the writer's letters are wanted, the text's characters are seen. A disguised token is a lattice (a
character may stand for itself or a letter, a separator or a stretched letter for nothing), and Viterbi decoding picks
the path with the best sum of channel costs and a model of four letters in a row. The model counts the letters of all
documents. In a run of spaced-out characters a separator may also end a word: the path passes the edge of a word there, at
the model's cost. Restored words, and their beginnings, are then scored by a logistic regression on labelled documents.

Null and empty texts have no words. Where equal texts have different labels, the highest counts, so reruns agree. Time and
memory grow in proportion to a text. Full-width forms are folded and invisible characters dropped before decoding.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from landfall.sources.staging import stage

# Letters that a character may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il",
        "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
#: Costs in nats of a letter written as another character, and of leaving out: a separator, the second of equal
#: letters in a row, a later one, a character that could be a letter.
SUBSTITUTE, SEPARATOR, DOUBLED, STRETCHED, SYMBOL = 1.0, 0.2, 5.0, 1.0, 8.0
#: Labelled documents that a model is fitted on at most: those with the least hashes of their ids.
SAMPLE = 30_000
#: Defaults of a fit: a sign of toxicity is a word or beginning seen in so many toxic texts of the sample; so many signs,
#: the most telling, are weighed. They bound the model, not the texts that are scored.
LEAST_SEEN, SIGNS = 4, 6_000
#: Lengths of beginnings of words.
STEMS = (4, 5, 6)
#: Strength of the pull of the weights to zero, and steps of the fit.
RIDGE, STEPS = 0.1, 400

_SEPARATED = re.compile(r"(?<![^\W_])(?:[^\W\d_]|[0134578@$!|])(?:[ .\-_*]{1,2}(?:[^\W\d_]|[0134578@$!|])){2,}(?![^\W_])")
_GAP, _WIDE = re.compile(r"[ .\-_*]+"), re.compile(r"[ .\-_*]{2}")
_BREAK = re.compile(r"(?:[^\w@$!|+(€£]|_)+")
_STRETCH = re.compile(r"([^\W\d_])\1\1+")
_HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
_EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "«»„“”‘’…—–¿¡"
_LETTERS = 28  # 0: edge of a word, 1 to 26: a to z, 27: any other letter


def _class(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 27


def letter_counts(docs: DataFrame) -> np.ndarray:
    """Counts of four letters in a row, over all texts: an array of 28 x 28 x 28 x 28, edges of words included."""
    size = _LETTERS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.arange(0x250, dtype=np.uint32).astype(np.uint8)
        table[:] = 0
        for c in range(0x250):
            if chr(c).isalpha():
                table[c] = _class(chr(c).lower()) if len(chr(c).lower()) == 1 else 27
        total = np.zeros(size**4, dtype=np.int64)  # of the whole task
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                text = "\n\n\n".join(t for t in batch.column(0).slice(first, 256).to_pylist() if t)
                points = np.frombuffer(f"\n\n\n{text}\n\n\n".encode("utf-32-le", "replace"), dtype=np.uint32)
                kinds = np.where(points < 0x250, table[np.minimum(points, 0x24F)], 27).astype(np.int32)
                codes = ((kinds[:-3] * size + kinds[1:-2]) * size + kinds[2:-1]) * size + kinds[3:]
                total += np.bincount(codes[(kinds[2:-1] > 0) | (kinds[3:] > 0)], minlength=size**4)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["code", "n"])

    rows = docs.select("text").mapInArrow(count, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size**4)
    counts[rows["code"].to_numpy()] = rows["n"].to_numpy()  # 28 ** 4 at most, twelve bytes each
    return counts.reshape(size, size, size, size)


def letter_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probabilities of a letter after three others, mixed with those after two, one and none."""
    likely = counts.sum(axis=(0, 1, 2)) + 1.0
    likely /= likely.sum()
    for known in (2, 1, 0):  # letters left out at the front
        sums = counts.sum(axis=tuple(range(known))) + 8 * likely
        likely = sums / sums.sum(axis=-1, keepdims=True)
    return -np.log(likely).round(9)


def decode(token: str, costs: list) -> str:
    """The likeliest letters behind a disguised token in lower case, by Viterbi over states of three letters.

    A blank may be left out like other separators, or end a word, for the model's cost of the edge.
    """
    # A path is its last letter and the path before, so that long tokens take time in proportion to their length.
    best: dict[tuple[int, int, int], tuple[float, tuple]] = {(0, 0, 0): (0.0, ())}
    before, run = "", 0
    for char in token:
        letters = [(char, 0.0)] if char.isalpha() else [(c, SUBSTITUTE) for c in LEET.get(char, "")]
        if letters:  # separators do not interrupt a stretch
            run = run + 1 if char == before else 1
            before = char
        dropped = SEPARATOR if not letters else (DOUBLED if run == 2 else STRETCHED) if run > 1 else (
            None if char.isalpha() else SYMBOL)
        reached: dict[tuple[int, int, int], tuple[float, tuple]] = {}
        for (a, b, c), (cost, path) in best.items():
            after = costs[a][b][c]
            if dropped is not None and (old := reached.get((a, b, c)), cost + dropped)[1] < (old[0] if old else math.inf):
                reached[a, b, c] = cost + dropped, path
            if char == " " and c and ((old := reached.get((b, c, 0))) is None or cost + after[0] < old[0]):
                reached[b, c, 0] = cost + after[0], (" ", path)
            for letter, price in letters:
                d = _class(letter)
                now = cost + price + after[d]
                if (old := reached.get((b, c, d))) is None or now < old[0]:
                    reached[b, c, d] = now, (letter, path)
        best = reached
    path = min(((cost + (costs[a][b][c][0] if c else 0.0), path) for (a, b, c), (cost, path) in best.items()), key=lambda end: end[0])[1]
    text = []
    while path:
        letter, path = path
        text.append(letter)
    return "".join(reversed(text))


def _disguised(core: str) -> bool:
    """A token with characters that could be letters, other than a plain number."""
    could = {c for c in core if c in LEET}
    return bool(could) and (any(not c.isdigit() for c in could) or any(c.isalpha() for c in core))


def _spaced(run: str, restore: Callable[[str], str]) -> set[str]:
    """Words that spaced-out characters spell: the likeliest with breaks, and what lies between wider gaps as one word."""
    words = set(restore(_GAP.sub(" ", run)).split())
    words.update(restore(_GAP.sub("", part)) for part in {run, *_WIDE.split(run)})
    return words


def restored_words(text: str | None, restore: Callable[[str], str]) -> set[str]:
    """The distinct words of a text in lower case, those of disguised tokens restored by ``restore``."""
    if not text:
        return set()
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKC", text))
    lower = text.lower()
    words: set[str] = set()
    for token in set(lower.split()):
        if token.isalpha():
            words.add(token)
            continue
        core = token.strip(_EDGES)
        if core.isalpha():
            words.add(core)
        elif core:
            words.update(re.findall(r"[^\W\d_]+", core))
        whole = token.rstrip(".,;:?\"'").lstrip("\"'([{")  # other marks at the edges may be letters
        if form := whole if _disguised(whole) else core if _disguised(core) else "":
            words.add(restore(form))
            if len(pieces := _BREAK.split(form)) > 1:  # its separators may join words
                words.update(restore(piece) for piece in pieces if _disguised(piece))
    for found in _SEPARATED.finditer(lower):
        words.update(_spaced(found.group(), restore))
    if _has_stretch(lower):
        words.update(restore(word) for word in list(words) if _STRETCH.search(word))
    words.discard("")
    return words


def _has_stretch(text: str) -> bool:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    same = points[1:] == points[:-1]
    return bool((same[1:] & same[:-1] & (points[2:] > 64)).any())


def signs(words: set[str]) -> set[str]:
    """Words, and the beginnings of longer words, marked by a star."""
    found = set(words)
    for n in STEMS:
        found.update(w[:n] + "*" for w in words if len(w) > n)
    return found


@dataclass
class Model:
    """Letter costs, a bias and the weights of signs."""

    costs: list
    bias: float = -20.0
    weights: dict[str, float] = field(default_factory=dict)

    def score(self, text: str | None, restore: Callable[[str], str]) -> float:
        total, words = self.bias, restored_words(text, restore)
        for word in words & self.weights.keys():
            total += self.weights[word]
        for n in STEMS:
            for stem in {w[:n] + "*" for w in words if len(w) > n} & self.weights.keys():
                total += self.weights[stem]
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, total))))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, least_seen: int = LEAST_SEEN, most_signs: int = SIGNS) -> Model:
    """Model from ``labels`` (``doc_id, toxic``; rows without either are left out) and the texts of ``docs``.

    Letters are counted over all documents. Words are weighed on ``sample`` labelled documents and as many distinct texts at
    most; repeated texts count once, by their highest label. A sign is seen in ``least_seen`` toxic texts, and ``most_signs``
    are weighed at most. Without labels of both kinds every score is 0.
    """
    costs = letter_costs(letter_counts(docs)).tolist()
    chosen = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = stage(chosen, "toxic-sample")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # ``sample`` rows of two numbers
    texts = texts.select(F.xxhash64("text").alias("key"), (F.col("toxic") > 0).alias("toxic"), "text")

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restore = functools.lru_cache(50_000)(lambda token: decode(token, costs))
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "toxic": batch["toxic"],
                                "signs": [sorted(signs(restored_words(t, restore))) for t in batch["text"]]})

    spelt = texts.mapInPandas(spell, "key bigint, toxic boolean, signs array<string>")
    # One row per text: equal texts have equal signs, so it does not matter which is first. An id may have many texts.
    once = stage(spelt.groupBy("key").agg(F.max("toxic").alias("toxic"), F.first("signs").alias("signs")), "toxic-signs")
    keys = stage(once.select(F.col("key").alias("_kept")).orderBy(F.xxhash64("_kept"), "_kept").limit(sample), "toxic-texts")
    known = once.join(F.broadcast(keys), F.col("key") == F.col("_kept"), "left_semi")  # ``sample`` numbers
    seen = known.select("toxic", F.explode("signs").alias("sign")).groupBy("sign").agg(
        F.sum(F.col("toxic").cast("bigint")).alias("t"), F.sum((~F.col("toxic")).cast("bigint")).alias("f")).where(
        F.col("t") >= least_seen)
    totals = known.agg(
        F.sum(F.col("toxic").cast("bigint")).alias("t"), F.sum((~F.col("toxic")).cast("bigint")).alias("f")).first()
    if not totals["t"] or not totals["f"]:
        return Model(costs)
    ratio = F.log((F.col("t") + 0.5) / (totals["t"] + 1)) - F.log((F.col("f") + 0.5) / (totals["f"] + 1))
    best = seen.withColumn("ratio", ratio).where("ratio > 1.5").orderBy(
        (F.col("ratio") * F.sqrt("t")).desc(), "sign").limit(most_signs)
    picked = [r["sign"] for r in best.select("sign").collect()]  # most_signs at most
    numbers = {sign: i for i, sign in enumerate(picked)}

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["signs"] = [[numbers[s] for s in row if s in numbers] for row in batch["signs"]]
            yield batch

    rows = known.mapInPandas(hits, "key bigint, toxic boolean, signs array<int>").collect()  # ``sample`` at most
    rows.sort(key=lambda r: r["key"])
    columns = np.array([i for r in rows for i in r["signs"]], dtype=np.int64)
    lines = np.repeat(np.arange(len(rows)), [len(r["signs"]) for r in rows])
    bias, weights = _regression(columns, lines, np.array([float(r["toxic"]) for r in rows]), len(picked))
    return Model(costs, bias, {s: float(w) for s, w in zip(picked, weights, strict=True)})


def _regression(columns: np.ndarray, lines: np.ndarray, wanted: np.ndarray, width: int) -> tuple[float, np.ndarray]:
    """Logistic regression on presence of signs, by gradient steps with per-weight scaling (Adam)."""
    weights, slow, fast = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        total = np.bincount(lines, weights=weights[columns], minlength=len(wanted)) + weights[width]
        error = 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30))) - wanted
        slope = np.append(np.bincount(columns, weights=error[lines], minlength=width)[:width] + RIDGE * weights[:width], error.sum())
        slow, fast = 0.9 * slow + 0.1 * slope, 0.99 * fast + 0.01 * slope**2
        weights = weights - 0.1 * (slow / (1 - 0.9**step)) / (np.sqrt(fast / (1 - 0.99**step)) + 1e-8)
    return float(weights[width]), weights[:width]


def toxicity_score(text: Column, model: Model) -> Column:
    """Score from 0 to 1 of each whole text; null and empty texts have the score of no words."""

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restore = functools.lru_cache(50_000)(lambda token: decode(token, model.costs))
        for texts in batches:
            yield pd.Series([model.score(t, restore) for t in texts], dtype="float64")

    return score(text)
