"""The noisy channel against all paths, long spaced texts, and reruns with clashing labels."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from landfall.llm import neighbour_quality, toxicity


@pytest.fixture(scope="module")
def costs(spark):
    words = "the idiot said that the moron is a loser and a stupid person of this other world shit ass green grass " * 30
    return toxicity.letter_costs(toxicity.letter_counts(spark.createDataFrame([(words,)], "text string"))).tolist()


def cost_of(word: str, costs: list) -> float:
    """Model cost of words parted by blanks."""
    total, state = 0.0, (0, 0, 0)
    for d in [0 if char == " " else toxicity._class(char) for char in word]:
        total, state = total + costs[state[0]][state[1]][state[2]][d], (*state[1:], d)
    return total + (costs[state[0]][state[1]][state[2]][0] if state[2] else 0.0)


def all_paths(token: str, costs: list) -> float:
    """The least cost over every reading of a token, spelled out."""
    choices, before, run = [], "", 0
    for char in token:
        letters = [(char, 0.0)] if char.isalpha() else [(c, toxicity.SUBSTITUTE) for c in toxicity.LEET.get(char, "")]
        run, before = (run, before) if not letters else (run + 1 if char == before else 1, char)
        options = list(letters)
        if not letters:
            options.append(("", toxicity.SEPARATOR))
            if char == " ":
                options.append((" ", 0.0))
        elif run > 1:
            options.append(("", toxicity.DOUBLED if run == 2 else toxicity.STRETCHED))
        elif not char.isalpha():
            options.append(("", toxicity.SYMBOL))
        choices.append(options)
    best = math.inf
    for path in itertools.product(*choices):
        word = "".join(letter for letter, _ in path)
        if "  " in word or word.startswith(" "):
            continue
        best = min(best, sum(price for _, price in path) + cost_of(word, costs))
    return best


def price(token: str, word: str, costs: list) -> float:
    """The least cost of a token that is read as ``word``."""
    best = {0: 0.0}
    before, run = "", 0
    for char in token:
        letters = {char: 0.0} if char.isalpha() else dict.fromkeys(toxicity.LEET.get(char, ""), toxicity.SUBSTITUTE)
        run, before = (run, before) if not letters else (run + 1 if char == before else 1, char)
        dropped = toxicity.SEPARATOR if not letters else (toxicity.DOUBLED if run == 2 else toxicity.STRETCHED) if run > 1 else (
            math.inf if char.isalpha() else toxicity.SYMBOL)
        reached = {}
        for at, cost in best.items():
            reached[at] = min(reached.get(at, math.inf), cost + dropped)
            if at < len(word) and word[at] in letters:
                reached[at + 1] = min(reached.get(at + 1, math.inf), cost + letters[word[at]])
            if char == " " and at < len(word) and word[at] == " ":
                reached[at + 1] = min(reached.get(at + 1, math.inf), cost)
        best = reached
    return best.get(len(word), math.inf) + cost_of(word, costs)


def test_decoding_finds_the_best_of_all_paths(costs):
    pick = random.Random(3)
    tokens = ["".join(pick.choice("astupido153!$|. -") for _ in range(pick.randint(1, 8))) for _ in range(150)]
    for token in [*tokens, "s t u p i d", "a s s", "m0r0n", "i.d.1.o.t"]:
        word = toxicity.decode(token, costs)
        assert price(token, word, costs) == pytest.approx(all_paths(token, costs)), (token, word)


def test_breaks_come_from_the_model(costs):
    def restore(token):
        return toxicity.decode(token, costs)

    for text in ("you are a s t u p i d person", "y o u  a r e  s t u p i d", "a 5 t u u u p 1 d", "s.t.u.p.i.d", "ｓｔｕｐｉｄ", "st​upid"):
        assert "stupid" in toxicity.restored_words(text, restore), text
    assert restore("t h e l o s e r") == "the loser"
    assert "ass" not in toxicity.restored_words("g r a s s", restore)


def test_a_million_spaced_letters(costs):
    words = toxicity.restored_words("s t u p i d " * 170_000, lambda token: toxicity.decode(token, costs))
    assert "stupid" in words and sum(map(len, words)) < 4_000_000


def test_clashing_labels_of_equal_texts_give_the_same_model(spark):
    texts = [(i, " ".join(random.Random(i % 30).choices("alpha beta gamma delta eta".split(), k=12)) + (" idiot" if i % 3 else ""), int(i % 3 > 0 and i % 4 > 0))
             for i in range(120)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string, y int").cache()
    docs, labels = frame.select("doc_id", "text"), frame.select("doc_id", F.col("y").alias("toxic"), F.col("y").alias("quality"))
    models = [toxicity.fit(docs.repartition(n), labels.repartition(n), least_seen=2) for n in (1, 4, 7)]
    assert models[0].weights and all((m.bias, m.weights) == (models[0].bias, models[0].weights) for m in models)
    spaces = [neighbour_quality.fit(docs.repartition(n), labels.repartition(n)) for n in (1, 4, 7)]
    assert all((s.labels == spaces[0].labels).all() and (s.vectors == spaces[0].vectors).all() for s in spaces)
    wanted = {}
    for _, text, y in texts:
        wanted[text] = max(wanted.get(text, 0), y)
    assert sorted(spaces[0].labels) == sorted(wanted.values())


def test_samples_bound_texts_too_and_empty_tables_have_scores(spark):
    docs = spark.createDataFrame([(1, f"text {i} idiot") for i in range(50)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id bigint, toxic int, quality int")
    assert len(neighbour_quality.fit(docs, labels, sample=8).labels) == 8
    none = neighbour_quality.fit(docs.limit(0), labels)
    assert docs.limit(1).select(neighbour_quality.quality_score(F.col("text"), none)).first()[0] == 0.5
    assert docs.limit(0).select(neighbour_quality.quality_score(F.col("text"), none)).count() == 0
    model = toxicity.fit(docs.limit(0), labels)
    assert docs.limit(1).select(toxicity.toxicity_score(F.col("text"), model)).first()[0] < 1e-6
