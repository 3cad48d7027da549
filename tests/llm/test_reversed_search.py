"""Ranked search against plain Python: blocks, ties, nulls, repeated rows, empty tables, long texts."""

import math

import pytest
from pyspark.sql import functions as F

from landfall.llm import reversed_search
from tests.llm import brute
from tests.llm.test_operators import docs, empty, order, pairs, prose  # noqa: F401

ITEMS = [(1, "Alpha3 beta1 beta1 épsilon"), (2, None), (3, "..."), (4, "one two ONE same"), (4, "one two ONE same"), (None, "nameless nu7"),
         (5, "wordthatisnowhere"), (6, "token 0123456789abcdef"), (7, prose(2000, 2))]


def ranked(documents, items, best=10):
    held = [(i, brute.tokens(t)) for i, t in documents if brute.tokens(t)]
    total = sum(len(w) for _, w in held)
    out = []
    for item, text in items:
        scores = []
        for doc, words in held:
            score = 0
            for term in set(brute.tokens(text)):
                df, tf = sum(term in w for _, w in held), words.count(term)
                weight = math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df + 1)))
                score += weight * (10**9 * tf // (1000 * tf + 8 * (10 + 90 * len(words) * len(held) // total)))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, k, None if none else doc, -score) for k, (score, none, doc) in enumerate(sorted(scores)[:best], 1)]
    return out


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("doc_id", F.lit("clash")).withColumn("score", F.lit("clash"))


@pytest.mark.parametrize(("best", "block_terms", "cells"), [(10, 2_000_000, 1 << 21), (3, 2_000_000, 5), (2, 4, 1 << 21)])
def test_ranks_equal_brute_force(docs, items, monkeypatch, best, block_terms, cells):  # noqa: F811
    monkeypatch.setattr(reversed_search, "_CELLS", cells)
    found = reversed_search.rank_documents(docs.repartition(3), items, best=best, block_terms=block_terms)
    assert order(tuple(r) for r in found.collect()) == order(ranked(pairs(), ITEMS, best))


def test_empty_tables(docs, items, empty):  # noqa: F811
    for some, asked in ((empty, items), (docs, items.where("false")), (empty, items.where("false"))):
        found = reversed_search.rank_documents(some, asked)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.isEmpty()


def test_long_texts_and_equal_scores(spark):
    long = " ".join(f"w{k % 5000}" for k in range(300_000))
    documents = [(k, "tie breaker") for k in range(40, 0, -1)] + [(100, long), (101, "w7 tie")]
    frame = spark.createDataFrame(documents, "doc_id bigint, text string").repartition(4)
    asked = [(1, "tie"), (2, long)]
    found = reversed_search.rank_documents(frame, spark.createDataFrame(asked, "item_id bigint, text string"))
    assert order(tuple(r) for r in found.collect()) == order(ranked(documents, [(1, "tie")]) + [
        tuple(r) for r in found.where("item_id = 2").collect()])
    assert [r.doc_id for r in found.where("item_id = 2").orderBy("rank").collect()] == [100, 101]


def test_terms():
    assert reversed_search.terms("Ab1-c_É x\n2".encode()) == [b"ab1", b"c", "É".encode(), b"x", b"2"]
    assert reversed_search.terms(None) == reversed_search.terms(b"") == []
