"""Licence scans against plain Python: filled-in texts, edits, ties, nulls, repeated rows, empty tables, long texts."""

import math

import pytest

from landfall.llm import license_index
from landfall.llm.license_texts import BASE, TEMPLATES, TEXTS, Template
from tests.llm import brute
from tests.llm.test_operators import docs, empty, order, pairs, prose  # noqa: F401

MIT = next(t for t in TEXTS if t.label == "mit").text
FILES = [
    (1, "Copyright (c) 2020 Someone\n" + MIT + "\n" + prose(100, 1)),
    (2, prose(50, 2) + "\n" + MIT.replace("subject to the following conditions", "under these few words and " + prose(20, 3))),
    (3, "Permission is hereby granted, free of charge. " + prose(200, 4) + " rights to use, copy, modify, merge, publish, distribute, sublicense"),
    (4, "Released under the MIT License. mit license MIT-License, permit license"),
    (5, "Licensed under the Apache License, Version 2.0."), (6, "licensed under cc by-nc 4.0"), (7, "CC BY CC BY 4.0 cc by-sa 4.0"),
    (8, "This work is licensed under the GNU General Public License, version 3."), (9, "gnu general public"), (10, None), (11, ""),
    (12, "version 3 " + prose(30, 5) + " GNU General Public License " + prose(80, 6) + " version 3"), (13, "\n".join(t.text for t in TEXTS)),
    (None, "mit license"), (13, "apache license"), (13, "apache license"), (14, prose(30_000, 7) + " GNU Lesser General Public License"),
    (15, "mit " * 20_000 + "license"), (16, "mit license " * 3000), (17, prose(15, 8) + " is provided 'as-is', without any express or implied warranty")]


def scan(text, holding, documents, templates=TEMPLATES, slack=license_index.SLACK):
    words = [w.encode() for w in brute.tokens(text)]
    weight = lambda w: 1 + math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(w, 0) + 1)))
    places, licenses = [], []
    for number, t in enumerate(templates):
        spelled, spans = license_index.template_words(t), license_index.phrase_spans(t)
        at = [[i for i in range(len(words)) if words[i:i + n] == spelled[o:o + n]] for o, n in spans]
        if t.base:
            places += [(t.label, i) for i in at[0]]
        best = None
        for first in at[0]:
            d = first - spans[0][0]
            shifts = [min(((abs(i - o - d), i - o) for i in found), default=(slack + 1, 0)) for (o, _), found in zip(spans[1:], at[1:])]
            if any(far > slack for far, _ in shifts):
                continue
            agree = [q for q, w in enumerate(spelled) if any(0 <= q + s < len(words) and words[q + s] == w for s in {d, *(s for _, s in shifts)})]
            share = sum(weight(spelled[q]) for q in agree) / sum(map(weight, spelled))
            if best is None or share > best[1]:
                best = (first, share)
        if best:
            licenses.append((t.label, number, *best))
    return len(words), sorted(places, key=lambda p: p[::-1]), licenses


def expected(rows, templates=TEMPLATES, slack=license_index.SLACK):
    sets = [set(w.encode() for w in brute.tokens(t)) for _, t in rows]
    vocabulary = {w for t in templates for w in license_index.template_words(t)}
    holding = {w: sum(w in s for s in sets) for w in vocabulary}
    return order((i, *scan(t, holding, sum(map(bool, sets)), templates, slack)) for i, t in rows)


def got(frame):
    return order((r.doc_id, r.n_words, [tuple(p) for p in r.places], [tuple(x) for x in r.licenses]) for r in frame.collect())


def test_files_with_licences(spark):
    short = [(i, t) for i, t in FILES if i != 16]
    frame = spark.createDataFrame(short, "doc_id bigint, text string").repartition(3)
    found = got(license_index.find_licenses(frame))
    assert found == expected(short)
    labels = {r[0]: {x[0] for x in r[3]} for r in found}
    assert "mit" in labels[1] and "mit" in labels[2] and labels[3] == set() and labels[13] != set()
    whole = next(r for r in found if r[0] == 13 and r[1] > 100)
    assert {x[0] for x in whole[3]} >= {t.label for t in TEXTS}
    assert next(x[3] for x in next(r for r in found if r[0] == 1)[3] if x[0] == "mit") == 1.0


def test_many_places_in_one_file(spark):
    frame = spark.createDataFrame([r for r in FILES if r[0] == 16], "doc_id bigint, text string")
    row = license_index.find_licenses(frame).first()
    assert [tuple(p) for p in row.places] == [("mit", 2 * k) for k in range(3000)] and len(row.licenses) == 1


@pytest.mark.parametrize("slack", [0, 5])
def test_other_templates_and_slack(spark, slack):
    templates = (Template("aa", "a b a c a b", ("a b", "c a")), Template("x", "x", ("x",)), Template("ab", "c a b", ("a b",), True))
    rows = [(1, "a b a c a b"), (2, "a b q a c a b a b"), (3, "a b q q q q q q a c a"), (4, "a a a b b a"), (5, "x"), (6, "b a c a")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(license_index.find_licenses(frame, templates, slack)) == expected(rows, templates, slack)


def test_awkward_rows(docs, empty):  # noqa: F811
    assert got(license_index.find_licenses(docs)) == expected(pairs())
    assert license_index.find_licenses(empty).isEmpty()


def test_phrases_must_be_in_the_text():
    with pytest.raises(ValueError, match="not in the text"):
        license_index.phrase_spans(Template("x", "some text", ("other text",)))
    assert all(license_index.phrase_spans(t) for t in BASE + TEXTS)
