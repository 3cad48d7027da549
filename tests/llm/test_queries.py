"""Registered queries at the smallest scale: against SQL, or against plain Python where SQL can't express them."""

import hashlib
import os
import zlib

import pytest

import __spark_entry__
from landfall.llm.oracles import ORACLES
from landfall.llm.queries import QUERIES
from tests.llm import brute
from workload import compare

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def result(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    cursor = compare.connect(FOLDER).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    frame = QUERIES[name](spark, FOLDER)
    assert sorted(frame.columns) == sorted(columns)
    want = compare.rows(columns, cursor.fetchall())
    assert compare.rows(frame.columns, [tuple(r) for r in frame.collect()]) == want and want


def test_shards(spark, documents):
    got = result(spark, "op2_jump_shards")
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in documents)
    assert all(r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16) for r in got)


def test_archives(spark):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    last = {}
    for page, raw in sorted(pages.items()):
        last[raw] = page
    got = result(spark, "op3_warc")
    want = [(p, len(raw), hashlib.sha1(raw).hexdigest(), last[raw] if len(raw) >= 1000 and last[raw] != p else None) for p, raw in pages.items()]
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.refers_to) for r in got) == sorted(want, key=lambda w: w[0])
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in got)


def test_near_duplicates(spark, documents):
    group = brute.groups(documents, 2, 80)
    least = {}
    for (doc, _), g in zip(documents, group):
        least[g] = min(least.get(g, doc), doc)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in result(spark, "op10_superminhash")}
    assert got == {doc: (len(brute.shingles(text, 2)), least[g], least[g] == doc) for (doc, text), g in zip(documents, group)}


@pytest.mark.parametrize(("name", "label", "parts", "held"), [("op5_neighbour_quality", "quality", 5, 0), ("op9_noisy_channel_toxicity", "toxic", 3, 1)])
def test_classifiers_on_held_out_documents(spark, documents, name, label, parts, held):
    got = {r.doc_id: r for r in result(spark, name)}
    assert set(got) == {i for i, _ in documents}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == held) and 0 <= r.score <= 1 for r in got.values())
    limit = {"quality": 0.3, "toxic": 0.7}[label]
    assert all(r.predicted == int(r.score >= limit) for r in got.values())
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    right = [got[i].predicted == y for i, y in labels.items() if i in got and got[i].held_out]
    assert sum(right) >= 0.8 * len(right)  # at this scale a dozen of examples to learn from
