"""The pipeline's stages on a small corpus, each against plain Python on its own input."""

import random

import pytest

import corpus_pipeline
from landfall.llm import sharding
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(n: int, seed: int) -> str:
    pick = random.Random(seed)
    return " ".join(f"{pick.choice('alpha beta gamma delta eta theta iota kappa'.split())}{pick.randrange(60)}" for _ in range(n))


def corpus() -> list[tuple]:
    texts = [(i, prose(80, i)) for i in range(40)]
    texts += [(100 + i, prose(80, i)) for i in range(5)] + [(3, prose(80, 3)), (None, prose(80, 4)), (None, None), (50, ""), (51, None), (51, None)]
    near = prose(80, 7).split()
    near[40] = "changed"
    texts += [(60, " ".join(near)), (61, prose(30, 900) + " " + prose(25, 999) + " " + prose(30, 901)), (62, prose(9000, 77))]
    texts += [(200 + i, prose(60, 300 + i) + " utter scum") for i in range(12)]
    return [(i, t, "en", ["a", "b", None][k % 3], 1) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(f"{root}/documents.parquet")
    labels = [(200 + i, 1, 1) for i in range(9)] + [(i, 1, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, prose(25, 999)), (2, None)], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def listed(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_stages_have_a_common_shape():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_each_stage_on_its_own_input(spark, folder):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = stages["toxicity"](spark, docs, folder)
    assert clean.columns == corpus_pipeline.COLUMNS
    assert listed(clean) == sorted((r for r in corpus() if "scum" not in (r[1] or "")), key=repr)

    clean.write.mode("overwrite").parquet(f"{folder}/1")
    clean = spark.read.parquet(f"{folder}/1")
    rows = [tuple(r) for r in clean.collect()]
    once = stages["near_duplicates"](spark, clean, folder)
    group = brute.groups([(r[0], r[1]) for r in rows], 5, 80)
    kept = listed(once)
    wordless = [r for r in rows if not brute.words(r[1])]
    assert sorted((r for r in kept if not brute.words(r[1])), key=repr) == sorted(wordless, key=repr)
    least = {}
    for row, g in zip(rows, group):
        if brute.words(row[1]) and row[0] is not None:
            least[g] = min(least.get(g, row[0]), row[0])
    assert sorted(r[0] for r in kept if brute.words(r[1])) == sorted(least.values())

    once.write.mode("overwrite").parquet(f"{folder}/2")
    once = spark.read.parquet(f"{folder}/2")
    items = [(1, prose(25, 999)), (2, None)]
    fresh = stages["decontamination"](spark, once, folder)
    assert listed(fresh) == sorted((tuple(r) for r in once.collect() if brute.passages(r.text, items)[1] == 0), key=repr)
    assert 61 not in {r.doc_id for r in fresh.collect()}

    fresh.write.mode("overwrite").parquet(f"{folder}/3")
    fresh = spark.read.parquet(f"{folder}/3")
    mixed = stages["mixing"](spark, fresh, folder)
    assert mixed.columns == corpus_pipeline.COLUMNS
    before, after = listed(fresh), listed(mixed)
    assert set(after) <= set(before) and len(after) > 1.2 * len(before)
    assert all(after.count(r) <= 2 * before.count(r) for r in set(after))

    mixed.write.mode("overwrite").parquet(f"{folder}/4")
    mixed = spark.read.parquet(f"{folder}/4")
    placed = stages["sharding"](spark, mixed, folder).collect()
    assert sorted((repr(r.doc_id), r.size) for r in placed) == sorted((repr(r.doc_id), len((r.text or "").encode()) + 1) for r in mixed.collect())
    for shard in range(16):
        slots = sorted(r.slot for r in placed if r.shard == shard)
        assert slots == list(range(len(slots)))
    by_key = {}
    for r in placed:
        assert by_key.setdefault(r.doc_id, r.shard) == r.shard < corpus_pipeline.SHARDS


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 40
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
