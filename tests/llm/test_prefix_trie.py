"""Tree contraction and the conversation trie against plain Python."""

import hashlib
import random
from collections import defaultdict

import pytest

from landfall.llm import prefix_trie
from landfall.llm.tree_contraction import subtree_totals


def forest() -> list[tuple]:
    """A long chain, a star, a comb, a random tree, lone roots, a missing parent."""
    pick, rows = random.Random(5), []

    def add(parent, depth):
        rows.append((len(rows) * 7 - 400, parent, depth, pick.choice([None, 0, 1, 5]), pick.randrange(100)))
        return rows[-1][0]

    above = None
    for depth in range(300):
        above = add(above, depth)
    top = add(None, 0)
    for _ in range(200):
        add(top, 1)
    above = add(None, 0)
    for depth in range(1, 80):
        add(above, depth)
        above = add(above, depth)
    grown = [(add(None, 0), 0)]
    for _ in range(300):
        node, depth = pick.choice(grown)
        grown.append((add(node, depth + 1), depth + 1))
    add(None, 0)
    orphan = add(10**9, 3)
    add(orphan, 4)
    return rows


def test_subtree_totals(spark):
    rows = forest()
    kids = defaultdict(list)
    for node, parent, *_ in rows:
        kids[parent].append(node)
    value, want = {r[0]: (r[3] or 0, r[4]) for r in rows}, {}
    for node, *_ in sorted(rows, key=lambda r: -r[2]):
        want[node] = tuple(value[node][k] + sum(want[c][k] for c in kids[node]) for k in (0, 1))
    frame = spark.createDataFrame(rows, "id bigint, parent bigint, depth bigint, w bigint, own0 bigint").repartition(3)
    assert {r.id: (r.w, r.own0) for r in subtree_totals(frame, ["w", "own0"]).collect()} == want


def test_forests_without_totals(spark):
    schema = "id bigint, parent bigint, depth bigint, w bigint"
    assert subtree_totals(spark.createDataFrame([], schema), ["w"]).collect() == []
    with pytest.raises(ValueError, match="cycle"):
        subtree_totals(spark.createDataFrame([(1, 2, 0, 1), (2, 1, 1, 1), (3, None, 0, 1)], schema), ["w"])


def trie(turns, more=()):
    """Nodes by plain Python: (conv_id, depth, parent, members, children, leaves, saved bytes, digest of ends)."""
    told = defaultdict(list, {c: [] for c in more if c is not None})
    for c, turn, role, text in turns:
        if c is not None:
            digest = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            told[c].append(((turn is not None, turn or 0, digest[:30]), (role or "", text or "")))
    told = {c: [t for _, t in sorted(rows)] for c, rows in told.items()}
    members = defaultdict(list)
    for c, rows in told.items():
        for d in range(len(rows) + 1):
            members[tuple(rows[:d])].append(c)
    out = []
    for path, inside in members.items():
        below = [p for p in members if p[:len(path)] == path]
        leaves = sum(not any(q[:-1] == p and q for q in members) for p in below)
        ends = ",".join(str(c) for c in sorted(c for c in inside if len(told[c]) == len(path)))
        out.append((min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside),
                    sum(bool(q) and q[:-1] == path for q in members), leaves,
                    sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations() -> list[tuple]:
    pick, rows = random.Random(3), []
    for c in range(-6, 90):
        for turn in range(pick.choice([1, 2, 3, 6])):
            rows.append((c, turn, pick.choice(["user", "assistant"]), pick.choice(["hi", "é", "ab"])))
    rows += [(200, k, "user", f"t{k % 7}") for k in range(40)] + [(201, k, "user", f"t{k % 7}") for k in range(35)]
    rows += [(300, None, "user", "first"), (300, 1, None, None), (300, 1, None, None), (301, None, "user", "first"), (301, 2, "", "")]
    rows += [(None, 0, "user", "hi"), (302, 5, "a", "bc"), (303, 5, "ab", "c"), (304, 1, "user", "long " * 50_000), (305, 9, "user", "long " * 50_000)]
    return rows


@pytest.mark.parametrize(("block", "many"), [(4096, 10_000), (3, 2)])
def test_trie_equals_brute_force(spark, monkeypatch, block, many):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "MANY_CHILDREN", many)
    monkeypatch.setattr(prefix_trie, "ID_BITS", 2)
    rows = conversations()
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'clash' AS place", "'clash' AS k1").repartition(3)
    more = spark.createDataFrame([(400,), (None,), (0,)], "conv_id bigint")
    found = prefix_trie.prefix_trie(prefix_trie.digest_turns(frame), more)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes", "ends_sha256"]
    assert found.columns == names
    assert sorted((tuple(r) for r in found.collect()), key=repr) == trie(rows, [400, None, 0])


def test_empty_trie(spark):
    frame = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert prefix_trie.prefix_trie(prefix_trie.digest_turns(frame)).collect() == []
