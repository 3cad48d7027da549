"""The trie of conversation prefixes: what conversations have in common from their first turn on.

A prefix is known by its length and a hash of 120 bits that is carried from turn to turn, so texts are read once and never
moved. A conversation may hold a large part of all turns and a prefix may be shared by most conversations: turns are
numbered by ranges, hashes run within blocks of turns, and members of a prefix only meet in aggregates with map-side
combine. Totals of subtrees come from :mod:`landfall.llm.tree_contraction`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import running
from landfall.llm.tree_contraction import subtree_totals
from landfall.sources.staging import small_side, stage

#: Turns that a hash runs over in one window.
BLOCK = 4096
#: A node with this many children or more is found by a broadcast of such nodes (if they are few), others by shuffle.
MANY_CHILDREN = 10_000
#: Ids up to 2**ID_BITS apart are written out together.
ID_BITS = 12
_KEY = ["depth", "k1", "k2"]


def digest_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, a, b, bytes``: turns without their texts; ``a, b`` are 120 bits of a hash of role and text.

    ``turns`` has ``conv_id, turn, role, text``. A null role or text is empty; rows without ``conv_id`` are in no
    conversation and left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    told = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    read = turns.where("conv_id is not null").select("conv_id", "turn", told.alias("told"), F.octet_length(text).cast("bigint").alias("bytes"))
    return read.select("conv_id", "turn", *[F.conv(F.substring("told", start, 15), 16, 10).cast("bigint").alias(name)
                                            for name, start in (("a", 1), ("b", 16))], "bytes")


def number_turns(digested: DataFrame, name: str) -> DataFrame:
    """Digested turns with their ``place`` in the conversation, from 0: by turn, null first, equal ones by digest."""
    return running(digested, ["conv_id"], ["turn", "a", "b"], None, name).drop("start")


def _prefixes(digested: DataFrame) -> DataFrame:
    """Every turn with the keys of the prefix that it ends (``k1, k2``) and of the one before it (``p1, p2``)."""
    placed = stage(number_turns(digested, "trie").select("conv_id", "place", F.floor(F.col("place") / BLOCK).alias("block"), "bytes", *[
        F.xxhash64(F.lit(seed), "place", "a", "b").alias(k) for seed, k in ((1, "h1"), (2, "h2"))]), "trie-places")
    running_key = Window.partitionBy("conv_id", "block").orderBy("place")
    keyed = placed.withColumns({f"k{i}": F.bit_xor(f"h{i}").over(running_key) for i in (1, 2)})
    # Only conversations longer than a block have something to carry.
    ends = placed.groupBy("conv_id", "block").agg(*[F.bit_xor(f"h{i}").alias(f"e{i}") for i in (1, 2)])
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = stage(ends.select("conv_id", "block", *[F.bit_xor(f"e{i}").over(before).alias(f"c{i}") for i in (1, 2)]).where("block > 0"), "trie-carried")
    joined = keyed.join(small_side(carried), ["conv_id", "block"], "left")

    def carry(i: int) -> Column:
        return F.col(f"k{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0).cast("bigint")))

    return joined.select("conv_id", (F.col("place") + 1).alias("depth"), "bytes", *[carry(i).alias(f"k{i}") for i in (1, 2)],
                         *[carry(i).bitwiseXOR(F.col(f"h{i}")).alias(f"p{i}") for i in (1, 2)])


def prefix_trie(digested: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """The nodes of the trie, one row each.

    ``digested`` comes from :func:`digest_turns`; ``conversations`` (``conv_id``) names conversations that may have no
    turn, besides those that have some. A node is a distinct sequence of first turns, ``depth`` of them; its members are
    the conversations that start with it. ``conv_id`` is the smallest member, ``parent_conv_id`` the parent's ``conv_id``
    (null for the root, the empty sequence). ``n_convs`` counts members, ``n_children`` children, ``n_leaves`` the
    childless nodes of the subtree, the node included; ``saved_bytes`` sums, over the subtree, the bytes of each node's
    last text times its members but one. ``ends_sha256`` is the hash of the ids of the conversations that end here, as
    text, ascending, joined by commas. Equal turns of a conversation all count. Without conversations there is no node.
    """
    rows = stage(_prefixes(digested), "trie-prefixes")
    known = digested.select("conv_id") if conversations is None else digested.select("conv_id").unionByName(conversations.select("conv_id"))
    none = F.lit(None).cast("bigint")
    tops = known.where("conv_id is not null").distinct().select("conv_id", *[F.lit(0).cast("bigint").alias(c) for c in ("depth", "bytes", "k1", "k2")],
                                                                none.alias("p1"), none.alias("p2"))
    members = rows.unionByName(stage(tops, "trie-roots"))
    nodes = stage(members.groupBy(*_KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"), F.min("p1").alias("p1"),
        F.min("p2").alias("p2")).withColumn("id", F.monotonically_increasing_id()), "trie-nodes")
    linked = stage(_link(nodes), "trie-linked")
    totals = subtree_totals(linked.withColumn("leaf", (F.col("n_children") == 0).cast("bigint")).withColumn(
        "saved", (F.col("n_convs") - 1) * F.col("bytes")), ["leaf", "saved"])
    nothing = hashlib.sha256(b"").hexdigest()
    return linked.join(totals.select("id", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_bytes")), "id").join(
        _ends(members, nodes), "id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def _link(nodes: DataFrame) -> DataFrame:
    """Nodes with their ``parent``, ``parent_conv_id`` and ``n_children``."""
    above = ["depth", "p1", "p2"]
    fans = nodes.where("depth > 0").groupBy(*above).agg(F.count("*").alias("n_children"))
    parents = stage(nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"),
                                 F.col("k1").alias("p1"), F.col("k2").alias("p2")).join(fans, above), "trie-parents")
    # All children of a node with many would meet in one task.
    broad = small_side(stage(parents.where(F.col("n_children") >= MANY_CHILDREN), "trie-broad"))
    children = nodes.where("depth > 0")
    found = children.join(broad, above).unionByName(children.join(broad, above, "left_anti").join(
        parents.where(F.col("n_children") < MANY_CHILDREN), above)).drop("n_children")
    roots = nodes.where("depth = 0").withColumns({"parent": F.lit(None).cast("bigint"), "parent_conv_id": F.lit(None).cast("bigint")})
    return found.unionByName(roots).join(parents.select(F.col("parent").alias("id"), "n_children"), "id", "left").select(
        "id", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "bytes", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"))


def _ends(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """``id, ends_sha256`` of the nodes where conversations end.

    A digest is taken in order, so the ids of a node pass one task; they come as texts of up to ``2**ID_BITS`` ids each,
    and the task holds one of them.
    """
    last = members.groupBy("conv_id").agg(F.max(F.struct(*_KEY)).alias("key")).select("conv_id", "key.*")
    texts = last.groupBy(*_KEY, F.shiftright("conv_id", ID_BITS).alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    named = texts.join(nodes.select("id", *_KEY), _KEY).select("id", "part", "ids")
    return named.repartition("id").sortWithinPartitions("id", "part").mapInArrow(_hash_groups, "id bigint, ends_sha256 string")


def _hash_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts of each id, joined by commas; the rows of an id follow each other."""
    current, state = None, None

    def rows(done: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())],
                                          names=["id", "ends_sha256"])

    for batch in batches:
        done = []
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(2)):
            if state is not None and key == current:
                state.update(b",")
            else:
                if state is not None:
                    done.append((current, state.hexdigest()))
                current, state = key, hashlib.sha256()
            state.update(ids.as_py().encode())
        yield rows(done)
    if state is not None:
        yield rows([(current, state.hexdigest())])
