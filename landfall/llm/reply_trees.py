"""Reply trees to conversations: the best root-to-leaf paths of each tree, formatted with a reversible template.

Paths are enumerated by iterated self-joins that double the distance: the table of 2**k-th ancestors, joined with itself,
is that of 2**(k+1)-th ones. Scores add up along the same joins, so branches are ranked before any path is spelled out,
and a chosen path of length n takes log n joins. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import bind
from landfall.sources.staging import stage

#: Control strings of the template.
BEGIN, END = "<s>", "</s>"
ROLES = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]")}  # an assistant's text stands alone
OTHER = ("[ROLE]", "[/ROLE]")
_CONTROL = r"/?(?:s>|(?:INST|SYS|ROLE)\])"


def escape(text: Column) -> Column:
    """A control string gets a backslash behind its first character, one more if it has some already."""
    return F.regexp_replace(text, rf"([<\[])(\\*)(?={_CONTROL})", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(?={_CONTROL})", r"$1$2")


def format_turn(role: Column, text: Column) -> Column:
    """``<s>``, the text inside the marks of its role, ``</s>``; an unknown role is spelled out."""
    body = F.concat(F.lit(" "), escape(text), F.lit(" "))
    framed = F.when(role == "assistant", body)
    for name, (opening, closing) in ROLES.items():
        framed = framed.when(role == name, F.concat(F.lit(opening), body, F.lit(closing)))
    framed = framed.otherwise(F.concat(F.lit(f"{OTHER[0]} "), escape(role), F.lit(f" {OTHER[1]}"), body))
    return F.concat(F.lit(BEGIN), framed, F.lit(END))


def read_turns(formatted: Column) -> Column:
    """Array of ``role, text, start, length`` from a formatted conversation; start and length as it stands there."""
    def body(piece: Column, before: int, after: int) -> Column:
        return F.substring(piece, F.lit(before + 1), F.length(piece) - before - after)

    def of(piece: Column) -> Column:
        # ``piece`` is a turn without its end mark.
        turn = F.when(piece.startswith(f"{BEGIN} "), F.struct(
            F.lit("assistant").alias("role"), body(piece, len(BEGIN) + 1, 1).alias("raw"), F.lit(len(BEGIN) + 1).alias("skip")))
        for name, (opening, closing) in ROLES.items():
            skip = len(BEGIN) + len(opening) + 1
            turn = turn.when(piece.startswith(f"{BEGIN}{opening} "), F.struct(
                F.lit(name).alias("role"), body(piece, skip, len(closing) + 1).alias("raw"), F.lit(skip).alias("skip")))
        at = F.locate(f" {OTHER[1]} ", piece)
        skip = at + len(OTHER[1]) + 1
        named = F.substring(piece, F.lit(len(BEGIN) + len(OTHER[0]) + 2), at - len(BEGIN) - len(OTHER[0]) - 2)
        return turn.otherwise(F.struct(unescape(named).alias("role"), F.substring(piece, skip + 1, F.length(piece) - skip - 1).alias("raw"),
                                       skip.alias("skip")))

    def turns(pieces: Column) -> Column:
        read = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: F.struct(of(p).alias("t"), F.length(p).alias("l")))
        # Running start of each turn, as the pieces are read one after another.
        empty = F.struct(F.array().cast("array<struct<role:string,text:string,start:int,length:int>>").alias("turns"), F.lit(0).alias("at"))
        return F.aggregate(read, empty, lambda a, r: F.struct(F.concat(a["turns"], F.array(F.struct(
            r["t"]["role"].alias("role"), unescape(r["t"]["raw"]).alias("text"), (a["at"] + r["t"]["skip"]).alias("start"),
            F.length(r["t"]["raw"]).alias("length")))).alias("turns"), (a["at"] + r["l"] + len(END)).alias("at")), lambda a: a["turns"])

    return bind(F.split(formatted, END), turns)


def enumerate_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """``tree, leaf, rank, score, at, id`` for the messages of the ``best`` branches of each tree.

    ``messages`` has ``tree, id, parent, score``; a message without a parent, or whose parent is missing, is a root. A
    branch is a path from a root to a message without replies; its score is the sum of its messages' scores (null: 0),
    ties go to the smaller leaf id. ``at`` counts from 0 at the root. Of messages with equal tree and id one counts (the
    one with the smallest parent and score); messages in a cycle have no root and are on no path. Null trees and ids
    are values like others. An empty table gives no rows.
    """
    def key(column: str) -> Column:  # equal structs are equal in joins even where a field is null
        return F.struct("tree", F.col(column).alias("id"))

    nodes = stage(messages.groupBy("tree", "id").agg(F.min(F.struct(
        F.col("parent").isNull().alias("top"), "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("m")).select(
        key("id").alias("node"), F.when(~F.col("m.top"), F.struct("tree", F.col("m.parent").alias("id"))).alias("up"), F.col("m.score").alias("score")),
        "tree-nodes")
    known = nodes.select(F.col("node").alias("up"), F.lit(True).alias("there"))
    nodes = stage(nodes.join(known, "up", "left").select("node", F.when(F.col("there"), F.col("up")).alias("up"), "score"), "tree-links")
    # state: what lies 2**k above, messages and score from the node (included) up to there (excluded).
    state = nodes.select("node", "up", F.lit(1).cast("bigint").alias("steps"), "score")
    jumps, most = [], nodes.count()
    while True:
        inner = state.where("up is not null")
        if inner.isEmpty() or 2 ** len(jumps) > most:  # longer chains than there are messages are cycles
            break
        jumps.append(stage(inner.select("node", "up"), f"tree-jump-{len(jumps)}"))
        above = state.select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("steps").alias("_steps"), F.col("score").alias("_score"))
        state = stage(inner.join(above, "up").select(
            "node", F.col("_up").alias("up"), (F.col("steps") + F.col("_steps")).alias("steps"), (F.col("score") + F.col("_score")).alias("score"))
            .unionByName(state.where("up is null")), f"tree-state-{len(jumps)}")
    parents = nodes.where("up is not null").select(F.col("up").alias("node")).distinct()
    branches = state.where("up is null").join(parents, "node", "left_anti").select(
        "node", "steps", "score", F.col("node.tree").alias("tree"), F.col("node.id").alias("leaf"))
    ranked = branches.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")))
    path = stage(ranked.where(F.col("rank") <= best).select(
        "tree", "leaf", "rank", "score", "node", (F.col("steps") - 1).alias("at")), "tree-best")
    for k in range(len(jumps) - 1, -1, -1):
        # From every member so far, the one 2**k above, if there is one: each ancestor is reached exactly once.
        more = path.join(jumps[k], "node").select("tree", "leaf", "rank", "score", F.col("up").alias("node"), (F.col("at") - 2**k).alias("at"))
        path = stage(path.unionByName(more), f"tree-path-{k}")
    return path.select("tree", "leaf", "rank", "score", "at", F.col("node.id").alias("id"))


def format_conversations(messages: DataFrame, best: int = 1) -> DataFrame:
    """``tree, leaf, rank, score, n_turns, formatted, loss_spans`` of the best branches of each tree.

    ``messages`` has ``tree, id, parent, role, text, score``; see :func:`enumerate_paths`. A null text or role is empty.
    ``loss_spans`` are ``start, length`` (code points) of the assistant texts, as they stand in ``formatted``. A whole
    path is one string: a conversation must fit into a row.
    """
    paths = enumerate_paths(messages.select("tree", "id", "parent", "score"), best)
    turns = messages.groupBy(F.struct("tree", "id").alias("node")).agg(F.min(F.struct(
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("m"))
    placed = paths.withColumn("node", F.struct("tree", "id")).join(turns, "node")
    joined = placed.groupBy("tree", "leaf", "rank", "score").agg(F.count("*").alias("n_turns"), F.sort_array(F.collect_list(F.struct(
        "at", format_turn(F.col("m.role"), F.col("m.text")).alias("turn")))).alias("turns"))
    text = F.concat_ws("", F.transform("turns", lambda t: t["turn"]))
    formatted = joined.select("tree", "leaf", "rank", "score", "n_turns", text.alias("formatted"))
    return formatted.withColumn("loss_spans", F.transform(F.filter(read_turns(F.col("formatted")), lambda t: t["role"] == "assistant"),
                                                          lambda t: F.struct(t["start"], t["length"])))
