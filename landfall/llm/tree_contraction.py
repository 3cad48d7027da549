"""Subtree totals of all nodes of a forest by parallel tree contraction.

Each round rakes all leaves, adding their totals to their parents, and compresses chains: of nodes with one child, those
that win against the neighbours in their chain are spliced out, the child moving up and carrying what the spliced node
adds. A round takes a few joins, and the number of rounds grows with the logarithm of the nodes, however deep or broad
the tree is. Spliced nodes are then expanded in reverse order: their total is the child's and what they add.

Joins are by nodes that occur once on either side; children of one parent only meet in aggregates with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.sources.staging import stage


def _priority(depth: str, turn: int) -> Column:
    """Odd depths first, then those that only 2 divides, and so on: a whole chain is halved. Equal ones by chance."""
    odd = F.bin(F.col(depth).bitwiseAND(F.lit(0) - F.col(depth)))  # the lowest bit that is set
    return F.struct((-F.length(odd)).alias("odd"), F.xxhash64(F.col(depth), F.lit(turn)).alias("chance"), F.col(depth).alias("depth"))


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``id`` and the sums of ``values`` (integers) over the subtree of each node, the node included.

    ``nodes`` has ``id, parent`` (unique integers, a root's parent is null or missing), ``depth`` (a number that differs
    along every path from a root, such as the distance from it) and the values, null counting 0; other columns are not
    read. Ids must be unique. An empty table gives no rows; nodes in a cycle are an error.
    """
    def named(mark: str) -> list[str]:
        return [f"{mark}{i}" for i in range(len(values))]

    own, extra, gain = named("own"), named("extra"), named("gain")
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("kids"))
    # own: the node's value and those of its raked children; extra: of spliced nodes between it and its parent.
    live = stage(nodes.select("id", "parent", "depth", *[F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias(o) for v, o in zip(values, own)],
                              *[F.lit(0).cast("bigint").alias(e) for e in extra]).join(kids, "id", "left").withColumn(
        "kids", F.coalesce("kids", F.lit(0))), "tree-live-0")
    rounds, left = [], live.count()
    while left:
        leaves = live.where("kids = 0")
        sums = leaves.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(
            F.count("*").alias("gone"), *[F.sum(F.col(o) + F.col(e)).alias(g) for o, e, g in zip(own, extra, gain)])
        raked = stage(live.where("kids > 0").join(sums, "id", "left").select(
            "id", "parent", "depth", *[(F.col(o) + F.coalesce(g, F.lit(0))).alias(o) for o, g in zip(own, gain)], *extra,
            (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids")), f"tree-raked-{len(rounds)}")
        spliced = stage(_splice(raked, own, extra, gain, len(rounds)), f"tree-spliced-{len(rounds)}")
        rounds.append((leaves.select("id", *own), spliced.select("id", "child", *gain)))
        # Spliced nodes go; their children move up.
        moves = spliced.select("id", F.lit(True).alias("gone")).unionByName(spliced.select(
            F.col("child").alias("id"), F.lit(False).alias("gone"), F.col("parent").alias("_parent"),
            *[(F.col(g) + F.col(e)).alias(f"_{e}") for g, e in zip(gain, extra)]), allowMissingColumns=True)
        live = stage(raked.join(moves, "id", "left").where("gone is null or not gone").select(
            "id", F.when(F.col("gone").isNull(), F.col("parent")).otherwise(F.col("_parent")).alias("parent"), "depth", *own,
            *[F.coalesce(f"_{e}", e).alias(e) for e in extra], "kids"), f"tree-live-{len(rounds)}")
        before, left = left, live.count()
        if left == before:
            raise ValueError("nodes in a cycle have no subtree")
    totals = None
    for raked, spliced in reversed(rounds):
        if totals is None:
            totals = raked
            continue
        found = spliced.join(totals.withColumnRenamed("id", "child"), "child").select("id", *[(F.col(g) + F.col(o)).alias(o) for g, o in zip(gain, own)])
        totals = stage(totals.unionByName(raked).unionByName(found), "tree-totals")
    if totals is None:
        totals = live.select("id", *own)
    return totals.select("id", *[F.col(o).alias(v) for o, v in zip(own, values)])


def _splice(raked: DataFrame, own: list[str], extra: list[str], gain: list[str], turn: int) -> DataFrame:
    """``id, child, parent``, what each spliced node adds to its child's total (``gain``), and its ``extra``."""
    only = raked.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(
        F.count("*").alias("many"), F.max("id").alias("child"), *[F.max(e).alias(f"child_{e}") for e in extra]).where("many = 1").drop("many")
    unary = raked.where("kids = 1").join(only, "id").withColumn("priority", _priority("depth", turn))
    below = unary.select(F.col("id").alias("child"), F.col("priority").alias("below"))
    # Of two neighbours in a chain, the one of lower priority stays.
    beaten = unary.join(below, "child").select(F.when(F.col("priority") > F.col("below"), F.col("child")).otherwise(F.col("id")).alias("id"))
    return unary.join(beaten, "id", "left_anti").select(
        "id", "child", "parent", *extra, *[(F.col(o) + F.col(f"child_{e}")).alias(g) for o, e, g in zip(own, extra, gain)])
