"""Mix of sources by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import SPACES, running
from landfall.sources.staging import stage

#: Weights of the sources by rank, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the whole mix for each word of the input, and of a source's target at most.
SHARE, CAP = 1.5, 2
#: Words of a block.
BLOCK = 128
#: The fractional part of the golden ratio times 2**53, odd: slot i lies at (i * GOLDEN mod 2**53) / 2**53.
GOLDEN = 5566755282872655


def word_count(text: str):
    """Words of a text column; null and empty texts have none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: shares by weight, capped, the excess reshared.

    Resharing until nothing is above its cap ends at one level: a source takes its weight times the level, or its
    cap. In the order of cap by weight, the capped sources come first, so the level follows from running sums. The
    order of all sources needs one task; it sees one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    weighted = sizes.withColumn("weight", F.get(kinds, ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")))
    weighted = weighted.withColumn("cap", F.col("source_size").cast("double") * cap)
    by_level = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = (F.sum("source_size").over(everything).cast("double") * share
            - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    weight_left = F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = weighted.withColumn("level", left / weight_left).withColumn(
        "open", F.col("level") * F.col("weight") < F.col("cap"))
    level = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)
    return levels.withColumn("common", level["level"]).select(
        "source", "source_size", F.when(F.col("open") & F.col("common").isNotNull(), F.col("common") * F.col("weight"))
        .otherwise(F.least(F.col("cap"), F.coalesce(F.col("common") * F.col("weight"), F.col("cap")))).alias("target"),
        "weight")


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``slot, source, rank, words``: which block of which source comes at each slot of the mix.

    A slot's golden-ratio point falls into the interval of a source in the cumulative targets; its rank counts the
    source's earlier slots. A source is due ``quota`` slots, the last of them cut so that its words are its target to
    the word. Points beyond a source's quota are passed over; where the points fall short, slots follow at the end.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    # One row per source: the end of its interval, its blocks, its quota of blocks, and the words of the last one.
    whole = F.floor(F.col("target")).cast("bigint")
    cycle = F.ceil(F.col("source_size") / F.lit(block)).cast("bigint")
    plan = targets.where("target >= 1").withColumn("taken", whole).withColumn("blocks", cycle).withColumn(
        "rest", F.col("taken") % F.col("source_size")).withColumn(
        "quota", F.expr("taken div source_size") * F.col("blocks") + F.ceil(F.col("rest") / F.lit(block)).cast("bigint"))
    total = F.sum("target").over(Window.partitionBy())
    plan = stage(plan.withColumn("high", F.sum("target").over(ordered) / total).withColumn(
        "low", F.coalesce(F.lag("high").over(Window.orderBy(F.col("source").asc_nulls_last())), F.lit(0.0))), "mix-plan")
    slots = int(plan.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0])
    spark = targets.sparkSession
    # i * GOLDEN mod 2**53 without overflow: both factors are split into parts of at most 27 bits.
    i, low, mask = F.col("slot"), 2**26, 2**53 - 1
    point = (i * (GOLDEN % low) + F.pmod(i * (GOLDEN // low), F.lit(2**27)) * low).bitwiseAND(F.lit(mask)) / F.lit(float(2**53))
    # Sources are few in number, but not proven so: the point's cell of a grid leads to the sources that overlap it.
    cells = 4096
    points = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", point).withColumn(
        "cell", F.floor(F.col("point") * cells))
    spans = plan.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)))))
    drawn = points.join(spans.select("source", "low", "high", "cell"), "cell").where("low <= point and point < high").select(
        "source", "slot")
    ranked = running(drawn, ["source"], ["slot"], None, "mix-ranks").select("source", "slot", F.col("place").alias("rank"))
    due = ranked.join(plan.select(F.col("source").alias("_source"), "quota"),
                      F.col("source").eqNullSafe(F.col("_source"))).where("rank < quota").select("source", "slot", "rank")
    due = stage(due, "mix-due")
    reached = due.groupBy("source").agg(F.count("*").alias("have")).withColumnRenamed("source", "_source")
    short = plan.join(reached, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn(
        "have", F.coalesce("have", F.lit(0))).where("have < quota").select(
        "source", F.explode(F.sequence(F.col("have"), F.col("quota") - 1)).alias("rank"))
    tail = short.select("source", (F.lit(slots) + F.col("rank")).alias("slot"), "rank")
    listed = due.unionByName(tail)
    sized = plan.select(F.col("source").alias("_source"), "blocks", "source_size", "quota", "rest")
    block_no = F.col("rank") % F.col("blocks")
    full = F.least(F.lit(block), F.col("source_size") - block_no * block)
    last = (F.col("rank") == F.col("quota") - 1) & (F.col("rest") > 0)
    return listed.join(sized, F.col("source").eqNullSafe(F.col("_source"))).select(
        "slot", "source", "rank", block_no.alias("block"),
        F.when(last, F.col("rest") - block_no * block).otherwise(full).alias("words"))


def mix(docs: DataFrame, block: int = BLOCK, weights: tuple = WEIGHTS, share: float = SHARE, cap: int = CAP,
        carry: tuple = ()) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, first_slot`` and the ``carry`` columns of every document.

    Each source's documents are shuffled by a hash of their id and cut into blocks of ``block`` words; the schedule
    draws blocks, a source's second pass begins when all its blocks are drawn. ``taken`` counts the words of the
    document in drawn blocks, repeats included; no document exceeds ``cap`` times its size. ``first_slot`` is the slot of
    the schedule at which the mix first takes words of the document, null if it takes none: the order of the mix. A null text has no words, a
    document without words is taken 0 times; null sources are one source, which comes last; repeated rows are
    documents of their own. Other columns are not read. An empty table gives no rows.
    """
    sized = stage(docs.select("doc_id", "source", *carry, word_count("text").alias("size"),
                              F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_order")),
                  "mix-sizes")
    targets = stage(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap),
                    "mix-targets")
    placed = stage(running(sized, ["source"], ["_order", "size"], "size", "mix-order").drop("_order"), "mix-placed")
    drawn = schedule(targets, block)
    # How often each block is drawn: in full or, the last one, in part.
    uses = drawn.groupBy("source", "block").agg(F.collect_list(F.struct("words", "slot")).alias("draws"))  # at most ``cap`` draws
    first, last = F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")
    pieces = placed.where("size > 0").select(
        "doc_id", "source", "place", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    end = F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block))
    pieces = pieces.select("source", "place", "block", begin.alias("begin"), end.alias("end"))
    uses = stage(uses.withColumnRenamed("source", "_source").withColumnRenamed("block", "_block"), "mix-uses")
    words = F.aggregate("draws", F.lit(0).cast("bigint"), lambda total, draw: total + F.greatest(
        F.least(F.col("end").cast("bigint"), draw["words"]) - F.col("begin"), F.lit(0)))
    reached = F.filter("draws", lambda draw: F.least(F.col("end"), draw["words"]) > F.col("begin"))
    taken = pieces.join(uses, (F.col("block") == F.col("_block")) & F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("source").alias("_source"), F.col("place").alias("_place"), words.alias("words"),
        F.array_min(F.transform(reached, lambda draw: draw["slot"])).alias("slot"))
    taken = taken.groupBy("_source", "_place").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    whole = placed.join(taken, (F.col("place") == F.col("_place")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    named = targets.select(F.col("source").alias("_of"), "source_size", "target")
    return whole.join(named, F.col("source").eqNullSafe(F.col("_of"))).select(
        "doc_id", "source", *carry, "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
        "first_slot")
