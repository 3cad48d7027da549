"""Benchmark passages in documents, by winnowing: the least k-gram hash of every sliding window is a fingerprint.

Two texts that share ``window`` words share the k-grams of these words, hence the least of them, which is a fingerprint
of both. So joining fingerprints finds every shared span of ``window`` words, and extending each hit word by word, up
to the window's length to both sides, decides exactly. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import NON_WORD, bind, lower_ascii, split_words
from landfall.sources.staging import stage

#: Words that a passage must share, and words of a hashed gram.
WINDOW, GRAM = 10, 5
#: A fingerprint table up to this many rows (of some 300 bytes) is broadcast, a larger one is joined by shuffle.
BROADCAST_ROWS = 100_000


def word_array(text: Column) -> Column:
    return split_words(lower_ascii(text), NON_WORD)


def _gram(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(words, at + k) for k in range(size)])


def _run(values: Column, at: Column, step: int, most: int) -> Column:
    """How many neighbours in one direction, ``most`` at most, are not less than the value at ``at``."""
    value, count = F.get(values, at), F.lit(0)
    for k in range(most, 0, -1):
        count = F.when(F.get(values, at + step * k) >= value, count + 1).otherwise(0)
    return count


def fingerprints(words: Column, window: int, gram: int, short: list[int]) -> Column:
    """Array of ``hash, pos, before, around``: winnowed grams, and all grams of the lengths in ``short``.

    ``around`` holds the words that an extension may reach, ``before`` how many of them precede the gram.
    """
    reach = window - gram

    def entry(w: Column, at: Column, size: int, hashed: Column, side: int) -> Column:
        begin = F.greatest(at - side, F.lit(0))
        return F.struct(hashed.alias("hash"), at.alias("pos"), (at - begin).alias("before"),
                        F.slice(w, begin + 1, at - begin + size + side).alias("around"), F.lit(size).alias("size"))

    def winnow(w: Column, hashes: Column) -> Column:
        # A gram is the least of some window of reach + 1 grams if that many in a row around it are not less.
        chosen = F.filter(F.sequence(F.lit(0), F.size(w) - gram), lambda i: _run(hashes, i, -1, reach) + _run(hashes, i, 1, reach) >= reach)
        return F.transform(chosen, lambda i: entry(w, i, gram, F.get(hashes, i), reach))

    def every(w: Column, size: int) -> Column:
        return F.when(F.size(w) >= size, F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: entry(
            w, i, size, _gram(w, i, size), 0))).otherwise(F.array())

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - gram), lambda i: _gram(w, i, gram))
        found = [F.when(F.size(w) >= window, bind(hashes, lambda h: winnow(w, h))).otherwise(F.array())]
        return F.concat(*found, *[every(w, size) for size in short])

    return bind(words, of)


def _alike(left: int, right: int, step: int, most: int) -> Column:
    """Equal words in a row from the gram on in one direction; left and right are places beside the gram."""
    count = F.lit(0)
    for k in range(most - 1, -1, -1):
        count = F.when(F.get("around", left + step * k) == F.get("item_around", right + step * k), count + 1).otherwise(0)
    return count


def find_passages(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Every document's words inside passages of items: ``doc_id, text_key, n_words, n_hit, items`` (sorted ids as text).

    ``docs`` has ``doc_id, text``; ``items`` has ``item_id, text``; other columns are not read. A passage is ``window``
    consecutive words of an item, or the whole of an item that has fewer words. All occurrences count. Null and empty
    texts have no words: such a document has no hits, such an item no passage. Equal items are compared once and all
    named; an item without id is named by an empty text; repeated documents each get their row. Without items nothing
    is hit; without documents there are no rows. ``text_key`` is a hash of the text, to join the rows back.
    """
    if not 0 < gram <= window:
        raise ValueError("a gram has between 1 and window words")
    texts = stage(items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), word_array(F.col("text")).alias("words")).where(
        F.size("words") > 0).groupBy("words").agg(F.array_sort(F.collect_set("id")).alias("ids")).withColumn(
        "item", F.monotonically_increasing_id()), "passage-items")
    short = [r[0] for r in texts.where(F.size("words") < window).select(F.size("words")).distinct().collect()]  # below window
    listed = texts.select("item", F.size("words").alias("length"), F.explode(fingerprints(F.col("words"), window, gram, short)).alias("f"))
    # A gram of a short length only stands for the items that are no longer than it.
    listed = listed.where((F.col("length") >= window) & (F.col("f.size") == gram) & (F.size("f.around") >= window) | (F.col("length") == F.col("f.size")))
    marks = stage(listed.select(F.col("f.hash").alias("hash"), "item", F.col("f.before").alias("item_before"), F.col("f.around").alias("item_around"),
                                F.col("length").alias("item_length")), "passage-marks")
    few = marks.count() <= BROADCAST_ROWS

    nothing = F.array(F.struct(F.lit(None).cast("bigint").alias("hash"), F.lit(-1).alias("pos"), F.lit(0).alias("before"),
                               F.array().cast("array<string>").alias("around"), F.lit(0).alias("size")))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_key"),
                       word_array(F.col("text")).alias("words"))
    spread = rows.select("row", "doc_id", "text_key", F.explode(bind(F.col("words"), lambda w: F.concat(F.transform(nothing, lambda e: F.struct(
        e["hash"].alias("hash"), e["pos"].alias("pos"), F.size(w).alias("before"), e["around"].alias("around"), e["size"].alias("size"))),
        fingerprints(w, window, gram, short)))).alias("f")).select("row", "doc_id", "text_key", "f.*")
    met = spread.join(F.broadcast(marks) if few else marks, "hash", "left").where("pos < 0 or item is not null")
    reach = window - gram
    back = _alike(F.col("before") - 1, F.col("item_before") - 1, -1, reach)
    ahead = _alike(F.col("before") + F.col("size"), F.col("item_before") + F.col("size"), 1, reach)
    same = F.slice("around", F.col("before") + 1, F.col("size")) == F.slice("item_around", F.col("item_before") + 1, F.col("size"))
    sized = met.select(
        "row", "doc_id", "text_key", "pos", "item", F.when(F.col("pos") < 0, F.col("before")).alias("n_words"),
        F.when((F.col("pos") >= 0) & same, F.when(F.col("item_length") < window, F.struct(F.lit(0).alias("back"), F.lit(0).alias("ahead")))
               .otherwise(F.struct(back.alias("back"), ahead.alias("ahead")))).alias("more"), "size", "item_length")
    found = stage(sized.where((F.col("pos") < 0) | (F.col("more.back") + F.col("size") + F.col("more.ahead") >= F.least(F.lit(window), F.col("item_length")))).select(
        "row", "doc_id", "text_key", "n_words", "item", (F.col("pos") - F.col("more.back")).alias("first"),
        (F.col("pos") + F.col("size") + F.col("more.ahead") - 1).alias("last")), "passage-hits")
    hits = found.where("item is not null")
    words = hits.select("row", F.explode(F.sequence("first", "last")).alias("at")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    named = hits.select("row", "item").distinct().join(texts.select("item", "ids"), "item").groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"))
    return found.where("item is null").select("row", "doc_id", "text_key", F.col("n_words").cast("bigint").alias("n_words")).join(
        words, "row", "left").join(named, "row", "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
