"""Quality rules: simple counts, and a hashed n-gram log-likelihood ratio of trusted texts to the raw corpus.

Words and word pairs are hashed to buckets; two multinomials over the buckets are estimated, from trusted texts and from
all texts. The mean log ratio over a text's n-grams says how much likelier it is as a trusted text. DataFrame functions
only; ratios are rounded to fixed-point numbers, so sums, hence verdicts, do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import bind, split_words
from landfall.sources.staging import small_side, stage

#: Buckets of the hash, and the count added to each trusted one; raw counts get the same share of their total.
BUCKETS, SMOOTHING = 2**16, 2.0
#: A text whose mean log ratio is below this is rejected. Chosen so that 95 of 100 good texts that are not among the
#: trusted ones stay even where these are few (some 150).
THRESHOLD = -0.22
#: Rules: words at least, share of repeated words in per cent at most, words of a window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
_FIXED = float(2**24)


def buckets(words: Column, count: int = BUCKETS) -> Column:
    """Buckets of all words and pairs of neighbouring words."""
    single = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(count)).cast("int"))
    pairs = F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.pmod(
        F.xxhash64(F.get(words, i), F.get(words, i + 1)), F.lit(count)).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.concat(single, pairs)


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more, first occurrences included."""
    def covered(places: Column) -> Column:
        # Sorted starts of repeated windows: each covers its words up to the next start.
        start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("total"))
        return F.aggregate(places, start, lambda a, p: F.struct(p.alias("last"), (a["total"] + F.when(
            a["last"] < 0, F.lit(window)).otherwise(F.least(F.lit(window), p - a["last"]))).alias("total")), lambda a: a["total"])

    def twice(hashes: Column) -> Column:
        def of(ordered: Column) -> Column:
            same = F.filter(ordered, lambda x, i: (F.get(ordered, i - 1)["h"] == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"]))
            return covered(F.sort_array(F.transform(same, lambda x: x["i"])))

        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bind(ordered, of))

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(
            *[F.get(w, i + k) for k in range(window)]))
        return F.when(F.size(w) < window, F.lit(0)).otherwise(bind(hashes, twice))

    return bind(words, of).cast("bigint")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return bind(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("bigint")


def base_counts(words: Column, text: Column) -> dict[str, Column]:
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.aggregate(words, F.lit(0).cast("bigint"), lambda total, w: total + F.length(w)),
        "n_symbols": F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("bigint"),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeated_words(words),
    }


def gram_counts(texts: DataFrame, count: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all n-grams of the column ``text``."""
    grams = texts.select(F.explode(bind(split_words(F.col("text")), lambda w: buckets(w, count))).alias("bucket"))
    return grams.groupBy("bucket").agg(F.count("*").alias("n"))


def trusted_texts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Documents whose ``doc_id`` is in ``trusted``. Texts are filtered in place where the ids are measured to be few,
    otherwise shuffled once, unsorted."""
    ids = stage(trusted.where("doc_id is not null").select("doc_id").distinct(), "ratio-trusted")
    return docs.join(small_side(ids), "doc_id", "left_semi")


def bucket_counts(docs: DataFrame, trusted: DataFrame, count: int = BUCKETS) -> DataFrame:
    """``bucket, good, raw``: n-grams of trusted texts (all of them count) and of all texts, staged: ``count`` rows at most."""
    raw = gram_counts(docs, count).withColumnRenamed("n", "raw")
    good = gram_counts(trusted_texts(docs.select("doc_id", "text"), trusted), count).withColumnRenamed("n", "good")
    return stage(raw.join(good, "bucket", "left").select("bucket", F.coalesce("good", F.lit(0)).alias("good"), "raw"), "ratio-counts")


def _ratio(good: Column, raw: Column, all_good: Column, all_raw: Column, smoothing: float) -> Column:
    """(good + s) / (all good + s * count) by (raw + s * r) / (all raw + s * r * count), where r = all raw / all good."""
    share = F.when(all_raw > 0, all_good / all_raw).otherwise(0.0)
    return F.when(all_good > 0, F.round(F.log((good + smoothing) / (raw * share + smoothing)) * _FIXED)).otherwise(0).cast("bigint")


def _tallied(words: Column, count: int) -> Column:
    """Array of ``bucket, times, own`` of a text's n-grams, each bucket once; ``own`` counts all of them."""
    def of(ordered: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), F.size(ordered)), lambda i: F.coalesce(F.get(ordered, i) != F.get(ordered, i - 1), F.lit(True)))
        return bind(ends, lambda e: F.transform(e, lambda end, k: F.struct(
            F.get(ordered, end - 1).alias("bucket"), (end - F.when(k > 0, F.get(e, k - 1)).otherwise(0)).alias("times"),
            F.size(ordered).alias("own"))))

    return bind(F.sort_array(buckets(words, count)), lambda o: F.when(F.size(o) > 0, of(o)))


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, count: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """Every document's counts, ``log_ratio`` (mean over its n-grams), ``base_failed`` and ``kept``.

    ``docs`` has ``doc_id, text``; ``trusted`` has the ``doc_id`` of trusted documents; other columns are not read. A
    trusted document is scored with its own n-grams left out of both multinomials, so that it is judged as an unknown
    one is (its copies still count). Null and empty texts have no words: all counts are 0, ``log_ratio`` is null and the
    rules fail. Repeated rows are judged alike. Without trusted texts all ratios are 0. An empty table gives no rows.
    """
    counts = bucket_counts(docs, trusted, count)
    all_good, all_raw = (F.lit(n) for n in counts.agg(F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("raw"), F.lit(0))).first())
    # ``count`` buckets at most: 1 MB.
    ratios = F.broadcast(stage(counts.select("bucket", _ratio(F.col("good"), F.col("raw"), all_good, all_raw, smoothing).alias("ratio")), "ratios"))
    keyed = [F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_key")]
    counted = docs.select(*keyed, "text").select(
        "row", "doc_id", "text_key", F.inline(bind(split_words(F.col("text")), lambda w: F.array(F.struct(
            *[c.alias(n) for n, c in base_counts(w, F.col("text")).items()], buckets(w, count).alias("_buckets"))))))
    names = ["row", "doc_id", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    grams = counted.select(*names, F.explode_outer("_buckets").alias("bucket"))
    total = grams.join(ratios, "bucket", "left").groupBy(*names).agg(F.sum("ratio").alias("_sum"), F.count("ratio").alias("_n"))

    # Trusted texts again, against the counts of all others.
    own = trusted_texts(docs.select("doc_id", "text"), trusted).select(
        *keyed, bind(split_words(F.col("text")), lambda w: _tallied(w, count)).alias("_tallied")).select(
        "row", "doc_id", "text_key", F.inline("_tallied"))
    without = _ratio(F.col("good") - F.col("times"), F.col("raw") - F.col("times"), all_good - F.col("own"), all_raw - F.col("own"), smoothing)
    apart = own.join(F.broadcast(counts), "bucket").groupBy("row", "doc_id", "text_key").agg(F.sum(without * F.col("times")).alias("_apart"))
    apart = apart.groupBy("doc_id", "text_key").agg(F.max("_apart").alias("_apart"))
    total = total.join(apart, ["doc_id", "text_key"], "left")

    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    mean = F.when(F.col("_n") > 0, F.coalesce("_apart", "_sum") / F.lit(_FIXED) / F.col("_n"))
    return total.select("doc_id", *names[3:], mean.alias("log_ratio"), failed.alias("base_failed"),
                        (~failed & F.coalesce(mean >= threshold, F.lit(False))).alias("kept"))
