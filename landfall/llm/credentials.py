"""Secrets in texts, and credentials in several parts: weak candidates count only beside their complement.

An assignment to a telling name, an access identifier and a long hexadecimal run are reported as they are. A bare secret
of 40 characters or an address is too common to be reported alone; it is only where an access identifier (for an address,
also a secret) stands nearby in the same scope. Scopes are stretches of text without blank lines. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import bind
from landfall.sources.staging import stage

#: Kinds of spans in order; the first three are the base.
KINDS = ("assign", "access", "hex", "secret", "endpoint")
BASE = 3
# The patterns of the base. Runs of hexadecimal digits and of identifier characters are taken whole, so
# their least length is part of the pattern; the value of an assignment is measured after it was matched.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Weak candidates: a whole run of 40 characters of base 64, padding at its end included, with all three classes; addresses;
#: and blank lines. A '=' before the run is no part of it: it may follow a name.
BARE = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{38,40}={0,2}(?![A-Za-z0-9+/=])"
ENDPOINT = r"[a-z][a-z0-9+.-]*://[^\x00-\x20\x22\x27<>\x7F]+|[a-z0-9-]+(?:\.[a-z0-9-]+)*\.amazonaws\.com"
BLANK = r"\n[\x20\x09\x0D]*\n"
LEAST_VALUE, BARE_LENGTH = 12, 40
#: Code points between the starts of parts that belong together.
REACH = 400
_MARK, _OTHER = "\u0001", "\u0002"


def _cuts(text: Column, pattern: str, kind: int) -> Column:
    """Lengths of the pieces between and of the matches, in turn, as ``kind, turn, length, value``; empty without a match."""
    def of(marked: Column) -> Column:
        return F.when(F.contains(marked, F.lit(_MARK)), F.transform(F.split(marked, _MARK), lambda piece, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("turn"), F.length(piece).alias("length"),
            F.when(i % 2 == 1, piece).alias("value")))).otherwise(F.array())

    return bind(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), of)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Spans of secrets: ``row, doc_id, kind, start, end, value, scope``, and one row per document with a null kind.

    ``docs`` has ``doc_id, text``; other columns are not read. Starts and ends are code points, the end exclusive.
    Spans of one kind do not overlap, spans of different kinds may. Null and empty texts have no spans. ``row`` tells
    repeated documents apart. An empty table gives no rows.
    """
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), _MARK, _OTHER)  # neither is part of a pattern
    blank = len(KINDS)

    def every(t: Column) -> Column:
        whole = F.array(F.struct(F.lit(None).cast("int").alias("kind"), F.lit(0).alias("turn"), F.lit(0).alias("length"),
                                 F.lit(None).cast("string").alias("value")))
        # Weak candidates need an access identifier; without one their patterns are not even tried.
        weak = F.when(t.rlike(ACCESS), F.concat(
            _cuts(t, BARE, 3), _cuts(t, ENDPOINT, 4), _cuts(t, BLANK, blank))).otherwise(F.array())
        return F.concat(whole, _cuts(t, ASSIGN, 0), _cuts(t, ACCESS, 1), _cuts(t, HEX, 2), weak)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")  # before the rows are spread
    pieces = numbered.select("row", "doc_id", F.explode(bind(text, every)).alias("p")).select("row", "doc_id", "p.*")
    pieces = stage(pieces, "secret-pieces")
    along = Window.partitionBy("row", "kind").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    ends = pieces.withColumn("end", F.sum("length").over(along).cast("bigint"))
    value = F.col("value")
    fitting = (F.when(F.col("kind") == 0, F.length(F.regexp_extract(value, ASSIGN, 2)) >= LEAST_VALUE)
               .when(F.col("kind") == 3, (F.length(value) == BARE_LENGTH) & value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]"))
               .otherwise(F.lit(True)))
    spans = ends.where("kind is null or turn % 2 = 1").where(F.col("kind").isNull() | fitting).select(
        "row", "doc_id", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "value")
    # The scope is the number of blank lines before.
    so_far = Window.partitionBy("row").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, 0)
    scoped = spans.withColumn("scope", F.sum((F.col("kind") == blank).cast("int")).over(so_far)).where(
        F.col("kind").isNull() | (F.col("kind") != blank))
    scoped = stage(scoped, "secret-spans")
    return stage(_linked(scoped), "secret-found")


def _linked(spans: DataFrame) -> DataFrame:
    """Base spans, and weak ones with their complements within reach in the same scope."""
    identifiers = spans.where("kind = 1")
    bare = _near(spans.where("kind = 3"), identifiers)
    secrets = bare.select("row", "scope", "start").unionByName(spans.where("kind = 0").select("row", "scope", "start"))
    endpoints = _near(_near(spans.where("kind = 4"), identifiers), secrets)
    return spans.where(f"kind is null or kind < {BASE}").unionByName(bare).unionByName(endpoints)


def _near(candidates: DataFrame, parts: DataFrame) -> DataFrame:
    """Candidates with a part in the same document and scope, at most ``REACH`` apart: an interval join by cells."""
    cell = F.expr(f"start div {REACH}")
    offered = parts.select(F.col("row").alias("_row"), F.col("scope").alias("_scope"), F.col("start").alias("_start"),
                           F.explode(F.sequence(cell - 1, cell + 1)).alias("_cell"))
    return candidates.withColumn("cell", cell).join(
        offered, (F.col("row") == F.col("_row")) & F.col("scope").eqNullSafe(F.col("_scope")) & (F.col("cell") == F.col("_cell"))
        & (F.abs(F.col("start") - F.col("_start")) <= REACH), "left_semi").drop("cell")


def summarize(spans: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of the base spans, and all spans as text."""
    def listed(found: Column) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))

    of_kind = {k: F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k}") for i, k in enumerate(KINDS[:BASE])}
    grouped = spans.groupBy("row", "doc_id").agg(*of_kind.values(), F.sort_array(F.collect_list(
        F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end")))).alias("found"))
    base = F.filter("found", lambda s: s["kind"] < BASE)
    return grouped.select("doc_id", *[f"n_{k}" for k in KINDS[:BASE]], F.sha2(listed(base), 256).alias("base_sha256"),
                          listed(F.col("found")).alias("spans"))
