"""The landing merge as a stream that remembers: what a batch costs depends on its own rows only.

The last hash of every identifier, and which of its objects exist, are kept in Spark's state store. A batch sends one
narrow row per document to the state of its identifier; records and bytes of documents that are to be written are then
read from the batch's own files. Neither the log nor the objects of earlier batches are read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from landfall.functions import content
from landfall.operators import landing
from landfall.operators.sequence import compute_once
from landfall.plans.ingest import write_landed
from landfall.sources.staging import small_side, stage
from landfall.sources.zones import LandingZone
from landfall.streaming.merge import write_outcomes

#: What is known of a document on its way to the state, as JSON: a group is a few rows, and every column of it costs more than they do. The paths are hashed.
_DOCUMENT = "identifier string, fetch_seq bigint, file_hash string, content_length bigint, reason string, status int, plain bigint, versioned bigint, file string"
_DECIDED = "document string, outcome string, appends boolean"
_STATE = "file_hash string, paths array<bigint>"


def _measured(documents: DataFrame) -> DataFrame:
    read = compute_once(documents.withColumn("file", F.col("_metadata.file_path")), measured=landing.measure(F.col("document_type")))
    hashed = read.select("identifier", "fetch_seq", "body_key", "partition_date", "document_url", "document_type", "file", "measured.*")
    document = F.struct(
        "identifier", "fetch_seq", "file_hash", "content_length", "reason", "status",
        F.xxhash64(landing.object_path(F.lit(None).cast("string"))).alias("plain"),
        F.xxhash64(landing.object_path(content.short_hash(F.col("file_hash")))).alias("versioned"), "file")
    return hashed.select("identifier", F.to_json(document).alias("document"))


def _decide(recheck: bool):
    def order(document: str) -> tuple[bool, int, str | None, int, int, str]:
        """What outcomes depend on, and the document itself; those without a number come last."""
        read = json.loads(document)
        number = read.get("fetch_seq")
        return number is None, number or 0, read.get("file_hash"), read["plain"], read["versioned"], document

    def decide(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Outcomes of one identifier's documents of a batch, in fetch order."""
        previous, paths = state.get if state.exists else (None, [])
        known = set(paths)
        rows = sorted((order(document) for part in parts for document in part["document"]), key=lambda row: row[:2])
        outcomes, appends = [], []
        for _, _, file_hash, plain, versioned, _ in rows:
            failed = file_hash is None
            if not recheck and previous is not None:
                outcome = "skipped"
            elif failed:
                outcome = "failed"
            else:
                outcome = "new" if previous is None else "unchanged" if previous == file_hash else "changed"
            path = plain if outcome == "new" else versioned if outcome == "changed" else None
            appends.append(path is not None and path not in known)
            if path is not None:
                known.add(path)
                previous = file_hash
            outcomes.append(outcome)
        if known or previous is not None:
            state.update((previous, sorted(known)))
        yield pd.DataFrame({"document": [row[-1] for row in rows], "outcome": outcomes, "appends": appends})

    return decide


def keyed_stream(documents: DataFrame, reread: Callable[[list[str]], DataFrame], zone: LandingZone, checkpoint: str, *,
                 run_id: str = "stream", recheck: bool = True) -> StreamingQuery:
    """Land a stream of documents read from files; stops once the input that exists is processed.

    ``documents`` is a stream over a file source with the columns of a document; ``reread`` gives the same columns of
    the files named, as a table. ``fetch_seq`` is unique and grows from batch to batch. Batches are runs, as in
    :func:`landfall.streaming.merge.merge_stream`, and outcomes are the same. All rows of the zone must come from this
    stream: the state knows of no others, so a zone with other runs is refused. An identifier's rows of one batch pass
    one task without their texts; bound a batch by the source's options. With many identifiers, let the session keep the
    state in RocksDB (``spark.sql.streaming.stateStore.providerClass``).
    """
    owner = f"{run_id} {checkpoint}"
    others = zone.owners().filter(~F.startswith("owner", F.lit(f"{owner} ")))
    if not others.isEmpty():
        raise ValueError("the zone has runs of others, which the state does not know")
    if zone.files is not None:
        raise ValueError("a document whose file cannot be written would stay in the state")

    def land(batch: DataFrame, batch_id: int) -> None:
        run_seq = zone.claim(f"{owner} {batch_id}")
        read = batch.select(F.inline(F.array(F.from_json("document", _DOCUMENT))), "outcome", "appends")
        decided = stage(read, "keyed")  # the state is asked once
        files = [r["file"] for r in decided.select("file").distinct().collect()]  # as many as the source puts in a batch
        if not files:
            return
        rows = reread(files)
        columns = ["identifier", "reason", "status", "file_hash", "content_length", "outcome", "appends"]
        details = rows.drop("data", "error", *columns)
        joined = details.join(small_side(decided.select("fetch_seq", *columns)), "fetch_seq").withColumn("payload_seq", F.col("fetch_seq"))
        named = stage(landing.name_objects(joined), "classified")
        write_landed(named, named.filter("appends"), rows, zone, run_id, run_seq)
        write_outcomes(named, zone, run_seq)

    return (
        _measured(documents).groupBy("identifier").applyInPandasWithState(
            _decide(recheck), _DECIDED, _STATE, "update", GroupStateTimeout.NoTimeout)
        .writeStream.outputMode("update").foreachBatch(land).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
