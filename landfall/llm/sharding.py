"""Shards by jump consistent hashing: no ring table, and one more shard takes rows only into itself."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from landfall.llm.common import running

#: The multiplier of the published algorithm's 64-bit linear congruential generator (a fixed value).
JUMP_MULTIPLIER = 2862933555777941757


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, from 0, of each 64-bit key: the last jump of its pseudo-random sequence below ``shards``."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), dtype=np.int64)
    going = np.arange(len(state))
    ahead = np.zeros(len(state), dtype=np.int64)
    while len(going):
        shard[going] = ahead[going]
        state[going] = state[going] * np.uint64(JUMP_MULTIPLIER) + np.uint64(1)
        scale = float(1 << 31) / ((state[going] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[going] = ((shard[going] + 1) * scale).astype(np.int64)
        going = going[ahead[going] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a long key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @pandas_udf("int")
    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(), shards).astype(np.int32))

    return of(key)


def shard_table(rows: DataFrame, key: str, shards: int, keep: list[str]) -> DataFrame:
    """``keep`` columns with ``shard``, ``slot`` (gapless from 0 in each shard) and ``grown_shard`` (one more shard).

    The key and the number of shards alone decide; null keys all go to one shard. Slots follow the hash of the key,
    rows of one key stand together in an arbitrary order. Shards may be few and large: slots are numbered by ranges
    that many tasks share. Repeated rows each get a slot; an empty table gives no rows.
    """
    hashed = rows.select(*keep, F.xxhash64(key).alias("_hash"))
    placed = running(hashed.withColumn("shard", shard_of(F.col("_hash"), shards)), ["shard"], ["_hash"], None, "shards")
    return placed.select(*keep, "shard", F.col("place").alias("slot"),
                         shard_of(F.col("_hash"), shards + 1).alias("grown_shard"))


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, grown_shard`` of every document; see :func:`shard_table`.

    ``size`` is the UTF-8 length of the text plus 1; a null text has no bytes. Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"))
    return shard_table(slim, "doc_id", shards, ["doc_id", "size", "text_crc32"])
