"""Intermediate tables in the shared scratch folder.

A decision table is small (no document bytes) but expensive (every document is
hashed), and several sinks read it. Writing it once cuts the lineage, survives
the loss of executors and gives the planner exact sizes to choose joins by.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
#: The short side of a join with document bytes is broadcast up to this size, a measured one; answers do not depend on it.
BROADCAST_BYTES = 128 << 20


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="landfall-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the scratch root and read it back."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(rows: DataFrame) -> DataFrame:
    """The short (staged) side of a join whose other side holds document bytes, with a hint by its measured size.

    Few rows are broadcast. More are the built side of a hash join, for which bytes are shuffled once at most, but
    not sorted.
    """
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in rows.dtypes if kind == "string"]
    size = rows.agg(F.coalesce(F.sum(sum(texts, F.lit(16 * len(rows.columns)))), F.lit(0))).first()[0]
    return F.broadcast(rows) if size <= BROADCAST_BYTES else rows.hint("shuffle_hash")
