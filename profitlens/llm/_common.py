"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one Arrow batch: bounds a Python worker's memory when texts are long.
BATCH_ROWS = 512

# A word is a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor sees. Where it is
    unset a scratch folder serves a local session; elsewhere that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="profitlens-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts the lineage and survives lost
    executors. Used for compact intermediates (ids, hashes, counts) that several steps read."""
    path = f"{shared_dir(df.sparkSession)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches of whole texts small enough for the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % k


def join_on(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns that both sides have, null equal to null; the left side's copies stay."""
    own = {c: f"__on{i}" for i, c in enumerate(cols)}
    match = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(x)) for c, x in own.items()])
    return left.join(right.withColumnsRenamed(own), match, how).drop(*own.values())
