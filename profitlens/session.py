"""Spark session and lineage helpers."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants: adaptive execution (runtime broadcast conversion,
# partition coalescing, skew-join splitting), UTC timestamps, no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE coalesce the partitions of persisted intermediates as well
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "profitlens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``, which the
    deployment sets on a cluster. Where it is unset a scratch folder serves a
    local session (tests); elsewhere that is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")
        d = tempfile.mkdtemp(prefix="profitlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


# Spark deletes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries that are run inside leave no shuffle files on the executors' disks. For those that write a table:
    nothing reads their shuffles afterwards."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write df as a Parquet table under the shared checkpoint folder and read it
    back: durable, columnar, the lineage ends here, and so do the shuffles that made it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{label}/{uuid.uuid4().hex}"
    with shuffles_deleted(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, durable: bool = False) -> DataFrame:
    """An intermediate that several later steps read. ``durable``: one that is dear
    (a whole waterfall) and read by several branches, staged in any mode.

    The mode comes from the session conf ``profitlens.materialize``:
      ``lazy``    (default) stays part of the plan: nothing runs while a report is
                  built, and Spark reuses the exchanges that its readers share;
      ``parquet`` written as a Parquet table under the shared
                  ``spark.checkpoint.dir`` and read back (durable, columnar, cuts
                  the lineage: for reports whose intermediates are dear);
      ``checkpoint`` reliable checkpoint into the same folder.
    """
    mode = df.sparkSession.conf.get("profitlens.materialize", "lazy")
    if mode == "checkpoint":
        return cut_lineage(df)
    if mode == "parquet" or durable:
        out = stage(df, "materialized")
        _STAGED.append(out)
        return out
    if mode != "lazy":
        raise ValueError(f"unknown profitlens.materialize mode {mode!r}")
    return df


_STAGED: list[DataFrame] = []


@contextlib.contextmanager
def staged_inside() -> Iterator[list[DataFrame]]:
    """A list that in the end holds what ``materialize`` staged inside, for ``release_materialized``."""
    own, n = [], len(_STAGED)
    yield own
    own.extend(_STAGED[n:])


def release_materialized(staged: list[DataFrame] | None = None) -> int:
    """Delete the folders of every intermediate that ``materialize`` staged so far (of
    those in ``staged`` only, if given); call it once the reports that read them have
    been written. Returns how many."""
    gone = [df for df in _STAGED if staged is None or any(df is s for s in staged)]
    _STAGED[:] = [df for df in _STAGED if not any(df is g for g in gone)]
    for df in gone:
        if df.sparkSession.sparkContext._jsc is not None:  # its session may have been stopped
            drop_staged(df)
    return len(gone)


def drop_staged(df: DataFrame) -> None:
    """Delete the folder of a table that ``stage`` wrote."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
