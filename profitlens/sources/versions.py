"""Atomic publishing of a set of reports (IO-10, IO-12, PIPE-18): versioned folders and a manifest swapped last.

Under a root, every publishing writes its tables to a folder of its own, then one manifest file that says which folder
is each table's present one. Readers go by the newest manifest, so they see the whole old set or the whole new one; a
write that dies leaves the old set readable. Manifests are numbered and made by a rename that fails if the number is
taken: of two publishers at once the later one starts from the other's manifest."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS, DATA = "_manifests", "data"


def _context(spark: SparkSession, root: str):
    """(file context of the root's file system, Path class)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        path(root).toUri() if path(root).toUri().getScheme() else path("file://" + root).toUri(),
        spark.sparkContext._jsc.hadoopConfiguration()), path


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fc, path = _context(spark, root)
    folder = path(f"{root}/{MANIFESTS}")
    if not fc.util().exists(folder):
        return []
    names = [s.getPath().getName() for s in fc.util().listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The manifest of a version (the newest, unless given): {"version", "tables": {name: [{"partition", "folder"}]}};
    a part may say more about itself."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    if not numbers and version is None:
        return {"version": 0, "tables": {}}
    n = version if version is not None else numbers[-1]
    lines = spark.read.text(f"{root}/{MANIFESTS}/{n:012d}.json").collect()
    return json.loads("\n".join(r.value for r in lines))


def commit_parts(spark: SparkSession, root: str, made: Mapping[str, list[dict]], replaced: list[dict[str, str]]) -> int:
    """Write the next manifest: the newest one, in which the given tables' parts stand for those of the replaced
    partitions."""
    fc, path = _context(spark, root)
    jvm = spark.sparkContext._jvm
    create = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE)
    no_create_opts = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.CreateOpts, 0)
    no_rename_opts = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    fc.mkdir(path(f"{root}/{MANIFESTS}"), jvm.org.apache.hadoop.fs.permission.FsPermission.getDirDefault(), True)
    while True:
        base = manifest(spark, root)
        tables = {k: [p for p in v if k not in made or p["partition"] not in replaced] for k, v in base["tables"].items()}
        for name, parts in made.items():
            tables[name] = [*tables.get(name, []), *parts]
        n = base["version"] + 1
        tmp = path(f"{root}/{MANIFESTS}/.{uuid.uuid4().hex}.tmp")
        out = fc.create(tmp, create, no_create_opts)
        out.write(bytearray(json.dumps({"version": n, "tables": tables}, sort_keys=True).encode()))
        out.close()
        try:
            fc.rename(tmp, path(f"{root}/{MANIFESTS}/{n:012d}.json"), no_rename_opts)
            return n
        except Exception:
            fc.delete(tmp, False)
            if n not in _numbers(spark, root):  # not because another publisher was first
                raise


def publish_set(reports: Mapping[str, DataFrame], root: str, partition: Mapping[str, str] | None = None) -> int:
    """Publish all ``reports`` at once; returns the version. ``partition`` (e.g. company and period) names the part of
    each report that is replaced: other parts, and reports that are not given, stay as they are."""
    root = root.rstrip("/")
    spark = next(iter(reports.values())).sparkSession
    made, part = {}, dict(partition or {})
    for name, df in reports.items():
        folder = f"{DATA}/{uuid.uuid4().hex}/{name}"
        df.write.parquet(f"{root}/{folder}")
        made[name] = [{"partition": part, "folder": folder}]
    return commit_parts(spark, root, made, [part])


def publish_parts(tables: Mapping[str, DataFrame], root: str, column: str, values: Sequence) -> int:
    """Publish, at once, the parts of all ``tables`` that ``values`` of ``column`` name; returns the version. Each table is
    written by one job, its rows brought together by part (large parts split), so files are few. A part without rows is
    empty from now on, parts of other values stay as they are."""
    root = root.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    fc, path = _context(spark, root)
    made = {}
    for name, df in tables.items():
        folder = f"{DATA}/{uuid.uuid4().hex}/{name}"
        df.hint("rebalance", column).write.partitionBy(column).parquet(f"{root}/{folder}")
        parts = [(v, f"{folder}/{column}={v}") for v in values]
        made[name] = [{"partition": {column: str(v)}, "folder": f} for v, f in parts if fc.util().exists(path(f"{root}/{f}"))]
    return commit_parts(spark, root, made, [{column: str(v)} for v in values])


def read_parts(spark: SparkSession, root: str, name: str, column: str, values: Sequence | None = None) -> DataFrame | None:
    """The published parts of some values (all unless given) in one scan, without ``column``; None if there are none."""
    root = root.rstrip("/")
    wanted = None if values is None else {str(v) for v in values}
    folders = [f"{root}/{p['folder']}" for p in manifest(spark, root)["tables"].get(name, [])
               if wanted is None or p["partition"][column] in wanted]
    return spark.read.parquet(*folders) if folders else None


def read_published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A published report as of the newest version (or an older one that is still there). Its parts are put together by
    name with their partition values as columns; a filter on those reads only the parts it needs."""
    root = root.rstrip("/")
    parts = manifest(spark, root, version)["tables"].get(name)
    if not parts:
        raise ValueError(f"{name!r} is not published in {root}")
    out = None
    for p in parts:
        df = spark.read.parquet(f"{root}/{p['folder']}").withColumns({k: F.lit(v) for k, v in p["partition"].items()})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete manifests but the newest ``keep``, and every data folder that none of those names (left by older versions
    or by writes that died; run it while nothing is being published). Returns how many folders went."""
    root = root.rstrip("/")
    fc, path = _context(spark, root)
    numbers = _numbers(spark, root)
    kept = {p["folder"].split("/")[1] for n in numbers[-keep:] for t in manifest(spark, root, n)["tables"].values() for p in t}
    gone = 0
    for s in fc.util().listStatus(path(f"{root}/{DATA}")):
        if s.getPath().getName() not in kept:
            fc.delete(s.getPath(), True)
            gone += 1
    for n in numbers[:-keep]:
        fc.delete(path(f"{root}/{MANIFESTS}/{n:012d}.json"), False)
    return gone
