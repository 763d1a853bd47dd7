"""Header catalogue: the header line of every extract file, read from the files' first bytes only (IO-01/02/03/15).

The paths are listed by Spark (nothing is read for that), a job over the paths opens each file and reads its head, and
the result may be kept as a stored catalogue, so that a later read opens only files that are new or have changed."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD_BYTES = 1 << 14  # first read of a file; doubled until the header line has ended
CATALOGUE = "file string, length long, modified timestamp, encoding string, skip_rows int, header array<string>, head_bytes long"


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, length, modified) of the files of a path, folder, glob or list. The content column is pruned."""
    files = spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths))
    return files.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def first_line(data: bytes, encoding: str, skip_rows: int, whole: bool) -> list[str] | None:
    """The header in the first bytes of a file: its first record after ``skip_rows`` lines that are not blank. None if it
    may go on after them (a file that ends is ``whole``); an empty list if there is none."""
    import csv

    lines = data.decode(encoding, "replace").lstrip("﻿").split("\n")
    if not whole:
        lines = lines[:-1]  # the last one is cut
    lines = [ln.rstrip("\r") for ln in lines if ln.strip()]
    if len(lines) > skip_rows:
        return next(csv.reader([lines[skip_rows]]))
    return [] if whole else None


def _heads(encoding: str, skip_rows: int, head_bytes: int):
    def run(batches):
        from pyarrow import fs

        def read(file: str):
            if "://" not in file:  # file:/folder/name
                system, path = fs.LocalFileSystem(), file.removeprefix("file:")
            else:
                system, path = fs.FileSystem.from_uri(file)
            with system.open_input_file(path) as f:
                data, size = b"", head_bytes
                while True:
                    more = f.read(size)
                    data += more
                    header = first_line(data, encoding, skip_rows, whole=len(more) < size)
                    if header is not None:
                        return header, len(data)
                    size = len(data)

        for batch in batches:
            made = [read(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([h for h, _ in made], pa.list_(pa.string())),
                                              pa.array([n for _, n in made], pa.int64())],
                                             [*batch.schema.names, "header", "head_bytes"])

    return run


def read_heads(files: DataFrame, encoding: str = "UTF-8", skip_rows: int = 0, head_bytes: int = HEAD_BYTES) -> DataFrame:
    """``files`` (see ``list_files``) with the header of each and the bytes that were read for it."""
    schema = "file string, length long, modified timestamp, header array<string>, head_bytes long"
    return files.select("file", "length", "modified").mapInArrow(_heads(encoding, skip_rows, head_bytes), schema)


def catalogue_headers(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8", skip_rows: int = 0,
                      catalogue: str | None = None) -> DataFrame:
    """Header of every file of ``paths``: (file, length, modified, encoding, skip_rows, header, head_bytes).

    With ``catalogue`` (a folder) headers of files that it has with the same length and time are taken from it; only
    the others are opened, and added to it. Without, every head is read."""
    files = list_files(spark, paths)
    own = {"encoding": F.lit(encoding.upper()), "skip_rows": F.lit(skip_rows)}
    columns = [c.split()[0] for c in CATALOGUE.split(", ")]
    if catalogue is None:
        return read_heads(files, encoding, skip_rows).withColumns(own).select(*columns)
    key = ["file", "length", "modified", "encoding", "skip_rows"]
    spark.createDataFrame([], CATALOGUE).write.mode("append").parquet(catalogue)  # there is one
    wanted = files.withColumns(own)
    known = spark.read.schema(CATALOGUE).parquet(catalogue)
    fresh = read_heads(wanted.join(known, key, "left_anti"), encoding, skip_rows).withColumns(own).select(*columns)
    fresh.write.mode("append").parquet(catalogue)
    known = spark.read.schema(CATALOGUE).parquet(catalogue)
    return known.join(wanted.select(*key), key, "left_semi").dropDuplicates(key).select(*columns)


def decode_report(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """For every file its lines and those whose bytes are not valid in the encoding (they would turn into replacement
    characters unseen): file, lines, bad_lines. One pass; GBK needs the legacy charset settings that the reader sets."""
    raw = spark.read.text([paths] if isinstance(paths, str) else list(paths))
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("data"))
    if encoding.upper().replace("-", "") == "UTF8":
        bad = ~F.is_valid_utf8(F.col("data").cast("string"))
    else:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
        spark.conf.set("spark.sql.legacy.codingErrorAction", "true")  # replace, so that the replaced can be counted
        bad = F.decode("data", encoding).contains("�")
    return raw.groupBy("file").agg(F.count("*").alias("lines"), F.count_if(bad).alias("bad_lines"))
