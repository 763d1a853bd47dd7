"""Byte-level BPE encoding and decoding with a local rank file."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.llm._common import small_batches

# Positions at which a match of the pre-splitting pattern always ends, whatever follows: before white space that
# follows a letter, digit, mark or sign, and where a run of letters or of digits ends. A cut there changes no match.
SAFE_CUT = (r"(?<=[\p{L}\p{N}\p{P}\p{S}])(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])")
CHUNK_CHARS = 1 << 16
MAX_RANK_BYTES = 64 << 20


def pieces(text: str, cut, size: int = CHUNK_CHARS) -> Iterator[str]:
    """Consecutive parts of text of about ``size`` characters, cut at safe boundaries only. A part
    is longer where no safe boundary comes (one endless word)."""
    start = 0
    while len(text) - start > size:
        found = cut.search(text, start + size)
        if not found or found.start() == len(text):
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:] if start else text


def encoding(ranks: bytes, pattern: str):
    """The tiktoken encoding of a rank file's bytes, without special tokens."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def values(column: pa.Array, rows: int = 32):
    """The Python values of a column, of which few are held at once."""
    for i in range(0, len(column), rows):
        yield from column.slice(i, rows).to_pylist()


def _rank_file(spark, path: str):
    with open(path, "rb") as f:
        data = f.read(MAX_RANK_BYTES + 1)
    if len(data) > MAX_RANK_BYTES:
        raise ValueError(f"rank file larger than {MAX_RANK_BYTES} bytes")
    return spark.sparkContext.broadcast(data)


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*[f for f in df.schema.fields if f.name.lower() != name.lower()], T.StructField(name, kind)])


def _map_column(df: DataFrame, source: str, name: str, kind: T.DataType, make) -> DataFrame:
    """df with the column ``name`` made from ``source`` by ``make() -> (arrow column -> arrow array)``, a batch at a
    time. A column called ``name`` (in any case) that df already had is replaced."""
    keep = [f.name for f in df.schema.fields if f.name.lower() != name.lower()]

    def run(batches):
        convert = None
        for batch in batches:
            convert = convert or make()
            made = convert(batch.column(source))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], made], [*keep, name])

    return df.mapInArrow(run, _schema(df, name, kind))


def bpe_encode(df: DataFrame, text_col: str, rank_path: str, pattern: str, out: str = "token_ids") -> DataFrame:
    """df with ``out`` (array<int>): the ids of each whole text, as the tiktoken library gives them.

    The rank file is read once on the driver (at most 64 MB) and broadcast. Every match of ``pattern`` is encoded on
    its own, no special tokens. Texts beyond 65,536 characters are fed in pieces cut where a match ends in any case,
    so the ids are those of the whole text and the library's work stays bounded.
    Null or empty text: an empty array. Repeated rows stay repeated; an empty table gives no rows. Other columns pass;
    a column named like ``out`` is replaced. df's column names must differ beyond case (as Spark itself asks).
    """
    spark = df.sparkSession
    small_batches(spark)
    ranks = _rank_file(spark, rank_path)

    def make():
        import numpy as np
        import regex

        enc, cut = encoding(ranks.value, pattern), regex.compile(SAFE_CUT)
        none = np.empty(0, np.int32)

        def encode(text):
            if not text:
                return none
            if len(text) <= CHUNK_CHARS:
                return enc.encode_to_numpy(text)
            return np.concatenate([enc.encode_to_numpy(p) for p in pieces(text, cut)])

        def convert(column):
            ids = [encode(t) for t in values(column)]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate([none, *ids]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

        return convert

    return _map_column(df, text_col, out, T.ArrayType(T.IntegerType()), make)


def bpe_decode(df: DataFrame, ids_col: str, rank_path: str, pattern: str, out: str = "decoded") -> DataFrame:
    """df with ``out`` (binary): the raw bytes of the ids; no bytes are replaced, so ids that cut a
    character decode to the bytes they stand for.

    Null or empty ids: empty binary. A null id within an array stands for nothing; an id that the rank file lacks
    fails the job, as it does in the library. Other columns pass; a column named like ``out`` is replaced.
    """
    spark = df.sparkSession
    small_batches(spark)
    ranks = _rank_file(spark, rank_path)

    def make():
        enc = encoding(ranks.value, pattern)

        def convert(column):
            return pa.array([enc.decode_bytes([i for i in ids if i is not None]) if ids else b""
                             for ids in values(column)], pa.binary())

        return convert

    return _map_column(df, ids_col, out, T.BinaryType(), make)


def digests(df: DataFrame, ids_col: str = "token_ids", decoded_col: str = "decoded", keep: tuple = ()) -> DataFrame:
    """doc_id with n_tokens and the SHA-256 of the ids (decimal, joined by commas) and of the decoded bytes."""
    return df.select(
        "doc_id", *keep,
        F.size(ids_col).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids_col).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(decoded_col, 256).alias("decoded_sha256"),
    )
