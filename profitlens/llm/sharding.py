"""Sharding by a k-d tree over document metadata, split at distributed weighted medians."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from profitlens.llm._common import join_on, staged

BINS = 1024           # bins of one histogram step
TOLERANCE = 1 / 4096  # a split is fixed once its bin holds at most this share of the node's bytes
MAX_SHARDS = 1 << 16  # the tree (a few numbers for each shard) is held by the driver
SLICES = 1024         # a shard's slots are numbered in so many slices
TIE = 1 << 32
SALTS = 16


@dataclass(frozen=True)
class Node:
    """A part of the tree that ``shards`` shards from number ``first`` on will share."""
    first: int
    shards: int
    dim: int = 0
    low: int = 0        # the split lies in keys low .. high
    high: int = 0
    below: int = 0      # bytes of keys under low
    total: int = 0
    cut: int | None = None  # keys under it go left


def with_rank(rows: DataFrame, name: str) -> DataFrame:
    """The string column replaced by its rank (a double from 0) among its different values, null the first of them.

    The values are sorted by range partitions and numbered within them. Ranks come back by a join on the value and a
    SALTS-fold salt of ``tie``, so a value of a third of the rows is no hot spot."""
    seen = rows.select(name).distinct().repartitionByRange(name).sortWithinPartitions(name)
    seen = staged(seen.withColumn("id", F.monotonically_increasing_id()), "shard-values")
    seen = seen.withColumn("part", F.shiftright("id", 33)).withColumn("at", F.col("id") - F.shiftleft("part", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = seen.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    ranks = seen.join(starts, "part").select(
        name, (F.col("start") + F.col("at")).cast("double").alias("rank"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")).alias("salt"))
    found = join_on(rows.withColumn("salt", F.col("tie") % SALTS), ranks, [name, "salt"])
    return found.drop(name, "salt").withColumnRenamed("rank", name)


def _table(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A small table of whole numbers, at most MAX_SHARDS rows."""
    values = ",".join("(" + ",".join(f"{v}L" for v in r) + ")" for r in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {values} AS t({names})"))


def _place(value: Column, low: float, high: float, tie: Column) -> Column:
    """A long that orders rows by value, rows of one value by the tie hash."""
    scaled = F.lit(0.0) if high <= low else (value - low) / (high - low)
    return (F.floor(scaled * (2**30 - 1)).cast("long") * TIE + tie)


def _key(dims: int) -> Column:
    return F.element_at(F.array(*[F.col(f"k{i}") for i in range(dims)]), (F.col("dim") + 1).cast("int"))


def _search(rows: DataFrame, nodes: list[Node], dims: int) -> list[Node]:
    """One histogram step for every node whose cut is open: narrow low .. high to the bin in which the wanted share of
    the node's bytes is reached. The result is one row for each node."""
    steps = {n.first: max(1, -(-(n.high - n.low + 1) // BINS)) for n in nodes}
    table = _table(rows.sparkSession, [(n.first, n.dim, n.low, n.high, steps[n.first], n.below, _goal(n))
                                       for n in nodes], "node, dim, low, high, step, below, goal")
    key = _key(dims)
    bins = (rows.join(table, "node").where((key >= F.col("low")) & (key <= F.col("high")))
            .withColumn("at", key).withColumn("bin", F.expr("(at - low) div step"))
            .groupBy("node", "below", "goal", "bin").agg(F.sum("size").alias("n")))
    run = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # BINS rows a node
    hit = (bins.withColumn("upto", F.col("below") + F.sum("n").over(run)).where(F.col("upto") >= F.col("goal"))
           .groupBy("node").agg(F.min(F.struct("bin", "upto", "n")).alias("h")).select("node", "h.*"))
    found = {r.node: r for r in hit.collect()}
    out = []
    for n in nodes:
        r, step = found[n.first], steps[n.first]
        low = n.low + r.bin * step
        high = min(n.high, low + step - 1)
        below = r.upto - r.n
        if high == low or r.n <= TOLERANCE * n.total:
            near = low if _goal(n) - below <= r.upto - _goal(n) else high + 1
            out.append(replace(n, low=low, high=high, below=below, cut=near))
        else:
            out.append(replace(n, low=low, high=high, below=below))
    return out


def _goal(n: Node) -> int:
    return max(1, n.total * (n.shards // 2) // n.shards)


def kd_shards(rows: DataFrame, dims: list[str], target_bytes: int | None = None, shards: int | None = None) -> DataFrame:
    """rows: ``size`` (bytes), ``tie`` (a number under 2^32 that spreads rows of equal metadata), the metadata columns
    ``dims`` as doubles, any others. Adds ``shard`` from 0.

    The tree has as many leaves as ``target_bytes`` asks for (or ``shards``). A node is split along the dimension that is
    widest in it (after scaling each to 0..1 over all rows) at the weighted median, so that the halves' bytes are as its
    leaves (one more on the right if odd). Medians are found for all nodes of a level at once by histograms over ever
    smaller ranges; rows of one value are split by the tie hash, so a value that holds a third of the rows is no limit.
    Only the tree (at most MAX_SHARDS leaves) comes to the driver. Null dimensions must have been replaced. Empty
    table: no rows."""
    spark = rows.sparkSession
    span = rows.agg(F.sum("size").alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in dims for f in (F.min, F.max)]
                    ).first()
    total = span["n"] or 0
    shards = shards or max(1, -(-total // target_bytes))
    if shards > MAX_SHARDS:
        raise ValueError(f"more than {MAX_SHARDS} shards")
    keys = [_place(F.col(c), span[f"min_{c}"] or 0.0, span[f"max_{c}"] or 0.0, F.col("tie")).alias(f"k{i}")
            for i, c in enumerate(dims)]
    others = [c for c in rows.columns if c not in dims]
    cur = staged(rows.select(*others, *keys, F.lit(0).cast("long").alias("node")), "shard-level")
    level = [Node(0, shards)]
    while any(n.shards > 1 for n in level):
        stats = {r.node: r for r in cur.groupBy("node").agg(
            F.sum("size").alias("n"), *[f(f"k{i}").alias(f"{f.__name__}{i}") for i in range(len(dims))
                                        for f in (F.min, F.max)]).collect()}
        done: list[Node] = []
        work: list[Node] = []
        for n in level:
            r = stats.get(n.first)
            if n.shards < 2:
                done.append(n)
            elif r is None:  # no rows: empty shards
                continue
            else:
                d = max(range(len(dims)), key=lambda i: (r[f"max{i}"] - r[f"min{i}"], -i))
                work.append(replace(n, dim=d, low=r[f"min{d}"], high=r[f"max{d}"], below=0, total=r.n))
        if not work:
            break
        while any(n.cut is None for n in work):
            found = {n.first: n for n in _search(cur, [n for n in work if n.cut is None], len(dims))}
            work = [found.get(n.first, n) for n in work]
        cuts = _table(spark, [(n.first, n.dim, n.cut, n.first + n.shards // 2) for n in work],
                      "node, dim, cut, right")
        moved = (cur.join(cuts, "node", "left")
                 .withColumn("node", F.when(_key(len(dims)) >= F.col("cut"), F.col("right")).otherwise(F.col("node"))))
        cur = staged(moved.drop("dim", "cut", "right"), "shard-level")
        level = done + [half for n in work for half in (
            Node(n.first, n.shards // 2), Node(n.first + n.shards // 2, n.shards - n.shards // 2))]
    return cur.drop(*[f"k{i}" for i in range(len(dims))]).withColumn("shard", F.col("node").cast("int")).drop("node")


def with_slots(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``slot``: gapless numbers from 0 within each shard, in the order of the slices of ``tie``, then of ``order``.
    Slices are counted first, so that only the rows of one slice are numbered in one task."""
    rows = rows.withColumn("__s", F.col("tie") % SLICES)
    before = Window.partitionBy("shard").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)  # SLICES rows
    sizes = (rows.groupBy("shard", "__s").agg(F.count("*").alias("__n"))
             .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    own = Window.partitionBy("shard", "__s").orderBy("tie", *order)
    return (rows.withColumn("__i", F.row_number().over(own)).join(sizes, ["shard", "__s"])
            .withColumn("slot", (F.col("__before") + F.col("__i") - 1).cast("long"))
            .drop("__s", "__i", "__before"))


def numbered_ties(rows: DataFrame) -> DataFrame:
    """Adds ``tie`` to rows with ``same`` (equal for equal rows), ``part`` and ``at`` (the partition and place that each row was
    written at) and drops these: the hash of the row, and for its second, third, ... copy a hash of that number as well,
    so that copies can be parted. Copies are numbered within each part and the parts' counts are added up: no task
    gets more of them than a part has."""
    counts = rows.groupBy("same", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("same").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    ahead = counts.select("same", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    own = Window.partitionBy("same", "part").orderBy("at")
    copy = F.col("ahead") + F.row_number().over(own) - 1
    tie = F.when(copy == 0, F.col("same")).otherwise(F.xxhash64("same", copy)).bitwiseAND(F.lit(TIE - 1))
    return rows.join(ahead, ["same", "part"]).withColumn("tie", tie).drop("same", "part", "at", "ahead")


def shard_documents(documents: DataFrame, shards: int = 16, target_bytes: int | None = None) -> DataFrame:
    """Law ``bytes``: every document in one of the shards of nearly equal bytes, with its slot.

    size is the UTF-8 bytes of the text plus 1 (null: none), the metadata dimensions are the ranks of lang and source
    among their values (null has its own) and the logarithm of size. A null text counts as empty; repeated rows each get a slot of their own; extra columns
    are not read. Empty table: no rows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    crc = F.crc32(text.cast("binary")).cast("long")
    rows = staged(documents.select("doc_id", size.alias("size"), crc.alias("text_crc32"),
                                   F.xxhash64(F.col("doc_id"), crc, size).alias("same"),
                                   F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
                                   F.col("lang").cast("string").alias("lang"),
                                   F.col("source").cast("string").alias("source"),
                                   F.log2(size).alias("length")), "shard-rows")
    rows = numbered_ties(rows)
    rows = staged(with_rank(with_rank(rows, "lang"), "source"), "shard-places")
    if target_bytes:
        shards = None
    placed = kd_shards(rows, ["source", "lang", "length"], target_bytes, shards)
    return with_slots(placed, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
