"""Approximate nearest neighbours: an NN-descent graph built by Spark joins, searched greedily."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitlens.llm._common import staged

NEIGHBOURS = 40   # out-neighbours of a node
REVERSE = 24      # in-neighbours that take part in a step, one for each slot of a hash
SLOTS = 64        # candidates of a node that enter its list in a step, one for each slot of a hash
OFFERS = 8        # candidates that a node gets from one common neighbour, the most similar ones
ORDERS = 24       # random orders in which the first lists are made
BITS = 8          # random hyperplanes of such an order
RUN = 512         # nodes next to each other in an order that are compared
FIRST = 12        # neighbours that a node takes from each order
STEPS = 8         # joins of neighbours of neighbours, at most
SETTLED = 0.03    # the descent ends when a smaller share of the links is new
FOLLOW = 32       # best out-neighbours that the search follows,
FOLLOW_BACK = 8   # and in-neighbours
BEAM = 96         # nodes that a query keeps
ENTRIES = 4       # nodes of each octave of the length that every search starts from, beside its own
EXPAND = 32       # of them, nodes that are followed at once
SEED = 17


def usable(vec: Column) -> Column:
    """Not null, not zero, all components finite numbers."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vec, fine) & F.exists(vec, lambda x: x != 0), F.lit(False))


def distinct_vectors(df: DataFrame, id_col: str, vec_col: str, keep: int) -> DataFrame:
    """node, vec, members for every different usable vector: node is its smallest id, members its ``keep`` smallest ids.

    An id with several vectors takes part with the smallest of them; vectors of another length than the most frequent
    one take none. Ids of one vector are cut to ``keep`` in 64 salted parts first, so that a vector that a third of the
    rows share is no burden; the others come back in full wherever all ids of a vector are needed."""
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
            .where(F.col("id").isNotNull() & usable(F.col("vec"))))
    rows = rows.groupBy("id").agg(F.min("vec").alias("vec"))
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.where(F.size("vec") == (length.n if length else 0))
    cut = lambda ids: F.slice(F.array_sort(ids), 1, keep)
    part = rows.groupBy("vec", F.pmod(F.xxhash64("id"), F.lit(64)).alias("salt")).agg(
        cut(F.collect_list("id")).alias("ids"))
    return part.groupBy("vec").agg(cut(F.flatten(F.collect_list("ids"))).alias("members")).select(
        F.element_at("members", 1).alias("node"), "vec", "members")


def _points(nodes: DataFrame) -> DataFrame:
    """node and x, the vector as its direction in half precision, its length, and by how much the component that
    makes all lengths equal falls short of 1 (single precision, in units of the greatest length; the shortfall keeps its
    precision where the component itself would be rounded to 1): near points of that sphere have large inner products, so
    a graph of nearest points serves a search by inner product."""
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    top = nodes.agg(F.max(norm)).first()[0] or 1.0

    def run(batches):
        import numpy as np

        for batch in batches:
            v = batch.column(1)
            if not len(v):
                continue
            a = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)
            length = np.sqrt((a * a).sum(1) / top)
            rest = np.sqrt(np.maximum(1 - length * length, 0))
            flat = (a / np.maximum(length * np.sqrt(top), 1e-300)[:, None]).astype(np.float16)
            ends = np.stack([length, length * length / (1 + rest)], 1).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([e.tobytes() + f.tobytes() for e, f in zip(ends, flat)], pa.binary())],
                ["node", "x"])

    return nodes.select("node", "vec").mapInArrow(run, "node long, x binary")


def _read(column):
    """Vectors and the shortfalls of the components that complete their lengths, from a column of points."""
    import numpy as np

    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    ends = np.ascontiguousarray(raw[:, :8]).view(np.float32)
    return np.ascontiguousarray(raw[:, 8:]).view(np.float16).astype(np.float32) * ends[:, :1], ends[:, 1]


def _sims(points):
    """Similarities of all pairs of a few points: minus the squared distance, which short vectors beside a very long one
    still have digits for."""
    vec, short = points
    square = (vec * vec).sum(1)
    return -(square[:, None] + square[None, :] - 2 * (vec @ vec.T) + (short[:, None] - short[None, :]) ** 2)


EDGE = "struct<sim: float, nbr: long, new: boolean>"


def _merge(rows: DataFrame, k: int) -> DataFrame:
    """rows: node, x, old and found (arrays of EDGE). The k most similar neighbours of each node, once each, as ``l``
    (best first); a neighbour that the old list has stays as it was. A node's arrays are short (its list and one edge for
    each slot), whole batches are merged at once."""
    kind = pa.struct([("sim", pa.float32()), ("nbr", pa.int64()), ("new", pa.bool_())])

    def run(batches):
        import numpy as np

        for batch in batches:
            parts = []
            for age, column in ((0, batch.column(2)), (1, batch.column(3))):
                flat = column.flatten()
                row = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                parts.append((row, flat.field(1).to_numpy(zero_copy_only=False), np.full(len(flat), age),
                              flat.field(0).to_numpy(zero_copy_only=False), flat.field(2).to_numpy(zero_copy_only=False)))
            row, nbr, age, sim, new = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((-sim, age, nbr, row))
            row, nbr, sim, new = row[order], nbr[order], sim[order], new[order].astype(bool)
            first = np.ones(len(row), bool)
            first[1:] = (row[1:] != row[:-1]) | (nbr[1:] != nbr[:-1])
            row, nbr, sim, new = row[first], nbr[first], sim[first], new[first]
            order = np.lexsort((nbr, -sim, row))
            row, nbr, sim, new = row[order], nbr[order], sim[order], new[order]
            start = np.searchsorted(row, np.arange(batch.num_rows))
            keep = np.arange(len(row)) - start[row] < k
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=batch.num_rows))]).astype(np.int32)
            edges = pa.StructArray.from_arrays([pa.array(sim[keep], pa.float32()), pa.array(nbr[keep], pa.int64()),
                                                pa.array(new[keep])], fields=list(kind))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends), edges)], ["node", "x", "l"])

    return rows.select("node", "x", "old", "found").mapInArrow(run, f"node long, x binary, l array<{EDGE}>")


def _edges(graph: DataFrame) -> DataFrame:
    return graph.select("node", F.explode("l").alias("e")).select("node", "e.sim", "e.nbr", "e.new")


def _back(edges: DataFrame, turn: int, slots: int) -> DataFrame:
    """Edges in the other direction, of each node the most similar one for each slot of a hash of the neighbour, another
    hash in each turn: pre-aggregated, so a node that is everyone's neighbour is no hot spot."""
    back = edges.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "sim", "new")
    slot = F.pmod(F.xxhash64("nbr", F.lit(turn)), F.lit(slots)).alias("slot")
    return (back.groupBy("node", slot).agg(F.max(F.struct("sim", "nbr", "new")).alias("e"))
            .select("node", "e.sim", "e.nbr", "e.new"))


def _update(graph: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The graph with the candidates (node, slot, nbr, sim), of each node the most similar one for each slot."""
    best = (found.repartition("node").groupBy("node", "slot").agg(F.max(F.struct("sim", "nbr")).alias("e"))
            .groupBy("node").agg(F.collect_list(F.struct("e.sim", "e.nbr", F.lit(True).alias("new"))).alias("found")))
    old = F.transform("l", lambda e: F.struct(e["sim"].alias("sim"), e["nbr"].alias("nbr"), F.lit(False).alias("new")))
    both = graph.join(best, "node", "left").select(
        "node", "x", old.alias("old"), F.coalesce("found", F.array().cast(f"array<{EDGE}>")).alias("found"))
    return _merge(both, k)


def _first_lists(points: DataFrame, k: int) -> DataFrame:
    """Neighbours among the RUN nodes that come next to each other in each of ORDERS random orders (by the signs of random
    projections of the directions, then by one projection; in every second order by the octave of the length first). The orders are range-partitioned, no bucket is larger than RUN."""

    def order(batches):
        import numpy as np

        planes = None
        for batch in batches:
            if not batch.num_rows:
                continue
            vec, _ = _read(batch.column(1))
            length = np.maximum(np.sqrt((vec.astype(np.float64) ** 2).sum(1)), 1e-300)
            x, octave = (vec / length[:, None]).astype(np.float32), np.floor(-np.log2(length)).clip(0, 2000).astype(np.int64)
            if planes is None:
                planes = np.random.default_rng(SEED).standard_normal((ORDERS, BITS + 1, x.shape[1])).astype(np.float32)
            for t in range(ORDERS):
                p = x @ planes[t].T
                code = ((p[:, :BITS] > 0) << np.arange(BITS)).sum(1) + (octave << BITS) * (t % 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(code.astype(np.int32)),
                     pa.array(p[:, BITS]), *batch.columns], ["t", "code", "p", "node", "x"])

    def compare(batches):
        import numpy as np

        for batch in batches:
            t = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(t[1:] != t[:-1]) + 1, [len(t)]])
            for i, j in ((i, min(i + RUN, b)) for a, b in zip(cuts[:-1], cuts[1:]) for i in range(a, b, RUN)):
                part = batch.slice(i, j - i)
                ids = part.column(3).to_numpy()
                if len(ids) < 2:
                    continue
                sims = _sims(_read(part.column(4)))
                np.fill_diagonal(sims, -np.inf)
                m = min(FIRST, len(ids) - 1)
                near = np.argpartition(-sims, m - 1, axis=1)[:, :m]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, m)), pa.array(ids[near].ravel()),
                     pa.array(np.take_along_axis(sims, near, 1).ravel())], ["node", "nbr", "sim"])

    rows = points.mapInArrow(order, "t int, code int, p float, node long, x binary")
    # partitions of several runs each, so that a run is seldom cut short by the end of one
    parts = points.count() * ORDERS // (8 * RUN) + 1
    parts = min(parts, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartitionByRange(parts, "t", "code", "p").sortWithinPartitions("t", "code", "p")
    found = rows.mapInArrow(compare, "node long, nbr long, sim float").where("node != nbr")
    lists = found.groupBy("node").agg(  # FIRST from each order
        F.collect_list(F.struct("sim", "nbr", F.lit(True).alias("new"))).alias("found"))
    none = F.array().cast(f"array<{EDGE}>")
    return _merge(points.join(lists, "node", "left").select("node", "x", none.alias("old"),
                                                            F.coalesce("found", none).alias("found")), k)


def _neighbours_of_neighbours(graph: DataFrame, k: int, turn: int) -> DataFrame:
    """Candidates (node, slot, nbr, sim) from one join: nodes that are neighbours, in either direction, of a common node
    are compared if one of the two links is new, and the best OFFERS pairs are candidates where they beat a node's worst
    neighbour."""
    edges = _edges(graph)
    around = edges.unionByName(_back(edges, turn, REVERSE)).select(F.col("node").alias("via"), "nbr", "new")
    info = graph.select(F.col("node").alias("nbr"), "x", F.when(
        F.size("l") >= k, F.element_at("l", -1)["sim"]).otherwise(F.lit(-16.0).cast("float")).alias("worst"))
    # every node meets its at most k + REVERSE neighbours
    met = around.join(info, "nbr").select("via", "nbr", "new", "x", "worst")
    met = met.repartition("via").sortWithinPartitions("via")

    def run(batches):
        import numpy as np

        def group(ids, new, worst, points, out):
            sims = _sims(points)
            pairs = (new[:, None] | new[None, :]) & (sims > worst[:, None]) & (ids[:, None] != ids[None, :])
            sims[~pairs] = -np.inf
            if len(ids) > OFFERS:
                j = np.argpartition(-sims, OFFERS - 1, axis=1)[:, :OFFERS].ravel()
                i = np.repeat(np.arange(len(ids)), OFFERS)
            else:
                i, j = np.nonzero(pairs)
            s = sims[i, j]
            fine = s > -np.inf
            out.append((ids[i[fine]], ids[j[fine]], s[fine]))

        def best(out):
            # what a task finds for a node is cut to its slots here already
            a, b, s = (np.concatenate(c) for c in zip(*out))
            out.clear()
            slot = (b.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * turn) >> np.uint64(32)) % np.uint64(SLOTS)
            order = np.lexsort((-s, slot, a))
            a, b, s, slot = a[order], b[order], s[order], slot[order].astype(np.int32)
            first = np.ones(len(a), bool)
            first[1:] = (a[1:] != a[:-1]) | (slot[1:] != slot[:-1])
            return pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(slot[first]), pa.array(b[first]),
                                               pa.array(s[first])], ["node", "slot", "nbr", "sim"])

        held, out = None, []
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            via = batch.column(0).to_numpy()
            if not len(via):
                continue
            cuts = np.concatenate([[0], np.flatnonzero(via[1:] != via[:-1]) + 1])
            ids, new = batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            worst, (vec, rest) = batch.column(4).to_numpy(), _read(batch.column(3))
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b - a > 1 and new[a:b].any():
                    group(ids[a:b], new[a:b], worst[a:b], (vec[a:b], rest[a:b]), out)
            held = batch.slice(cuts[-1])  # the last node's neighbours may go on
            if sum(len(o[0]) for o in out) > 1_000_000:
                yield best(out)
        if held is not None and held.num_rows > 1:
            group(held.column(1).to_numpy(), held.column(2).to_numpy(zero_copy_only=False),
                  held.column(4).to_numpy(), _read(held.column(3)), out)
        if out:
            yield best(out)

    return met.mapInArrow(run, "node long, slot int, nbr long, sim float")


def neighbour_graph(points: DataFrame, k: int = NEIGHBOURS, steps: int = STEPS) -> DataFrame:
    """(node, x, l): about the k nearest neighbours of each point, by NN-descent. Each step is written to the shared
    folder; the descent ends when few links are new."""
    graph = staged(_first_lists(points, k), "nn-graph")
    for turn in range(steps):
        graph = staged(_update(graph, _neighbours_of_neighbours(graph, k, turn), k), "nn-graph")
        fresh = graph.agg(F.sum(F.size(F.filter("l", lambda e: e["new"]))), F.sum(F.size("l"))).first()
        if (fresh[0] or 0) <= SETTLED * (fresh[1] or 0):
            break
    return graph


def entry_points(nodes: DataFrame, points: DataFrame) -> DataFrame:
    """One row with ``entries``, an array of (node, x): up to ENTRIES long vectors of each octave of the length."""
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    octave, slot = F.floor(F.log2("norm") / 2), F.pmod(F.xxhash64("node"), F.lit(ENTRIES))
    some = (nodes.select("node", norm.alias("norm")).groupBy(octave.alias("octave"), slot.alias("slot"))
            .agg(F.max(F.struct("norm", "node")).alias("e")).select("e.node"))
    return points.join(some, "node").agg(F.collect_list(F.struct("node", "x")).alias("entries"))


def greedy_search(graph: DataFrame, queries: DataFrame, beam: int = BEAM, entries: DataFrame | None = None) -> DataFrame:
    """(q, l): the nodes (sim, node, done) that a greedy search finds nearest to each query, best first. queries: q, a
    node of the graph, from which its search starts; ``entries`` (see entry_points): further nodes that all start from.

    A query keeps its ``beam`` best nodes; in each round the best EXPAND of them that were not followed yet are, and the
    neighbours (in both directions) they lead to are compared with the query. The search of all queries runs in common
    joins and ends when no query has a node left to follow."""
    edges = _edges(graph.withColumn("l", F.slice("l", 1, FOLLOW)))
    links = staged(edges.select("node", "nbr").unionByName(_back(edges, -1, FOLLOW_BACK).select("node", "nbr"))
                   .groupBy("node").agg(F.collect_set("nbr").alias("nbrs")), "nn-links")
    points = graph.select("node", "x")
    item = "struct<sim: float, node: long, done: boolean>"

    def run(batches):
        import numpy as np

        for batch in batches:
            lists = []
            for row in batch.select(["xq", "l", "seen"]).to_pylist():
                best = {e["node"]: (e["sim"], e["done"]) for e in row["l"]}
                new = {e["node"]: e["x"] for e in row["seen"] or () if e["node"] not in best}
                if new:
                    query = _read(pa.array([row["xq"]]))[0][0]
                    sims = _read(pa.array(list(new.values())))[0] @ query
                    best.update((n, (float(np.float32(v)), False)) for n, v in zip(new, sims))
                order = sorted(best.items(), key=lambda e: (-e[1][0], e[0]))[:beam]
                todo = [n for n, (_, done) in order if not done][:EXPAND]
                now = set(todo)
                lists.append(([{"sim": v, "node": n, "done": done or n in now} for n, (v, done) in order], todo))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([a for a, _ in lists], pa.list_(pa.struct([("sim", pa.float32()), ("node", pa.int64()),
                                                                     ("done", pa.bool_())]))),
                 pa.array([b for _, b in lists], pa.list_(pa.int64()))], ["q", "xq", "l", "todo"])

    def step(state: DataFrame) -> DataFrame:
        """state: q, xq, l and seen (node, x) -> q, xq, l with the nodes to follow marked as done, and those as todo."""
        return staged(state.select("q", "xq", "l", "seen").mapInArrow(
            run, f"q long, xq binary, l array<{item}>, todo array<long>"), "nn-beam")

    own = points.join(queries.select(F.col("q").alias("node")).distinct(), "node", "left_semi")
    first = F.array(F.struct("node", "x"))
    if entries is not None:
        own, first = own.crossJoin(F.broadcast(entries)), F.concat(first, "entries")
    state = step(own.select(F.col("node").alias("q"), F.col("x").alias("xq"), F.array().cast(f"array<{item}>").alias("l"),
                            first.alias("seen")))
    while not state.where(F.size("todo") > 0).isEmpty():
        front = state.select("q", F.explode("todo").alias("node"))
        pairs = front.join(links, "node").select("q", F.explode("nbrs").alias("node"))
        # dealt out by node once, for the removal of repeats and for the join
        pairs = pairs.repartition("node").dropDuplicates(["node", "q"]).join(points, "node")
        seen = pairs.groupBy("q").agg(F.collect_list(F.struct("node", "x")).alias("seen"))  # of EXPAND nodes
        state = step(state.join(seen, "q", "left"))
    return state.select("q", "l")


def nearest(df: DataFrame, query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows with the largest inner product found for each row of df that
    meets the condition ``query``, nearest first, ties to the smaller id. score is the inner product of the given
    vectors in double precision.

    Vectors that are null, zero, or hold null or non-finite components take no part, neither do rows without an id.
    Different vectors form the graph; the rows of one vector share its place and its search, and rows come back by id,
    so any number of equal vectors costs no more. A query that shares its id with another row counts once. Fewer than k
    other rows: all that are found. Empty table: no rows. Other columns are not read."""
    nodes = staged(distinct_vectors(df, id_col, vec_col, k + 1), "nn-nodes")
    points = staged(_points(nodes), "nn-points")
    asked = (df.where(F.coalesce(query, F.lit(False)) & F.col(id_col).isNotNull() & usable(F.col(vec_col)))
             .groupBy(F.col(id_col).cast("long").alias("query_id"))
             .agg(F.min(F.col(vec_col).cast("array<double>")).alias("vec")))
    asked = staged(asked.join(nodes.select("node", "vec"), "vec").select("query_id", F.col("node").alias("q")), "nn-asked")
    graph = neighbour_graph(points)
    found = greedy_search(graph, asked.select("q").distinct(), entries=entry_points(nodes, points))
    pairs = found.select("q", F.explode("l.node").alias("node")).join(nodes, "node").join(
        nodes.select(F.col("node").alias("q"), F.col("vec").alias("qvec")), "q")

    def run(batches):
        import numpy as np

        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            a, b = (batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for i in (2, 3))
            score = np.fromiter((np.dot(x, y) for x, y in zip(a, b)), np.float64, n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["q", "members", "score"])

    scored = pairs.select("q", "members", "vec", "qvec").mapInArrow(run, "q long, members array<long>, score double")
    # a vector's best k + 1 rows hold the best k of each row that has it, without the row itself
    order = lambda a, b: F.when(a["s"] > b["s"], -1).when(a["s"] < b["s"], 1).when(a["id"] < b["id"], -1).when(
        a["id"] > b["id"], 1).otherwise(0)
    rows = (scored.groupBy("q").agg(F.flatten(F.collect_list(F.transform(
        "members", lambda m: F.struct(F.col("score").alias("s"), m.alias("id"))))).alias("r"))
        .select("q", F.slice(F.array_sort("r", order), 1, k + 1).alias("r")))
    own = asked.join(rows, "q").select("query_id", F.slice(
        F.filter("r", lambda e: e["id"] != F.col("query_id")), 1, k).alias("r"))
    return own.select("query_id", F.posexplode("r").alias("i", "e")).select(
        "query_id", (F.col("i") + 1).alias("rank"), F.col("e.id").alias("vec_id"), F.col("e.s").alias("score"))
