"""Approximate nearest neighbours by cosine: an NN-descent graph, searched greedily.

* Equal vectors are one node.  Members of a node are ranked by id, so only its first ``k + 1`` can
  be among anybody's ``k`` nearest; a node of any size is a row of the graph.
* The graph begins with neighbours in cells of a few random projections and improves by
  NN-descent: neighbours of neighbours meet at the node between them, as joins and groupings, and
  every node keeps its ``DEGREE`` nearest.  Reverse neighbours beyond ``REVERSE`` are left to the
  other direction, in which the node is theirs.
* A search starts from the query's own node and from a bounded set of entry nodes and moves along
  the graph, all queries at once, one join a step, keeping a beam of ``BEAM`` nodes until no beam has
  an unvisited node.  Links lead both ways and none is cut.
* Graph and search compare directions in single precision, so near copies keep their order; what is
  found is scored anew: cosines in double precision on the original vectors, added up in the order
  of the components; ties go to the smaller id.

Defined results: vectors that are null, zero, or hold a null or a non-finite component, rows without
an id and vectors of another length than most take no part; an empty table gives no rows; rows that
repeat an id and a vector are one candidate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailfold.session import release, stage

DEGREE = 24       # neighbours of a node in the graph
REVERSE = 24      # reverse neighbours that take part in a local join
PROJECTIONS = 8   # pairs of random directions that the first graph comes from
CELL = 128        # nodes of a cell of such a pair, about
GAINS = 8         # new neighbours that a node takes from one place of a round
ROUNDS = 6        # NN-descent rounds; fewer if hardly anything changes
ENTRIES = 256     # nodes that every search begins with, a bounded set that goes to every task
BEAM = 256
LINKS = 8         # links of a row, which bounds a batch of rows; a node with more has several rows
_SETTLED = 0.01   # share of changed edges at which the graph is taken as settled


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _key(vector: Column) -> Column:
    return F.sha2(F.to_json(F.struct(vector.alias("vector"))), 256)


def nodes_of(table: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """``node, vector, ids``: distinct vectors and their first ``k + 1`` ids.

    Ids of one vector are cut down before and after the shuffle, so no group gathers in a task.
    """
    rows = table.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    ).where(F.col("id").isNotNull() & _usable(F.col("vector")))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("vector") == (length["n"] if length else 0))
    salted = rows.select("id", "vector", _key(F.col("vector")).alias("key"), (F.xxhash64("id") % 64).alias("salt"))
    few = lambda ids: F.slice(F.array_sort(F.array_distinct(ids)), 1, k + 1)
    parts = salted.groupBy("key", "salt").agg(
        F.first("vector").alias("vector"), few(F.collect_set("id")).alias("ids"))
    return parts.groupBy("key").agg(
        F.first("vector").alias("vector"),
        few(F.flatten(F.collect_list("ids"))).alias("ids")
    ).select(F.element_at("ids", 1).alias("node"), "vector", "ids")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten() if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _packed(vectors: np.ndarray) -> list[bytes]:
    """Unit vectors in single precision."""
    units = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    return [row.tobytes() for row in units.astype(np.float32)]


def _directions(column: pa.Array) -> np.ndarray:
    """Unit vectors from packed ones, for sums in double precision."""
    flat = np.frombuffer(b"".join(column.to_pylist()), np.float32).astype(np.float64)
    flat = flat.reshape(len(column), -1)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _coded(rows: DataFrame, id_col: str) -> DataFrame:
    """``<id_col>, code``: packed directions of ``vector``."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_packed(_matrix(batch.column(1))), pa.binary())],
                [id_col, "code"])

    return rows.select(id_col, "vector").mapInArrow(batches, f"{id_col} long, code binary")


def _best(edges: DataFrame, count: int) -> DataFrame:
    """The ``count`` nearest of every node from ``node, other, score`` rows, each other once."""
    once = edges.groupBy("node", "other").agg(F.max("score").alias("score"))
    place = F.row_number().over(
        Window.partitionBy("node").orderBy(F.desc("score"), F.asc("other")))
    return once.withColumn("place", place).where(F.col("place") <= count).drop("place")


def _first_graph(codes: DataFrame, seed: int) -> DataFrame:
    """Edges of every node to its nearest in the same cell of each pair of random directions.

    Cells are cut at quantiles; a crowded cell is dealt by hash into groups of bounded size.
    """
    first = codes.first()
    width = len(first["code"]) // 4 if first else 1
    planes = np.random.default_rng(seed).normal(size=(2 * PROJECTIONS, width))
    cells = max(1, round((codes.count() / CELL) ** 0.5))

    def projected(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            places = _directions(batch.column(0)) @ planes.T
            yield pa.RecordBatch.from_arrays(
                [pa.array(places.tolist(), pa.list_(pa.float64()))], ["places"])

    shares = [c / cells for c in range(1, cells)] or [0.5]
    cuts = codes.select("code").mapInArrow(projected, "places array<double>").agg(*[
        F.percentile_approx(F.col("places")[i], shares).alias(f"c{i}")
        for i in range(2 * PROJECTIONS)]).first()
    tables = [np.array(c if c else [0.0], np.float64) for c in cuts]
    side = len(shares) + 1

    def placed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            places = _directions(batch.column(1)) @ planes.T
            for p in range(PROJECTIONS):
                x, y = (np.searchsorted(tables[i], places[:, i]) for i in (2 * p, 2 * p + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((p * side + x) * side + y, pa.int64()), batch.column(0),
                     batch.column(1)], ["cell", "other", "code"])

    celled = codes.mapInArrow(placed, "cell long, other long, code binary")
    sizes = celled.groupBy("cell").count()
    deal = F.xxhash64("other") % F.ceil(F.col("count") / (2 * CELL))
    return _local_join(
        celled.join(sizes, "cell").select(F.xxhash64("cell", deal).alias("at"), "other", "code",
                                          F.lit(-2.0).alias("worst")), DEGREE)


def _local_join(rows: DataFrame, gains: int) -> DataFrame:
    """``node, other, score`` between nodes that meet ``at`` a place.

    ``rows`` has ``at, other, code, worst``; a node takes its ``gains`` nearest of a place, if they
    are nearer than the ``worst`` it has.  No place has more than a few hundred rows.
    """
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def edges(ids: np.ndarray, codes: np.ndarray, worst: np.ndarray):
            score = codes @ codes.T
            np.fill_diagonal(score, -2.0)
            keep = min(gains, len(ids) - 1)
            near = np.argpartition(-score, keep - 1, axis=1)[:, :keep]
            own = np.take_along_axis(score, near, 1)
            better = own > worst[:, None]
            return (np.broadcast_to(ids[:, None], own.shape)[better], ids[near][better],
                    own[better])

        def pack(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*found)], ["node", "other", "score"])

        for batch in source:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(),
                         _directions(batch.column(2)), batch.column(3).to_numpy()))
            at, ids, codes, worst = (np.concatenate(x) for x in zip(*held))
            starts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist()]
            found = [edges(ids[a:b], codes[a:b], worst[a:b])
                     for a, b in zip(starts, starts[1:]) if b - a > 1]
            if found:
                yield pack(found)
            last = starts[-1]  # the last place may go on in the next batch
            held = [(at[last:], ids[last:], codes[last:], worst[last:])]
        if held and len(held[0][0]) > 1:
            yield pack([edges(*held[0][1:])])

    return (rows.select("at", "other", "code", "worst").repartition("at")
            .sortWithinPartitions("at").mapInArrow(batches, "node long, other long, score double"))


def build_graph(codes: DataFrame, seed: int = 0) -> DataFrame:
    """``node, other, score``: about the DEGREE nearest of every node."""
    graph = stage(_best(_first_graph(codes, seed), DEGREE), "graph")
    for _ in range(ROUNDS):
        worst = graph.groupBy("node").agg(
            F.when(F.count(F.lit(1)) == DEGREE, F.min("score")).otherwise(-2.0).alias("worst"))
        known = codes.join(worst, "node", "left").select(
            F.col("node").alias("other"), "code", F.coalesce("worst", F.lit(-2.0)).alias("worst"))
        rank = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), "other"))
        backward = (
            graph.select(F.col("other").alias("at"), F.col("node").alias("other"), "score")
            .withColumn("rank", rank).where(F.col("rank") <= REVERSE).select("at", "other"))
        meeting = (graph.select(F.col("node").alias("at"), "other").union(backward)
                   .union(codes.select("node", "node")).distinct())
        better = stage(
            _best(_local_join(meeting.join(known, "other"), GAINS).union(graph), DEGREE), "graph")
        changed = better.join(graph, ["node", "other"], "left_anti").count()
        graph = better
        if changed <= _SETTLED * graph.count():
            break
    return graph


def search(queries: DataFrame, codes: DataFrame, graph: DataFrame) -> DataFrame:
    """``query, node, score``: the final beams of ``queries`` (``query, vector, home``).

    ``home`` is the query's own node.  Every step expands all unvisited nodes of all beams; a node's
    links come with their codes, so a step scores where it expands and leaves out what is further
    than a full beam's last.  What has left a beam cannot come back, so every step visits new nodes
    and the search ends by itself: a query stops by having no unvisited node.
    """
    asked = stage(_coded(queries, "query"), "asked")
    # Links lead both ways, so that a node nobody counts among its nearest is still reached.
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "other"))
    both = graph.union(graph.select(F.col("other"), F.col("node"), "score")).groupBy(
        "node", "other").agg(F.max("score").alias("score"))
    links = stage(
        both.withColumn("row", F.floor((rank - 1) / LINKS))
        .join(codes.withColumnRenamed("node", "other"), "other")
        .groupBy("node", "row").agg(F.collect_list(F.struct("other", "code")).alias("to"))
        .select("node", F.col("to.other").alias("others"), F.col("to.code").alias("codes")), "links")
    entries = codes.orderBy(F.xxhash64("node"), "node").limit(ENTRIES).collect()
    entry_ids = np.array([r["node"] for r in entries], np.int64)
    entry_codes = [bytes(r["code"]) for r in entries]
    kinds = "query long, node long, score double, visited boolean"

    def rows_of(query, node, score) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(query, pa.int64()), pa.array(node, pa.int64()),
             pa.array(score.astype(np.float64)), pa.array(np.zeros(len(node), bool))],
            ["query", "node", "score", "visited"])

    def started(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _directions(pa.array(entry_codes, pa.binary()))
        for batch in source:
            score = _directions(batch.column(1)) @ known.T
            near = np.argsort(-score, axis=1, kind="stable")[:, :8]
            yield rows_of(np.repeat(batch.column(0).to_numpy(), near.shape[1]),
                          entry_ids[near].ravel(), np.take_along_axis(score, near, 1).ravel())

    def expanded(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in source:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                counts = batch.column(3).value_lengths().to_numpy()
                if not counts.sum():
                    continue
                asked_codes = np.repeat(_directions(batch.column(1)), counts, axis=0)
                score = np.einsum("rd,rd->r", asked_codes, _directions(batch.column(4).flatten()))
                score = np.round(score, 12)  # the same whenever a pair is scored again
                near = score >= np.repeat(batch.column(2).to_numpy(), counts)
                yield rows_of(np.repeat(batch.column(0).to_numpy(), counts)[near],
                              batch.column(3).flatten().to_numpy()[near], score[near])

    if not entries:
        return queries.select("query", F.col("query").alias("node"), F.lit(0.0).alias("score")).limit(0)
    own = queries.select("query", F.col("home").alias("node"), F.lit(1.0).alias("score"),
                         F.lit(False).alias("visited"))
    beam = stage(asked.mapInArrow(started, kinds).union(own).dropDuplicates(["query", "node"]), "beam")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "node"))
    while True:
        last = beam.groupBy("query").agg(
            F.when(F.count(F.lit(1)) >= BEAM, F.min("score")).otherwise(-2.0).alias("last"))
        unvisited = stage(beam.where(~F.col("visited")).select("query", "node")
                          .join(last, "query").join(asked, "query"), "unvisited")
        if unvisited.isEmpty():
            break
        found = (
            links.join(unvisited, "node").select("query", "code", "last", "others", "codes")
            .mapInArrow(expanded, kinds).dropDuplicates(["query", "node"])
            .join(beam, ["query", "node"], "left_anti"))
        before, beam = beam, stage(
            beam.withColumn("visited", F.lit(True)).union(found)
            .withColumn("place", place).where(F.col("place") <= BEAM).drop("place"), "beam")
        release(codes.sparkSession, before, unvisited)
    return beam.select("query", "node", "score")


def nearest(table: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id",
            vector_col: str = "embedding", seed: int = 0) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``."""
    nodes = stage(nodes_of(table, id_col, vector_col, k), "nodes")
    first = nodes.select(F.size("vector").alias("n")).first()
    codes = stage(_coded(nodes, "node"), "codes")
    graph = build_graph(codes, seed)
    queries = stage(
        table.select(F.col(f"`{id_col}`").cast("long").alias("query"),
                     F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
        .where((F.col("query") % every == 0) & _usable(F.col("vector"))
               & (F.size("vector") == (first["n"] if first else 0)))
        .dropDuplicates(["query"]).withColumn("key", _key(F.col("vector")))
        .join(nodes.select(F.col("node").alias("home"), _key(F.col("vector")).alias("key")), "key")
        .drop("key"), "queries")
    beams = search(queries, codes, graph)

    # Scores of what was found, exactly; then the members of the nodes, all but the query itself.
    # Dividing by a power of two changes no digit and keeps squares from running over or under.
    def scaled(v: Column) -> Column:
        most = F.array_max(F.transform(v, F.abs))
        return F.transform(v, lambda x: x / F.pow(F.lit(2.0), F.floor(F.log2(most))))

    dot = lambda a, b: F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    a, b = F.col("vector"), F.col("node_vector")
    exact = dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
    members = (
        beams.select("query", "node")
        .join(nodes.select("node", scaled(F.col("vector")).alias("node_vector"), "ids"), "node")
        .join(queries.withColumn("vector", scaled(F.col("vector"))), "query")
        .select("query", exact.alias("score"), F.explode("ids").alias("vec_id"))
        .where(F.col("vec_id") != F.col("query")))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return (members.withColumn("rank", rank).where(F.col("rank") <= k)
            .select(F.col("query").alias("query_id"), "rank", "vec_id", "score"))
