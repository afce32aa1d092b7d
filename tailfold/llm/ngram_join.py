"""Jaccard join of documents on word n-grams, with vertical partitioning.

The distinct n-grams of the corpus have one global order: by a logarithmic frequency level, rare
ones first, then by hash.  Levels come from a table of fixed size into which all occurrences of all
documents are counted.

* Documents with equal n-gram sets are one class; only its smallest document goes on.
* Two sets can only reach the similarity if they share one of their first
  ``n - ceil(t * n) + 1`` n-grams, so only those prefixes meet, by n-gram.
* Candidates whose segment lengths in BINS parts of the hash range already rule the similarity out
  go no further; this bound is exact.
* Candidates are verified by vertical partitioning: the global order is cut into fragments at
  quantiles of all occurrences, every set is cut at the same pivots, partial overlaps are counted
  fragment by fragment and summed per pair.
* First each set meets, among the holders of an n-gram, its neighbour in size and one pivot: the
  set whose n-grams are shared most, which finds the original of many copies.  What links is put
  into components, and the next rounds do the same between components with other pivots.  At last
  all remaining candidates *between different components* are verified.  There components meet by
  n-gram, each as one row; two whose sets would meet more often than there are pairs list each pair
  once, so a large group does not repeat its pairs for every n-gram that it shares.  Every two sets of
  different components have been compared or cannot reach the similarity, so components are exact
  although pairs inside a large group of near copies are not all listed.

Defined results: A-Z are lowered, words are runs of ``[^\\x20\\x09-\\x0D]``; fewer than ``width``
words form one n-gram; no words (null, empty, blank): 0 n-grams and no links.  Rows without an id
are listed with their count and take part in nothing.  Rows that repeat an id and a text are one
document; rows that share an id but not the text are one node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailfold.llm.components import components
from tailfold.llm.fixed_tables import parts_of, table_sum
from tailfold.llm.sizes import checked
from tailfold.llm.words import mix64, slices
from tailfold.session import release, stage

COUNT_BITS = 20        # entries of the frequency table, as a power of two
FRAGMENTS = 8
BINS = 512             # parts of the hash range whose lengths are kept per set, as 8-bit numbers
ROUNDS = 2             # of neighbours and pivots, before all that is left
LONGEST = (1 << 8) - 1  # lengths that are larger are cut to it
TOP_LEVEL = 30
_LEVEL_SHIFT = 58      # token = level << 58 | 58 bits of the hash


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct n-gram hashes of every row of a batch."""
    for part in slices(column):
        words = part.hashes(part.lowered())
        rolled = np.zeros(len(words), np.uint64)
        for k in range(width):
            own = words[k:]
            rolled[:len(own)] = mix64(rolled[:len(own)] + own)
        for row in range(part.rows):
            first, last = part.bounds[row], part.bounds[row + 1]
            count = last - first
            if count >= width:
                found = np.unique(rolled[first:last - width + 1])
            elif count:
                short = np.uint64(count)
                for word in words[first:last]:
                    short = mix64(np.array([short], np.uint64) + word)[0]
                found = np.array([short], np.uint64)
            else:
                found = np.zeros(0, np.uint64)
            yield part.first + row, found


def _class_of(found: np.ndarray) -> tuple[int, int]:
    data = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    return (int.from_bytes(data[:8], "little", signed=True),
            int.from_bytes(data[8:], "little", signed=True))


def _bucket(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(6)) & np.uint64((1 << COUNT_BITS) - 1)


def _first_pass(texts: DataFrame, width: int) -> DataFrame:
    """Rows of documents (id, n, class) and, per task, rows of the frequency table."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.int32)

        def rows(ids, n, c1, c2, lengths, part, data):
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(c1, pa.int64()),
                 pa.array(c2, pa.int64()), pa.array(lengths, pa.binary()),
                 pa.array(part, pa.int32()), pa.array(data, pa.binary())],
                ["id", "n", "c1", "c2", "lengths", "part", "counts"])

        for batch in source:
            n, c1, c2, lengths = [], [], [], []
            for _, found in shingle_sets(batch.column(1), width):
                np.add.at(counts, _bucket(found), 1)
                n.append(len(found))
                a, b = _class_of(found)
                c1.append(a)
                c2.append(b)
                lengths.append(np.bincount(
                    (found >> np.uint64(40)) & np.uint64(BINS - 1), minlength=BINS
                ).clip(max=LONGEST).astype(np.uint8).tobytes())
            none = [None] * len(n)
            yield rows(batch.column(0), n, c1, c2, lengths, none, none)
        parts, data = parts_of(counts)
        none = [None] * len(data)
        if data:
            yield rows(none, none, none, none, none, parts, data)

    return texts.mapInArrow(
        batches, "id long, n long, c1 long, c2 long, lengths binary, part int, counts binary")


def _levels(first: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The frequency level of every entry of the table, and the occurrences of every level."""
    counts = table_sum(first.where("part IS NOT NULL").select("part", F.col("counts").alias("data")),
                       1 << COUNT_BITS)
    levels = np.minimum(np.log2(1.0 + counts), TOP_LEVEL).astype(np.uint8)
    return levels, np.bincount(levels, weights=counts, minlength=TOP_LEVEL + 1)


def _pivots(weights: np.ndarray, fragments: int) -> list[int]:
    """Tokens that cut the global order into fragments of equally many occurrences."""
    ends, total, pivots = np.cumsum(weights), weights.sum(), []
    for k in range(1, fragments):
        goal = total * k / fragments
        level = int(np.searchsorted(ends, goal))
        if level >= len(weights) or not weights[level]:
            continue
        share = (goal - (ends[level] - weights[level])) / weights[level]
        pivots.append((level << _LEVEL_SHIFT) + int(min(share, 1) * ((1 << _LEVEL_SHIFT) - 1)))
    return sorted(set(pivots))


def _tokens(found: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The set as sorted int64 positions in the global order."""
    level = levels[_bucket(found)].astype(np.uint64) << np.uint64(_LEVEL_SHIFT)
    return np.sort((level | (found >> np.uint64(6))).astype(np.int64))


def _token_sets(chosen: DataFrame, width: int, levels: np.ndarray, schema: str, emit) -> DataFrame:
    """``emit(id, tokens)`` gives the columns of each document of ``id, text``.

    If ``chosen`` also has ``c1`` and ``c2``, only texts of that class count.
    """
    classed = "c1" in chosen.columns
    names = [column.split()[0] for column in schema.split(", ")]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids = batch.column(0).to_pylist()
            wanted = zip(*(batch.column(k).to_pylist() for k in (2, 3))) if classed else None
            wanted = list(wanted) if classed else None
            out = []
            for row, found in shingle_sets(batch.column(1), width):
                if len(found) and (not classed or _class_of(found) == wanted[row]):
                    out.append(emit(ids[row], _tokens(found, levels)))
                if len(out) == 512 or out and row == len(ids) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.concat_arrays(c) for c in zip(*out)], names)
                    out = []

    return chosen.mapInArrow(batches, schema)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def _postings(chosen: DataFrame, width: int, percent: int, levels: np.ndarray) -> DataFrame:
    """``token, id, size, pos`` for the prefix of every set."""
    def emit(doc, tokens):
        k = prefix_length(len(tokens), percent)
        return (pa.array(tokens[:k]), pa.array(np.full(k, doc, np.int64)),
                pa.array(np.full(k, len(tokens), np.int32)), pa.array(np.arange(k, dtype=np.int32)))

    return _token_sets(chosen, width, levels, "token long, id long, size int, pos int", emit)


def _segments(chosen: DataFrame, width: int, levels: np.ndarray, pivots: list[int]) -> DataFrame:
    """``id, size, fragment, tokens``: what every set has in each fragment of the global order."""
    cuts = np.array(pivots, np.int64)

    def emit(doc, tokens):
        parts = np.split(tokens, np.searchsorted(tokens, cuts))
        full = [i for i, p in enumerate(parts) if len(p)]
        return (pa.array(np.full(len(full), doc, np.int64)),
                pa.array(np.full(len(full), len(tokens), np.int64)), pa.array(full, pa.int32()),
                pa.array([parts[i] for i in full], pa.list_(pa.int64())))

    return _token_sets(
        chosen, width, levels, "id long, size long, fragment int, tokens array<bigint>", emit)


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether sizes and positions of a shared prefix n-gram leave the similarity possible."""
    sa, sb, pa_, pb = (F.col(f"{n}_{x}") for n in ("size", "pos") for x in (a, b))
    overlap = F.least(sa - pa_, sb - pb)
    return ((F.least(sa, sb) * 100 >= F.greatest(sa, sb) * percent)
            & (overlap * 100 >= (sa + sb - overlap) * percent))


def _some_pairs(rows: DataFrame, percent: int, turn: int) -> DataFrame:
    """``id_a, id_b``: every holder of an n-gram with its neighbour and with the n-gram's pivot.

    ``rows`` has ``token, id, size, pos, common, own``; only pairs of different ``own`` count.
    """
    holders = Window.partitionBy("token")
    order = ["size", "id"] if turn == 0 else ["own", "size", "id"]
    weight = F.col("common") if turn == 0 else F.xxhash64("id", F.lit(turn)).cast("double")
    told = rows.withColumn(
        "beside", F.lag(F.struct("id", "size", "pos", "own")).over(holders.orderBy(*order))
    ).withColumn("pivot", F.max(F.struct(
        weight.alias("weight"), "id", "size", "pos", "own")).over(holders))
    fields = ("id", "size", "pos", "own")
    # one pass over the windows for both
    met = told.select(
        *[F.col(c).alias(f"{c}_a") for c in fields],
        F.explode(F.array("beside", F.struct(*[F.col(f"pivot.{c}") for c in fields]))).alias("other"),
    ).select("*", *[F.col(f"other.{c}").alias(f"{c}_b") for c in fields]).drop("other")
    return (
        met.where((F.col("own_a") != F.col("own_b")) & _possible("a", "b", percent))
        .select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
        .distinct())


def _all_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """``id_a, id_b`` of all sets with different ``own`` that share an n-gram, and perhaps others.

    Components meet by n-gram first, each as one row with the bounds of its holders.  Where their
    sets would meet more often than there are pairs of them, all of these pairs are listed once; the
    sets of other components meet by n-gram.
    """
    def ends(source: DataFrame, x: str, *columns: str) -> DataFrame:
        return source.select(
            *columns, *[F.col(c).alias(f"{c}_{x}") for c in source.columns if c not in columns])

    held = stage(rows.groupBy("token", "own").agg(
        F.count(F.lit(1)).alias("held"), F.min("size").alias("small"), F.max("size").alias("large"),
        F.max(F.col("size") - F.col("pos")).alias("rest")), "held")
    rest = F.least("rest_a", "rest_b")
    shared = (
        ends(held, "a", "token").join(ends(held, "b", "token"), "token")
        .where((F.col("own_a") < F.col("own_b"))
               & (F.col("large_a") * 100 >= F.col("small_b") * percent)
               & (F.col("large_b") * 100 >= F.col("small_a") * percent)
               & (rest * 100 >= (F.col("small_a") + F.col("small_b") - rest) * percent)))
    met = shared.groupBy("own_a", "own_b").agg(
        F.sum(F.col("held_a") * F.col("held_b")).alias("meetings"))
    members = stage(rows.select("own", "id", "size").distinct(), "open-members")
    sizes = members.groupBy("own").agg(F.count(F.lit(1)).alias("sets"))
    met = stage(
        met.join(sizes.select(F.col("own").alias("own_a"), F.col("sets").alias("sets_a")), "own_a")
        .join(sizes.select(F.col("own").alias("own_b"), F.col("sets").alias("sets_b")), "own_b")
        .select("own_a", "own_b",
                (F.col("meetings") >= F.col("sets_a") * F.col("sets_b")).alias("whole")), "met")

    whole = (
        met.where("whole").join(ends(members, "a"), "own_a").join(ends(members, "b"), "own_b")
        .where(F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent))
    few = met.where(~F.col("whole")).select("own_a", "own_b")
    holders = rows.select("token", "own", "id", "size", "pos")
    single = (
        shared.select("token", "own_a", "own_b").join(few, ["own_a", "own_b"], "left_semi")
        .join(ends(holders, "a", "token"), ["token", "own_a"])
        .join(ends(holders, "b", "token"), ["token", "own_b"])
        .where(_possible("a", "b", percent)))
    listed = whole.select("id_a", "id_b").union(single.select("id_a", "id_b"))
    pairs = stage(listed.select(F.least("id_a", "id_b").alias("id_a"),
                                F.greatest("id_a", "id_b").alias("id_b")).distinct(), "pairs")
    release(rows.sparkSession, held, members, met)
    return pairs


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that the lengths of their sets' parts leave possible.

    Sets share at most the shorter length of each part.
    """
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8)
                    .reshape(-1, BINS) for k in (3, 5))
            n_a, n_b = (batch.column(k).to_numpy() for k in (2, 4))
            shorter = np.minimum(a, b)
            most = shorter.sum(axis=1, dtype=np.int64)
            keep = (most * 100 >= (n_a + n_b - most) * percent) | (shorter == LONGEST).any(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(keep)) for k in (0, 1)], ["id_a", "id_b"])

    ends = {x: classes.select(F.col("id").alias(f"id_{x}"), F.col("size").alias(f"n_{x}"),
                              F.col("lengths").alias(f"lengths_{x}")) for x in "ab"}
    return (
        pairs.join(ends["a"], "id_a").join(ends["b"], "id_b")
        .select("id_a", "id_b", "n_a", "lengths_a", "n_b", "lengths_b")
        .mapInArrow(batches, "id_a long, id_b long"))


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, percent: int,
              levels: np.ndarray, pivots: list[int]) -> DataFrame:
    """The pairs (``id_a, id_b``) that reach the similarity."""
    needed = pairs.select(F.col("id_a").alias("id")).union(pairs.select("id_b")).distinct()
    wanted = stage(classes.join(needed, "id").select("id", "c1", "c2"), "needed")
    chosen = docs.join(checked(wanted), "id").select("id", "text", "c1", "c2")
    segments = stage(_segments(chosen, width, levels, pivots), "segments")
    ends = {x: segments.select(F.col("id").alias(f"id_{x}"), "fragment",
                               F.col("size").alias(f"size_{x}"), F.col("tokens").alias(f"tokens_{x}"))
            for x in "ab"}
    partial = (
        pairs.select("id_a", "id_b").join(ends["a"], "id_a").join(ends["b"], ["id_b", "fragment"])
        .select("id_a", "id_b", "size_a", "size_b",
                F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long").alias("common")))
    links = stage(
        partial.groupBy("id_a", "id_b", "size_a", "size_b").agg(F.sum("common").alias("common"))
        .where(F.col("common") * 100
               >= (F.col("size_a") + F.col("size_b") - F.col("common")) * percent)
        .select("id_a", "id_b"), "links")
    del partial, ends
    release(docs.sparkSession, segments, wanted)
    return links


def linked(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.col(f"`{text_col}`").alias("text"))
    first = stage(_first_pass(texts, width), "shingle-sets")
    members = first.where("part IS NULL").select("id", "n", "c1", "c2", "lengths")
    classes = stage(
        members.where("n > 0 AND id IS NOT NULL").groupBy("c1", "c2")
        .agg(F.min("id").alias("id"), F.first("n").alias("size"),
             F.first("lengths").alias("lengths")), "classes")
    levels, weights = _levels(first)
    pivots = _pivots(weights, FRAGMENTS)

    whole = texts.where("id IS NOT NULL")
    if members.where("id IS NOT NULL").groupBy("id").count().where("count > 1").limit(1).count():
        whole = whole.dropDuplicates(["id", "text"])
    copies = stage(members.where("id IS NOT NULL").select("id").distinct()
                   .join(classes.select("id"), "id", "left_anti"), "copies")
    holders = Window.partitionBy("token")
    shared = stage(
        _postings(whole.join(checked(copies), "id", "left_anti"), width, percent, levels)
        .withColumn("least", F.min("id").over(holders))
        .withColumn("most", F.max("id").over(holders))
        .withColumn("holders", F.count(F.lit(1)).over(holders))
        .where("least < most").drop("least", "most"), "shared-prefixes")
    release(docs.sparkSession)
    common = stage(shared.groupBy("id").agg(
        (F.sum("holders") / F.first("size")).alias("common")), "commonness")
    arguments = (whole, classes, width, percent, levels, pivots)
    rows = stage(shared.drop("holders").join(common, "id").withColumn("own", F.col("id")), "open")
    spark = docs.sparkSession
    release(spark, shared, common)
    tried, groups = None, None
    for turn in range(ROUNDS + 1):
        pairs = _all_pairs(rows, percent) if turn == ROUNDS else _some_pairs(rows, percent, turn)
        if tried is not None:
            pairs = pairs.join(tried, ["id_a", "id_b"], "left_anti")
        pairs = stage(pairs, "candidates")
        release(spark)
        if turn and pairs.isEmpty():
            continue
        likely = stage(_plausible(pairs, classes, percent), "plausible")
        release(spark)
        links = _verified(likely, *arguments).select(
            F.col("id_a").alias("u"), F.col("id_b").alias("v"))
        if groups is not None:
            links = links.union(groups.select("node", "component"))
        groups = stage(components(links), "groups")
        release(spark, likely)
        if turn == ROUNDS:
            break
        tried = pairs if tried is None else tried.union(pairs)
        named = rows.drop("own").join(
            groups.withColumnRenamed("node", "id").withColumnRenamed("component", "own"), "id", "left"
        ).withColumn("own", F.coalesce("own", "id"))
        still_open = named.groupBy("token").agg(
            F.min("own").alias("low"), F.max("own").alias("high")).where("low < high").select("token")
        narrowed = stage(named.join(still_open, "token", "left_semi"), "open")
        release(spark, rows)
        rows = narrowed
    final = groups
    named_classes = (
        classes.join(final.withColumnRenamed("node", "id"), "id", "left")
        .select("c1", "c2", F.coalesce("component", "id").alias("class_component")))
    return members.join(named_classes, ["c1", "c2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("class_component")))
        .otherwise(F.col("id")).alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that a smaller document of their component stands for."""
    dropped = stage(linked(docs, width, percent, id_col, text_col).where(
        F.col("component_id") < F.col(id_col)).select(id_col).distinct(), "near-copies")
    return docs.join(checked(dropped), id_col, "left_anti").select(
        [F.col(f"`{c}`") for c in docs.columns])
