"""Exact duplicates by digest, with frequent digests split off (built-in SQL functions only).

A Misra-Gries summary (Spark's mergeable ``approx_top_k``, a Misra-Gries sketch with batched
decrements) names the digests that may hold more than ``HEAVY_SHARE`` of the rows.  An exact,
map-side combined aggregate over those digests verifies them; at most ``MAX_HEAVY`` winners are
broadcast and decide their rows without a shuffle.  All other digests go through an ordinary
shuffle, where no group can be large.  A frequent digest that the summary should miss is still
decided by the ordinary path.

Defined results: a null text counts as empty; rows without an id come after all ids, so they stay
only in groups without any id; of rows repeating id and text one stays; extra columns are kept by
``deduplicate``, whatever they are called, and ignored by ``mark``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailfold.session import stage

# The summary tracks this many digests; its count error is below 4 rows in SKETCH_ITEMS.
SKETCH_ITEMS = 16_384
MAX_HEAVY = 1_000
HEAVY_SHARE = 1.0 / MAX_HEAVY


def normalised(text: Column) -> Column:
    """Every run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text as 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


def heavy_winners(digests: DataFrame) -> DataFrame:
    """``_digest, _winner, _group_size`` of the verified frequent digests, MAX_HEAVY rows at most.

    ``digests`` has ``_digest`` and the orderable ``_row``; the smallest ``_row`` wins.
    """
    summary = digests.agg(
        F.count(F.lit(1)).alias("_n"),
        F.expr(f"approx_top_k(xxhash64(_digest), {MAX_HEAVY}, {SKETCH_ITEMS})").alias("_top"))
    suspects = (
        summary.select("_n", F.inline("_top"))
        .where((F.col("count") > 1) & (F.col("count") >= F.col("_n") * HEAVY_SHARE))
        .select(F.col("item").alias("_item"), "_n"))
    return (
        digests.join(F.broadcast(suspects), F.xxhash64("_digest") == F.col("_item"))
        .groupBy("_digest")
        .agg(F.min("_row").alias("_winner"), F.count(F.lit(1)).alias("_group_size"),
             F.first("_n").alias("_n"))
        .where(F.col("_group_size") >= F.col("_n") * HEAVY_SHARE)
        .drop("_n"))


def _ordered(id_col: str) -> Column:
    return F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"))


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    The text is read once; what follows works on a staged table of ids and digests.
    """
    staged = stage(docs.select(
        F.col(id_col).alias("_id"), digest(F.col(text_col)).alias("_digest"),
        F.monotonically_increasing_id().alias("_tag")), "digests")
    rows = staged.select("_id", "_digest", F.struct(
        F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"),
        F.col("_tag").alias("tag")).alias("_row"))
    heavy = stage(heavy_winners(rows), "frequent-digests")
    decided = rows.join(F.broadcast(heavy), "_digest")
    group = Window.partitionBy("_digest")
    rest = (
        rows.join(F.broadcast(heavy.select("_digest")), "_digest", "left_anti")
        .withColumn("_winner", F.min("_row").over(group))
        .withColumn("_group_size", F.count(F.lit(1)).over(group)))
    return decided.select(rest.columns).unionByName(rest).select(
        F.col("_id").alias(id_col),
        F.col("_winner.id").alias("keep_id"),
        F.col("_group_size").alias("group_size"),
        (F.col("_row.tag") == F.col("_winner.tag")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns.

    Losers of frequent digests are removed before the shuffle; the others meet by digest.
    """
    digests = stage(docs.select(
        _ordered(id_col).alias("_row"), digest(F.col(text_col)).alias("_digest")), "digests")
    heavy = stage(heavy_winners(digests), "frequent-digests").select("_digest", "_winner")
    first = Window.partitionBy("_digest").orderBy("_row")
    return (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                    digest(F.col(text_col)).alias("_digest"), _ordered(id_col).alias("_row"))
        .join(F.broadcast(heavy), "_digest", "left")
        .where(F.col("_winner").isNull() | (F.col("_row") == F.col("_winner")))
        .withColumn("_place", F.row_number().over(first))
        .where(F.col("_place") == 1)
        .select("_doc.*"))
