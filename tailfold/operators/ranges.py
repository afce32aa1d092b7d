"""Position operators: range join, window merging, query chunks, interval lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailfold import config
from tailfold.operators.ordered import running

BUCKET_BP = 1 << 20
# bin widths for long records grow by this many powers of two
LEVEL_STEP = 4
# a position index of at most this many rows (some tens of MB) is broadcast
BROADCAST_ROWS = 500_000


def _bins(low, high, width: int):
    return F.sequence(F.floor(low / width).cast("bigint"), F.floor(high / width).cast("bigint"))


def _meet(rows: DataFrame, index: DataFrame, entries: int) -> DataFrame:
    """Join ``rows`` with a bin index on (chrom, bin), by the measured index size.

    A small index is broadcast, so wide rows such as VCF records never move.  A large
    one is sort-merged, each entry once; rows of a crowded bin, if they are too many
    for a task, are split by adaptive execution (skew join).
    """
    if entries <= BROADCAST_ROWS:
        return rows.join(F.broadcast(index), ["chrom", "_bin"])
    return rows.join(index.hint("merge"), ["chrom", "_bin"])


def _sifted(rows: DataFrame, index: DataFrame, bins: int) -> DataFrame:
    """Rows whose bin the index lists, as far as bits in a broadcast table tell, so that few others move.

    ``bins`` is the number of bins that the index lies in; where they are too many, neighbours share a bit.
    """
    shift = 0
    while bins >> shift + 6 > BROADCAST_ROWS and shift < 48:
        shift += 1
    bit = F.expr(f"shiftleft(1L, cast(shiftright(_bin, {shift}) & 63 AS INT))")
    word = F.shiftright("_bin", shift + 6)
    words = index.groupBy("chrom", word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return (
        rows.withColumn("_word", word).join(F.broadcast(words), ["chrom", "_word"])
        .where(F.col("_bits").bitwiseAND(bit) != 0).drop("_word", "_bits"))


def range_join(variants: DataFrame, features: DataFrame, max_distance: int) -> DataFrame:
    """Variant-feature pairs on one chromosome with ``|pos - tss| <= max_distance``.

    Both sides meet in position bins, so the join is an equi-join followed by an
    exact test.  A variant lies in one bin only: no pair can appear twice.  The
    feature table, which is the smaller one by far, is listed in the three bins each
    feature reaches.
    """
    config.max_distance(max_distance)
    width = max(max_distance, 1)
    left = variants.withColumn("_bin", F.floor(F.col("pos") / width).cast("bigint"))
    reach = _bins(F.col("tss") - max_distance, F.col("tss") + max_distance, width)
    pairs = _meet(left, features.withColumn("_bin", F.explode(reach)), 3 * features.count())
    return (
        pairs.withColumn("distance", F.abs(F.col("pos") - F.col("tss")))
        .where(F.col("distance") <= max_distance)
        .drop("_bin")
    )


def merge_intervals(intervals: DataFrame, closed: bool) -> DataFrame:
    """Union of overlapping ``(chrom, start, end)`` intervals per chromosome.

    Half-open intervals merge when one starts before the earlier ones end; closed
    intervals also when they share that end position.  Equal starts are reduced
    first and the running maximum is bucketed by position, so a chromosome with
    most of the intervals is still worked on by many tasks.
    """
    starts = (
        intervals.groupBy("chrom", "start").agg(F.max("end").alias("end"))
        .withColumn("_bucket", F.floor(F.col("start") / BUCKET_BP))
    )
    ahead = running(starts, ["chrom"], "_bucket", F.col("start").asc(), F.col("_bucket").asc(),
                    "end", "max", "_reach", inclusive=False)
    apart = F.col("start") > F.col("_reach") if closed else F.col("start") >= F.col("_reach")
    flagged = ahead.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
    islands = running(flagged, ["chrom"], "_bucket", F.col("start").asc(),
                      F.col("_bucket").asc(), "_new", "sum", "_island")
    return islands.groupBy("chrom", "_island").agg(
        F.min("start").alias("start"), F.max("end").alias("end")
    ).drop("_island")


def tss_windows(features: DataFrame, max_distance: int) -> DataFrame:
    """Merged half-open BED windows around the TSS positions."""
    config.max_distance(max_distance)
    window = features.select(
        "chrom",
        F.greatest(F.lit(0), F.col("tss") - max_distance - 1).cast("bigint").alias("start"),
        (F.col("tss") + max_distance).cast("bigint").alias("end"),
    )
    return merge_intervals(window, closed=False)


def query_windows(features: DataFrame, max_distance: int) -> DataFrame:
    """Merged 1-based inclusive windows around the TSS positions."""
    config.max_distance(max_distance)
    window = features.select(
        "chrom",
        F.greatest(F.lit(1), F.col("tss") - max_distance).cast("bigint").alias("start"),
        (F.col("tss") + max_distance).cast("bigint").alias("end"),
    )
    return merge_intervals(window, closed=True)


def query_chunks(features: DataFrame, max_distance: int, chunk_size_bp: int) -> DataFrame:
    """Query windows cut into pieces of at most ``chunk_size_bp`` positions."""
    config.chunk_size(chunk_size_bp)
    pieces = query_windows(features, max_distance).withColumn(
        "chunk_start", F.explode(F.sequence("start", "end", F.lit(chunk_size_bp).cast("bigint"))))
    return pieces.select(
        "chrom", F.col("chunk_start").alias("start"),
        F.least("end", F.col("chunk_start") + chunk_size_bp - 1).alias("end"),
    )


def within_windows(rows: DataFrame, windows: DataFrame, max_distance: int,
                   chunk_size_bp: int) -> DataFrame:
    """Rows whose ``pos`` falls into a query window, with their ``chunk`` identity.

    Windows are disjoint, so each row finds at most one.  They are listed in the
    bins they cross; a bin is as wide as the narrowest regular window, which keeps
    the candidates per row to a handful and makes the lookup an equi-join.
    """
    width = 2 * max_distance + 1
    left = rows.withColumn("_bin", F.floor(F.col("pos") / width).cast("bigint"))
    bins = _bins(F.col("start"), F.col("end"), width)
    low, high = F.floor(F.col("start") / width), F.floor(F.col("end") / width)
    entries, extent = windows.groupBy("chrom").agg(
        F.sum(high - low + 1).alias("n"), (F.max(high) - F.min(low) + 1).alias("extent")).agg(
        F.sum("n"), F.sum("extent")).first()
    listed = windows.select(
        "chrom", F.col("start").alias("_start"), F.col("end").alias("_end"),
        F.explode(bins).alias("_bin"))
    index = F.floor((F.col("pos") - F.col("_start")) / chunk_size_bp).cast("bigint")
    if (entries or 0) > BROADCAST_ROWS:
        left = _sifted(left, listed, int(extent))
    return (
        _meet(left, listed, int(entries or 0))
        .where(F.col("pos").between(F.col("_start"), F.col("_end")))
        .withColumn("chunk", F.struct(F.col("_start").alias("window"), index.alias("piece")))
        .drop("_bin", "_start", "_end")
    )


def records_in_chunks(records: DataFrame, windows: DataFrame, max_distance: int,
                      chunk_size_bp: int) -> DataFrame:
    """Every record with every query chunk that it reaches: ``chunk`` and ``starts_here``.

    A record covers ``pos`` to ``end_pos``.  It starts in at most one chunk; a long one also reaches the
    chunks that begin after ``pos`` and up to ``end_pos``.  Records, however wide, are read once: each
    looks up the bin of its position among the windows, and, if it is long, the two bins that it can
    touch among the chunk starts, at a bin width (a power of 16) that follows its own length.  A chunk
    start lies in one bin of every width, so no pair is met twice, and a record meets the chunk starts
    of a stretch that its length bounds, whatever the lengths are.
    """
    width = 2 * max_distance + 1
    end = windows.agg(F.max("end")).first()[0] or 0
    first, last = F.col("pos"), F.least("end_pos", F.lit(end))
    span = last - first + 1
    # widths as exponents of two: the narrowest that the record fits into
    level = (F.ceil(F.log2(span.cast("double")) / LEVEL_STEP) * LEVEL_STEP).cast("int")
    power = F.expr("shiftleft(1L, _level)")
    point = F.struct(F.lit(-1).alias("level"), F.floor(first / width).cast("bigint").alias("at"))
    wide = records.withColumn("_level", level).withColumn("_keys", F.when(
        span > 1, F.concat(F.array(point), F.transform(
            F.sequence(F.floor(first / power).cast("bigint"), F.floor(last / power).cast("bigint")),
            lambda at: F.struct(F.col("_level").alias("level"), at.alias("at"))))
    ).otherwise(F.array(point)))
    keyed = wide.withColumn("_bin", F.explode("_keys")).drop("_keys", "_level")

    listed = windows.select(
        "chrom", F.col("start").alias("_start"), F.col("end").alias("_end"), F.col("start").alias("_window"),
        F.lit(None).cast("bigint").alias("_piece"),
        F.explode(_bins(F.col("start"), F.col("end"), width)).alias("at"))
    chunks = windows.select("chrom", F.col("start").alias("_window"), F.posexplode(
        F.sequence("start", "end", F.lit(chunk_size_bp).cast("bigint"))).alias("_piece", "_start"))
    levels = range(LEVEL_STEP, max(end, 1).bit_length() + LEVEL_STEP, LEVEL_STEP)
    starts = chunks.withColumn("_level", F.explode(F.array(*map(F.lit, levels)))).select(
        "chrom", "_start", F.lit(None).cast("bigint").alias("_end"), "_window",
        F.col("_piece").cast("bigint").alias("_piece"), "_level",
        F.floor(F.col("_start") / power).cast("bigint").alias("at"))
    index = listed.withColumn("_level", F.lit(-1)).unionByName(starts).select(
        "chrom", "_start", "_end", "_window", "_piece",
        F.struct(F.col("_level").alias("level"), "at").alias("_bin"))
    starts_here = F.col("_bin.level") == -1
    return (
        _meet(keyed, index, index.count())
        .where(F.when(starts_here, first.between(F.col("_start"), F.col("_end")))
               .otherwise((F.col("_start") > first) & (F.col("_start") <= last)))
        .withColumn("chunk", F.struct(F.col("_window").alias("window"), F.coalesce(
            "_piece", F.floor((first - F.col("_start")) / chunk_size_bp).cast("bigint")).alias("piece")))
        .withColumn("starts_here", starts_here)
        .drop("_bin", "_start", "_end", "_window", "_piece"))
