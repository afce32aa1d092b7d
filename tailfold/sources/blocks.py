"""Block gzip (BGZF): read in parallel by any byte range, and written by executors.

A block-gzip file is a row of small gzip members that all start with the same sixteen bytes.  Spark's own
text reader cuts the file at those bytes, so it deals byte ranges of one file to many tasks, on any
file system that it can open, and every "line" is one member.  A member states its own length, which is
checked; so are its checksum and its size.

Members end anywhere in a line.  A task therefore gives the whole lines of its byte range, and the two
pieces at the ends; the pieces of neighbouring ranges are put together afterwards (few rows, however
large the file).  A file whose name ends in ``.gz`` is read as raw bytes by one task, because Spark does
not split that name; its members are dealt in runs and decompressed by all tasks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tailfold.session import stage

# fixed value: the first bytes of every member, up to its length
HEADER = bytes.fromhex("1f8b08040000000000ff060042430200")
# fixed value: the member without content that ends a file
END = HEADER + bytes.fromhex("1b0003000000000000000000")
#: Bytes of text in a member that is written.
BLOCK_BYTES = 0xFF00
#: Members of a ``.gz`` file that one task decompresses together (64 MB of text).
RUN_MEMBERS = 1024

_LINE, _PIECES, _UNBROKEN = 0, 1, 2
_SCHEMA = "line string, file_path string, block bigint, n bigint, kind int, head binary, tail binary"


def is_block_gzip(first_bytes: bytes) -> bool:
    return first_bytes[:len(HEADER)] == HEADER


def _member(data: bytes) -> bytes:
    """Text of a member, given without its HEADER."""
    if len(data) < 2 or struct.unpack_from("<H", data)[0] != len(data) + len(HEADER) - 1:
        raise ValueError("the gzip file ends inside a member or a member states another length")
    decoder = zlib.decompressobj(-15)
    text = decoder.decompress(data[2:-8])
    checksum, size = struct.unpack("<II", data[-8:])
    if not decoder.eof or decoder.unused_data or len(text) != size or zlib.crc32(text) != checksum:
        raise ValueError("a member of the gzip file is damaged")
    return text


class _Run:
    """Lines of one run of members: the first and the last piece belong to the neighbours too."""

    def __init__(self, path: str, block: int):
        self.path, self.block, self.number = path, block, 0
        self.head: bytes | None = None
        self.rest: list[bytes] = []

    def lines(self, data: bytes) -> list[bytes]:
        first, *others = data.split(b"\n")
        self.rest.append(first)
        if not others:
            return []
        own = [b"".join(self.rest), *others[:-1]]
        self.rest = [others[-1]]
        if self.head is None:
            self.head, own = own[0], own[1:]
        return own

    def batch(self, own: list[bytes]) -> pa.RecordBatch:
        self.number += len(own)
        count = len(own)
        return self._rows([line.removesuffix(b"\r") for line in own],
                          range(self.number - count + 1, self.number + 1), _LINE)

    def ends(self) -> pa.RecordBatch:
        tail = b"".join(self.rest)
        if self.head is None:
            return self._rows([None], [0], _UNBROKEN, tail, None)
        return self._rows([None], [self.number + 1], _PIECES, self.head, tail)

    def _rows(self, lines: list, numbers, kind: int, head=None, tail=None) -> pa.RecordBatch:
        count = len(lines)
        return pa.RecordBatch.from_arrays([
            pa.array([None if x is None else x.decode() for x in lines], pa.string()),
            pa.array([self.path] * count, pa.string()), pa.array([self.block] * count, pa.int64()),
            pa.array(numbers, pa.int64()), pa.array([kind] * count, pa.int32()),
            pa.array([head] * count, pa.binary()), pa.array([tail] * count, pa.binary()),
        ], ["line", "file_path", "block", "n", "kind", "head", "tail"])


def _decompressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = None
    for batch in batches:
        for path, block, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if run is None or (run.path, run.block) != (path, block):
                if run is not None:
                    yield run.ends()
                run = _Run(path, block)
            own = run.lines(_member(data))
            if own:
                yield run.batch(own)
    if run is not None:
        yield run.ends()


def _members(spark: SparkSession, path: str, split: bool) -> DataFrame:
    """``file_path, block, data`` of all members, those of one run in order in one partition."""
    reader = spark.read.option("lineSep", HEADER.decode("latin-1")).option("encoding", "ISO-8859-1")
    if not split:
        # a codec that passes bytes on, in place of the one that the name asks for
        passing = spark.sparkContext._jvm.org.apache.hadoop.io.compress.PassthroughCodec
        reader = (reader.option("io.compression.codecs", passing.CLASSNAME)
                  .option(passing.OPT_EXTENSION, ".gz"))
    raw = reader.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("data"), F.monotonically_increasing_id().alias("id")
    ).where(F.octet_length("data") > 0)
    if split:
        return raw.select("file_path", "block", "data")
    run = F.shiftright("id", RUN_MEMBERS.bit_length() - 1)
    return (raw.withColumn("block", run).repartition("file_path", "block")
            .sortWithinPartitions("file_path", "block", "id").select("file_path", "block", "data"))


def read_block_gzip(spark: SparkSession, path: str, split: bool = True) -> DataFrame:
    """``line, ord`` of a block-gzip file or a folder of them; ``ord`` as in ``text.read_lines``.

    Files whose names end in ``.gz`` need ``split`` to be false.

    The text is decompressed once, into a staged table, because most readers look at it more than once.
    """
    rows = stage(_members(spark, path, split).mapInArrow(_decompressed, _SCHEMA), "block-gzip-lines")
    whole = rows.where(F.col("kind") == _LINE).select("line", "file_path", "block", "n")
    lines = whole.unionByName(_joined_ends(rows.where(F.col("kind") != _LINE)))
    return lines.select("line", F.struct("file_path", "block", "n").alias("ord"))


def _joined_ends(ends: DataFrame) -> DataFrame:
    """The lines that cross runs: the tail of one run, all unbroken runs after it, the next head.

    Only numbers go through the window; a group holds the pieces of a single line.
    """
    broken = (F.col("kind") == _PIECES).cast("int")
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = ends.select("file_path", "block", "kind").withColumn(
        "line_number", F.coalesce(F.sum(broken).over(before), F.lit(0)))
    parts = ends.drop("kind", "line").join(placed, ["file_path", "block"])
    # a head (or an unbroken run) ends or goes on with the line so far; a tail begins the next one
    first = parts.select("file_path", "line_number", "block", F.lit(0).cast("bigint").alias("n"),
                         F.lit(1).alias("side"), F.col("head").alias("piece"))
    last = parts.where(F.col("kind") == _PIECES).select(
        "file_path", (F.col("line_number") + 1).alias("line_number"), "block", "n",
        F.lit(0).alias("side"), F.col("tail").alias("piece"))
    pieces = F.sort_array(F.collect_list(F.struct("block", "side", "n", "piece")))
    joined = first.unionByName(last).groupBy("file_path", "line_number").agg(
        pieces.alias("pieces"), F.max("side").alias("ended"))
    line = F.aggregate("pieces", F.lit(b""), lambda text, p: F.concat(text, p["piece"]))
    # file order: where the line begins; a line without an end is the last one, if it holds anything
    return (
        joined.select(line.alias("bytes"), "file_path", "ended", F.col("pieces")[0].alias("at"))
        .where((F.col("ended") == 1) | (F.octet_length("bytes") > 0))
        .select(F.regexp_replace(F.col("bytes").cast("string"), "\\r$", "").alias("line"), "file_path",
                F.col("at.block").alias("block"), F.col("at.n").alias("n")))


# ------------------------------------------------------------------ writing


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of the lines of a task; the last byte of each, always zero, is left to the line end."""
    def member(text: bytes) -> bytes:
        maker = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = maker.compress(text) + maker.flush()
        if len(body) > 0xFFFF - 26:  # does not shrink
            maker = zlib.compressobj(0, zlib.DEFLATED, -15)
            body = maker.compress(text) + maker.flush()
        return (HEADER + struct.pack("<H", len(body) + 25) + body
                + struct.pack("<II", zlib.crc32(text), len(text)))[:-1]

    def rows(members: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["value"])

    pending, some = b"", False
    for batch in batches:
        some = some or batch.num_rows > 0
        text = pending + b"".join((line or "").encode() + b"\n" for line in batch.column(0).to_pylist())
        full = len(text) // BLOCK_BYTES * BLOCK_BYTES
        pending = text[full:]
        if full:
            yield rows([member(text[i:i + BLOCK_BYTES]) for i in range(0, full, BLOCK_BYTES)])
    if some:
        yield rows([*([member(pending)] if pending else []), END[:-1]])


def write_block_gzip(lines: DataFrame, path: str) -> None:
    """Write a column ``line`` as a folder of block-gzip part files, one a task."""
    members = lines.select("line").mapInArrow(_compressed, "value binary")
    members.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").text(path)
