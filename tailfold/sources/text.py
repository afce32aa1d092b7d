"""Line-oriented inputs: plain or gzip text of any Hadoop file system.

Every reader starts from ``read_lines``: one row per line with ``ord``, a value that
sorts rows in file order.  Line numbers are worked out only for error messages.
"""

from __future__ import annotations

import contextlib
import csv
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold.functions.values import blank, strip
from tailfold.sources import blocks
from tailfold.sources.quoting import joined_records

GZIP_MAGIC = b"\x1f\x8b"


# ------------------------------------------------------------------- heads


def _first_file(spark: SparkSession, path: str):
    """Hadoop file system and path of a file, or of the first file of a folder that holds anything."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        raise ValueError(f"unable to read {path}")
    if fs.getFileStatus(where).isDirectory():
        files = [f.getPath() for f in fs.listStatus(where)
                 if f.isFile() and f.getLen() and not f.getPath().getName().startswith(("_", "."))]
        where = min(files, key=lambda f: f.getName(), default=None)
    return fs, where


def first_bytes(spark: SparkSession, path: str, count: int = len(blocks.HEADER)) -> bytes:
    """The first bytes of a file as they are stored; the name of the file says nothing."""
    fs, where = _first_file(spark, path)
    if where is None:
        return b""
    stream = fs.open(where)
    try:
        values = [stream.read() for _ in range(count)]
    finally:
        stream.close()
    return bytes(v for v in values if v >= 0)


def head_lines(spark: SparkSession, path) -> Iterator[str]:
    """Lines from the start of a file, plain or gzip, without a Spark job; close it when done.

    A driver-side stream that stops where the caller stops: a header costs what the header holds.
    """
    path = str(path)
    compressed = first_bytes(spark, path, 2) == GZIP_MAGIC
    fs, where = _first_file(spark, path)
    if where is None:
        return
    io = spark.sparkContext._jvm.java.io
    stream = io.BufferedInputStream(fs.open(where), 1 << 16)
    if compressed:
        stream = spark.sparkContext._jvm.java.util.zip.GZIPInputStream(stream)
    reader = io.BufferedReader(io.InputStreamReader(stream, "UTF-8"))
    try:
        while (line := reader.readLine()) is not None:
            yield line
    finally:
        reader.close()


def first_line(spark: SparkSession, path, what: str, skip_blank: bool = True) -> str:
    """First (non-blank) line of a file; files of a folder share their header."""
    with contextlib.closing(head_lines(spark, path)) as lines:
        for line in lines:
            if line.strip() or not skip_blank:
                return line
    raise ValueError(f"{what} is empty")


# ------------------------------------------------------------------- lines


def _pieces(view: memoryview, size: int):
    """Decompressed pieces of a gzip file of any number of members.

    What a member leaves over begins the next one; zero bytes after the last member are padding.
    A file that ends inside a member is an error.
    """
    decoder, rest, at, begun = zlib.decompressobj(31), b"", 0, False
    while True:
        if not rest:
            rest, at = bytes(view[at:at + size]), min(at + size, len(view))
        if not begun:
            rest = rest.lstrip(b"\0")
        if not rest:
            if at < len(view):
                continue
            break
        begun = True
        yield decoder.decompress(rest, 4 * size)
        if decoder.eof:
            rest, decoder, begun = decoder.unused_data, zlib.decompressobj(31), False
        else:
            rest = decoder.unconsumed_tail
    if begun:
        while tail := decoder.decompress(decoder.unconsumed_tail, 4 * size):
            yield tail
        if not decoder.eof:
            raise ValueError("the gzip file ends inside a member")


def _gunzip_lines(batches):
    """Decompress whole files piece by piece into batches of numbered lines."""
    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"]):
            pending, number = b"", 0
            for piece in _pieces(memoryview(content.as_buffer()), 1 << 20):
                *lines, pending = (pending + piece).split(b"\n")
                if lines:
                    yield _numbered(path, number, lines)
                    number += len(lines)
            if pending:
                yield _numbered(path, number, [pending])


def _numbered(path: str, number: int, lines: list[bytes]) -> pa.RecordBatch:
    text = [line.rstrip(b"\r").decode() for line in lines]
    return pa.RecordBatch.from_pydict({
        "line": pa.array(text, pa.string()),
        "file_path": pa.array([path] * len(text), pa.string()),
        "n": pa.array(range(number, number + len(text)), pa.int64()),
    })


def read_lines(spark: SparkSession, path) -> DataFrame:
    """``(line, ord)`` of a file or a folder of part files."""
    path = str(path)
    start = first_bytes(spark, path)
    _, where = _first_file(spark, path)
    named = where is not None and where.getName().endswith(".gz")
    if blocks.is_block_gzip(start):
        return blocks.read_block_gzip(spark, path, split=not named)
    if start[:2] == GZIP_MAGIC and not named:
        # Spark picks codecs by extension only; gzip of one large member cannot be split anyway
        raw = spark.read.format("binaryFile").load(path).select("path", "content")
        numbered = raw.mapInArrow(_gunzip_lines, "line string, file_path string, n bigint")
        return numbered.select(
            "line", F.struct("file_path", F.lit(0).cast("bigint").alias("block"), "n").alias("ord"))
    order = F.struct(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
    )
    return spark.read.text(path).select(F.col("value").alias("line"), order.alias("ord"))


def nonempty_lines(spark: SparkSession, path) -> DataFrame:
    """Stripped lines that hold something, in ``ord`` order."""
    lines = read_lines(spark, path).select(strip(F.col("line")).alias("line"), "ord")
    return lines.where("line <> ''")


def fail_on_violation(rows: DataFrame, problem: Column, what: str,
                      lines: DataFrame | None = None, place: Column | None = None) -> None:
    """Raise for the first row (in file order) whose ``problem`` is not NULL.

    It is named by its line number, or by ``place`` where the lines are not at hand.
    """
    said = problem if place is None else F.concat(problem, F.lit(" at "), place)
    # not a filter: that would sink below the parsing and repeat it for every mention of a cell
    found = F.when(F.col("problem").isNotNull(), F.struct("ord", "problem"))
    report_first(rows.select("ord", said.alias("problem")).agg(F.min(found).alias("first")).first().first,
                 what, rows if lines is None and place is None else lines)


def report_first(first, what: str, lines: DataFrame) -> None:
    """Raise with the line number of a ``(ord, problem)`` row, if there is one."""
    if first is None:
        return
    if lines is None:
        raise ValueError(f"{what} has {first.problem}")
    at = F.struct(*[F.lit(v).alias(n) for n, v in first.ord.asDict().items()])
    same_file = F.col("ord.file_path") == first.ord.file_path
    number = lines.where(same_file & (F.col("ord") <= at)).count()
    raise ValueError(f"{what} line {number} has {first.problem}")


# ---------------------------------------------------------------- delimited


def split_header(line: str) -> list[str]:
    return next(csv.reader([line], delimiter="\t"), [])


# fixed value: one field of a quoted TSV, double quotes inside quotes being doubled
QUOTED_FIELD = r'(?:^|\t)("[^"]*+(?:""[^"]*+)*+"|[^\t]*)'


def body_lines(lines: DataFrame, header: str, what: str) -> DataFrame:
    """Lines after the header, of which every file has one.

    A later line that repeats the header is data that fits no column, so it is an error.
    """
    headers = lines.where(F.col("line") == header).select("ord")
    again = (
        headers.groupBy("ord.file_path").agg(F.min("ord").alias("first"), F.count("ord").alias("n"))
        .where("n > 1").select("first"))
    first = again.agg(F.min("first").alias("first")).first().first
    if first is not None:
        at = F.struct(*[F.lit(v).alias(n) for n, v in first.asDict().items()])
        same = headers.where(
            (F.col("ord.file_path") == first.file_path) & (F.col("ord") > at))
        repeated = same.select("ord", F.lit("the header again").alias("problem")).agg(
            F.min(F.struct("ord", "problem")).alias("first")).first().first
        report_first(repeated, what, lines)
    return lines.where(F.col("line") != header)


def unquoted(field: Column) -> Column:
    """The content of a field; one without quotes around it stays as it is."""
    closed = field.endswith('"') & (F.length(field) > 1)
    inner = F.when(closed, F.substring(field, F.lit(2), F.length(field) - 2)).otherwise(
        F.regexp_replace(field, r'(?s)^"(.*)"$', "$1"))
    return F.when(field.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(field)


def quoted_fields(lines: DataFrame, header: str, columns: list[str],
                  what: str = "table", raw: bool = False) -> DataFrame:
    """Rows of a quoted TSV as ``ord``, ``fields`` (array) and ``malformed``.

    An array keeps the plan small for matrices with thousands of columns; lines
    without any quote take the plain split.  A quoted field may hold line breaks.
    Readers of a few columns may take ``raw`` fields and call ``unquoted`` on those they read.
    """
    lines = joined_records(lines)
    body = body_lines(lines, header, what).where(~blank(F.col("line")))
    careful = F.regexp_extract_all("line", F.lit(QUOTED_FIELD), F.lit(1))
    careful = careful if raw else F.transform(careful, unquoted)
    fields = F.when(F.instr("line", '"') == 0, F.split("line", "\t")).otherwise(careful)
    return body.select("ord", fields.alias("fields")).withColumn(
        "malformed", F.size("fields") != len(columns))


def cell(index: int) -> Column:
    """One field of a parsed row; empty when the row is too short."""
    return F.coalesce(F.get("fields", F.lit(index)), F.lit(""))


def raw_fields(lines: DataFrame, header: str | None, what: str = "table") -> DataFrame:
    """Rows split on TAB only, without quoting: ``ord``, ``line``, ``fields``."""
    if header is not None:
        lines = body_lines(lines, header, what)
    body = lines.where(~blank(F.col("line")))
    return body.select("ord", "line", F.split("line", "\t").alias("fields"))
