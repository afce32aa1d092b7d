"""Small documents and folders on any Hadoop file system, by path or URI."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(path):
    """File system and Hadoop path."""
    context = SparkSession.active().sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(str(path))
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def join(folder, name: str) -> str:
    return f"{str(folder).rstrip('/')}/{name}"


def exists(path) -> bool:
    fs, where = _at(path)
    return fs.exists(where)


def delete(path) -> None:
    fs, where = _at(path)
    fs.delete(where, True)


def read_text(path) -> str:
    """A whole small document."""
    fs, where = _at(path)
    if not fs.exists(where):
        raise ValueError(f"unable to read {path}")
    stream = fs.open(where)
    try:
        return SparkSession.active().sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(path, document: str) -> None:
    """Write a small document beside its place, then put it there."""
    fs, _ = _at(path)
    fs.setWriteChecksum(False)
    draft = draft_of(path)
    stream = fs.create(_at(draft)[1], True)
    try:
        stream.write(bytearray(document, "utf-8"))
    finally:
        stream.close()
    replace(draft, path)


def stamp(path) -> list[int]:
    """Bytes and newest change of a file, or of all files of a folder."""
    fs, where = _at(path)
    if not fs.exists(where):
        raise ValueError(f"unable to read {path}")
    status = fs.getFileStatus(where)
    found = list(fs.listStatus(where)) if status.isDirectory() else [status]
    return [sum(f.getLen() for f in found), max((f.getModificationTime() for f in found), default=0)]


def draft_of(path) -> str:
    """A new name beside ``path`` that readers of folders pass over."""
    folder, _, name = str(path).rstrip("/").rpartition("/")
    draft = f"_{name}-{uuid.uuid4().hex}"
    return f"{folder}/{draft}" if folder or str(path).startswith("/") else draft


def move_parts(draft, folder, prefix: str) -> None:
    """Put the part files of a finished draft folder into another folder, their names after ``prefix``."""
    fs, source = _at(draft)
    fs.mkdirs(_at(folder)[1])
    for part in fs.listStatus(source):
        name = part.getPath().getName()
        if name.startswith("part-") and not fs.rename(part.getPath(), _at(join(folder, f"{prefix}{name}"))[1]):
            raise ValueError(f"unable to write {folder}")
    fs.delete(source, True)


def replace(draft, path) -> None:
    """Put a finished draft in the place of ``path``."""
    fs, target = _at(path)
    fs.delete(target, True)
    if not fs.rename(_at(draft)[1], target):
        raise ValueError(f"unable to write {path}")
