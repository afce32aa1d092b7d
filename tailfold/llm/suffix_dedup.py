"""Removal of long repeated byte strings by suffix sorting with a difference cover.

A byte goes if a ``length``-byte string that covers it also starts in a document with a smaller id.

1. Of equal texts only the smallest document goes on; the others repeat it from end to end.
2. Every window of ``length`` bytes names one of its ``GRAM``-byte strings, the one with the least
   hash, so equal windows name the same one wherever they are.  Windows whose gram is named in one
   document only cannot repeat and are left out; that is exact.
3. The windows that are left are cut out as regions, one per run of the same gram.
4. Regions are dealt out by gram, which brings all equal windows together.  Equal regions are put
   together with their smallest document.  Windows whose hash comes once there cannot repeat either
   and are left out; the stretches that are left, equal ones once, are suffix-sorted by the
   difference-cover algorithm: sampled triples are sorted, their names sorted by recursion, the other
   suffixes merged in; neighbours in the order are compared on their first ``length`` bytes, and the
   smallest document of each set of equal windows is found.  What goes is told to every document
   there and then.
5. Of a gram with more region bytes than ``HOT_BYTES`` equal regions are put together by map-side
   combination, then dealt and sorted in the same way, and the verdicts are joined back to the
   places of the regions.  If its distinct regions are beyond ``HOT_BYTES`` too, they are not sorted:
   the windows, each once per ``SLICE`` windows of a region, are grouped with map-side combination,
   and the minima are joined back, so no group is held by a task.
6. The removed runs of a document are joined.

Defined results: a null text is empty; rows without an id are listed and keep all their bytes; rows
with the same id do not remove each other's bytes, and if their texts differ, what goes from one
goes at the same places from the others; texts shorter than ``length`` stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tailfold.llm.sizes import checked
from tailfold.llm.words import mix64, text_buffers
from tailfold.session import release, stage

GRAM = 20
CHUNK_BYTES = 1 << 21       # region bytes that are sorted together
HOT_BYTES = 1 << 22         # region bytes of one gram beyond which a task does not hold them
SLICE = 1 << 13             # windows of a region whose equal ones are put together before grouping
_HASH_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


# --- suffix order -------------------------------------------------------------------------------

def _names(*symbols: np.ndarray) -> tuple[np.ndarray, int]:
    """Order-preserving names, from 1, of tuples of non-negative integers; and their number."""
    key = symbols[0]
    for symbol in symbols[1:]:
        top = int(symbol.max(initial=0)) + 1
        if (int(key.max(initial=0)) + 1) * top >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
        key = key * top + symbol
    found, inverse = np.unique(key, return_inverse=True)
    return inverse.astype(np.int64) + 1, len(found)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of an array of positive integers, in order."""
    n = len(text)
    if n < 8:
        return np.array(sorted(range(n), key=lambda i: tuple(text[i:])), np.int64)
    t = np.concatenate([text.astype(np.int64), np.zeros(4, np.int64)])
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    names, count = _names(t[sample], t[sample + 1], t[sample + 2])
    rank = np.zeros(n + 4, np.int64)
    if count == len(sample):
        rank[sample] = names
    else:
        order = suffix_order(names)
        rank[sample[order]] = np.arange(1, len(sample) + 1)
    by_rank = np.empty(len(sample), np.int64)
    by_rank[rank[sample] - 1] = sample
    by_rank = by_rank[by_rank < n]

    # The other suffixes, by one symbol and a rank; then their places among the sampled ones.
    base = np.int64(n + 5)
    rest = np.arange(0, n, 3)
    one = t[rest] * base + rank[rest + 1]
    order = np.argsort(one, kind="stable")
    rest, one = rest[order], one[order]
    first = by_rank[by_rank % 3 == 1]
    second = by_rank[by_rank % 3 == 2]
    pair, _ = _names(np.concatenate([t[rest], t[second]]), np.concatenate([t[rest + 1], t[second + 1]]))
    two = pair[:len(rest)] * base + rank[rest + 2]
    before = (np.searchsorted(t[first] * base + rank[first + 1], one)
              + np.searchsorted(pair[len(rest):] * base + rank[second + 2], two))
    places = np.arange(len(rest)) + before
    out = np.empty(n, np.int64)
    sampled = np.ones(n, bool)
    sampled[places] = False
    out[places] = rest
    out[sampled] = by_rank
    return out


def _joined(regions: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All regions, each with a byte behind it; their sizes and their ends."""
    data = np.frombuffer(b"\0".join(regions) + b"\0", np.uint8)
    sizes = np.array([len(r) for r in regions], np.int64)
    return data, sizes, np.cumsum(sizes + 1) - 1


def _repeating(regions: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Regions with a window whose hash comes twice, and the first and last of these windows in each.

    Equal windows have equal hashes, so every other window comes once.
    """
    data, sizes, ends = _joined(regions)
    region = np.repeat(np.arange(len(regions)), sizes + 1)
    hashes, width = data.astype(np.uint64) + np.uint64(1), 1
    while width < length:
        step = min(width, length - width)
        hashes = hashes[:-step] * np.uint64(_HASH_STEPS[width.bit_length() % 3]) + hashes[step:]
        width += step
    at = np.arange(len(hashes))
    at = at[at + length <= ends[region[:len(hashes)]]]
    order = np.argsort(hashes[at])
    ordered = hashes[at][order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = at[twice]
    which, first = np.unique(region[at], return_index=True)
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    begins = (ends - sizes)[which]
    return which, at[first] - begins, at[last] - begins


def least_owners(regions: list[bytes], owners: np.ndarray, length: int) -> list[np.ndarray]:
    """For every ``length``-byte window of every region the least owner of an equal window.

    Only the stretches of regions from their first to their last window that may repeat are sorted,
    equal ones once.
    """
    found = [np.full(max(len(r) - length + 1, 0), owner, np.int64)
             for r, owner in zip(regions, owners)]
    which, first, last = _repeating(regions, length)
    if len(which):
        parts: dict[bytes, int] = {}
        part = np.array([parts.setdefault(regions[k][a:b + length], len(parts))
                         for k, a, b in zip(which.tolist(), first.tolist(), last.tolist())])
        least = np.full(len(parts), np.iinfo(np.int64).max)
        np.minimum.at(least, part, owners[which])
        judged = _sorted_owners(list(parts), least, length)
        for k, a, p in zip(which.tolist(), first.tolist(), part.tolist()):
            found[k][a:a + len(judged[p])] = judged[p]
    return found


def _sorted_owners(regions: list[bytes], owners: np.ndarray, length: int) -> list[np.ndarray]:
    """The least owners by suffix order."""
    data, sizes, ends = _joined(regions)
    text = data.astype(np.int64) + 1
    text[ends] = 0
    text += 1  # separators come first, and every symbol is positive
    window = np.zeros(len(data), bool)
    region = np.repeat(np.arange(len(regions)), sizes + 1)
    window[np.arange(len(data)) + length <= ends[region]] = True
    order = suffix_order(text)
    order = order[window[order]]
    rows = np.lib.stride_tricks.sliding_window_view(data, length)
    new = np.ones(len(order), bool)
    for a in range(1, len(order), 1 << 16):
        b = min(a + (1 << 16), len(order))
        new[a:b] = (rows[order[a:b]] != rows[order[a - 1:b - 1]]).any(axis=1)
    starts = np.flatnonzero(new)
    least = np.minimum.reduceat(owners[region[order]], starts) if len(starts) else starts
    found = np.zeros(len(data), np.int64)
    found[order] = np.repeat(least, np.diff(np.append(starts, len(order))))
    begins = ends - sizes
    return [found[b:b + s - length + 1] for b, s in zip(begins, sizes)]


# --- windows and their grams ----------------------------------------------------------------------

def _slide(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x, size = np.minimum(x[:-size], x[size:]), 2 * size
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if size < width else x


def window_grams(data: np.ndarray, length: int) -> np.ndarray:
    """The least gram hash of every window of ``length`` bytes."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    x = data.astype(np.uint64) + np.uint64(1)
    h2 = x[:-1] * np.uint64(0x9E3779B97F4A7C15) + x[1:]
    h4 = mix64(h2[:-2]) * np.uint64(0xC2B2AE3D27D4EB4F) + h2[2:]
    h8 = h4[:-4] * np.uint64(0x9E3779B185EBCA87) + h4[4:]
    h16 = mix64(h8[:-8]) * np.uint64(0xD6E8FEB86659FD93) + h8[8:]
    n = len(data) - GRAM + 1
    return _slide(mix64(h16[:n] * np.uint64(0xA24BAED4963EE407) + h4[16:16 + n]), length - GRAM + 1)


def _rows(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    data, offsets = text_buffers(batch.column(column))
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield data[a:b]


def _samples(texts: DataFrame, length: int) -> DataFrame:
    """``gram, id``: the distinct grams of every text."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids = batch.column(0).to_numpy()
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                found = [np.unique(window_grams(x, length)) for x in _rows(part, 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)),
                     pa.array(np.repeat(ids[first:first + 256], [len(f) for f in found]))],
                    ["gram", "id"])

    return texts.mapInArrow(batches, "gram long, id long")


def _regions(texts: DataFrame, length: int) -> DataFrame:
    """``gram, id, start, region`` of ``id, text, shared``: runs of windows with a shared gram."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                rows: list[tuple] = []
                shared = part.column(2)
                for k, (doc, data) in enumerate(zip(part.column(0).to_pylist(), _rows(part, 1))):
                    grams = window_grams(data, length).view(np.int64)
                    if not len(grams):
                        continue
                    starts = np.concatenate([[0], np.flatnonzero(grams[1:] != grams[:-1]) + 1])
                    ends = np.append(starts[1:], len(grams))
                    keep = np.isin(grams[starts], shared[k].values.to_numpy())
                    text = data.tobytes()
                    rows.extend((grams[a], doc, a, text[a:b + length - 1])
                                for a, b in zip(starts[keep].tolist(), ends[keep].tolist()))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), (
                            pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                        ["gram", "id", "start", "region"])

    return texts.mapInArrow(batches, "gram long, id long, start long, region binary")


def _runs_of(owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of equal owners: their owners and lengths."""
    cut = np.flatnonzero(owners[1:] != owners[:-1]) + 1
    return owners[np.append(0, cut)], np.diff(np.concatenate([[0], cut, [len(owners)]]))


def _windows(regions: DataFrame, length: int) -> DataFrame:
    """``rid, offset, owner, window, places`` of ``rid, owner, region``: the windows of a region.

    A region is cut into slices of SLICE windows, each beginning at an ``offset``; a window is one
    row for each slice that holds it, with its ``places`` there.
    """
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()))
    names = ["rid", "offset", "owner", "window", "places"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in source:
            for rid, owner, region in zip(*(batch.column(k) for k in range(3))):
                rid, owner, region = rid.as_py(), owner.as_py(), region.as_py()
                for offset in range(0, len(region) - length + 1, SLICE):
                    found: dict[bytes, list[int]] = {}
                    n = min(SLICE, len(region) - length + 1 - offset)
                    for i in range(n):
                        found.setdefault(region[offset + i:offset + i + length], []).append(i)
                    rows.extend((rid, offset, owner, w, at) for w, at in found.items())
                    held += n
                    if held >= 4 * SLICE:
                        yield packed()
                        rows, held = [], 0
        if rows:
            yield packed()

    return regions.select("rid", "owner", "region").mapInArrow(
        batches, "rid binary, offset long, owner long, window binary, places array<int>")


def _crowded_verdicts(windows: DataFrame) -> DataFrame:
    """``rid, offset, owners, counts`` of ``_windows``, which is read twice.

    A window that very many regions hold is one row for each map task when minima are found, and
    the join back streams its rows past one minimum.
    """
    least = windows.groupBy("window").agg(F.min("owner").alias("least"))
    slices = (
        windows.select("rid", "offset", "window", "places").join(least, "window")
        .groupBy("rid", "offset").agg(F.collect_list(F.struct("least", "places")).alias("found")))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            values, counts = [], []
            for found in batch.column(2):
                parts = found.values
                places = parts.field("places")
                at = places.flatten().to_numpy()
                own = np.empty(len(at), np.int64)
                own[at] = np.repeat(parts.field("least").to_numpy(),
                                    places.value_lengths().to_numpy())
                value, count = _runs_of(own)
                values.append(value)
                counts.append(count)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.list_(pa.int64())),
                 pa.array(counts, pa.list_(pa.int64()))], ["rid", "offset", "owners", "counts"])

    return slices.mapInArrow(
        batches, "rid binary, offset long, owners array<bigint>, counts array<bigint>")


def _whole_keys(source: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Columns of whole keys, about CHUNK_BYTES at a time, of rows ordered by key; a region is last."""
    held: list[tuple] = []
    size, last = 0, None
    for batch in source:
        for key, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if key != last and size >= CHUNK_BYTES:
                yield list(zip(*held))
                held, size = [], 0
            held.append(tuple(row))
            size += len(row[-1])
            last = key
    if held:
        yield list(zip(*held))


def _cuts(dealt: DataFrame, length: int) -> DataFrame:
    """``id, first, last``: starts of removed windows, from ``key, id, start, region``.

    Whole keys are sorted, equal regions once.
    """
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, starts, regions in _whole_keys(source):
            ids, starts = np.array(ids, np.int64), np.array(starts, np.int64)
            parts: dict[bytes, int] = {}
            part = np.array([parts.setdefault(r, len(parts)) for r in regions])
            owners = np.full(len(parts), np.iinfo(np.int64).max)
            np.minimum.at(owners, part, ids)
            least = least_owners(list(parts), owners, length)
            # Runs of equal owners, which end with their region.
            flat = np.concatenate(least)
            sizes = np.array([len(own) for own in least])
            begins = np.cumsum(sizes) - sizes
            new = np.append(True, flat[1:] != flat[:-1])
            new[begins] = True
            at = np.flatnonzero(new)
            counts = np.add.reduceat(new, begins, dtype=np.int64)
            offsets = at - np.repeat(begins, counts)
            # The runs of every row's region.
            each = counts[part]
            run = np.arange(each.sum()) + np.repeat(
                (np.cumsum(counts) - counts)[part] - (np.cumsum(each) - each), each)
            row = np.repeat(np.arange(len(ids)), each)
            hit = flat[at[run]] < ids[row]
            run, row = run[hit], row[hit]
            first = starts[row] + offsets[run]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row]), pa.array(first),
                 pa.array(first + np.diff(np.append(at, len(flat)))[run] - 1)], ["id", "first", "last"])

    return (dealt.select("key", "id", "start", "region").repartition("key")
            .sortWithinPartitions("key").mapInArrow(batches, "id long, first long, last long"))


def _verdicts(dealt: DataFrame, length: int) -> DataFrame:
    """``rid, offset, owners, counts`` from ``key, rid, offset, owner, region``.

    The least owners of a region's windows come as runs of equal ones.  Whole keys are sorted.
    """
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rids, offsets, owners, regions in _whole_keys(source):
            least = least_owners(list(regions), np.array(owners, np.int64), length)
            values, counts = zip(*map(_runs_of, least))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids, pa.binary()), pa.array(offsets, pa.int64()),
                 pa.array(values, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int64()))],
                ["rid", "offset", "owners", "counts"])

    return (dealt.select("key", "rid", "offset", "owner", "region").repartition("key")
            .sortWithinPartitions("key")
            .mapInArrow(batches, "rid binary, offset long, owners array<bigint>,"
                                 " counts array<bigint>"))


def _removed(marks: DataFrame) -> DataFrame:
    """``id, first, last``: starts of removed windows, from ``id, start, owners, counts`` of regions."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            ids, starts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            owners, sizes = (batch.column(k).flatten().to_numpy() for k in (2, 3))
            row = np.repeat(np.arange(len(ids)), np.diff(batch.column(2).offsets.to_numpy()))
            # Where each run of equal owners begins in its region.
            before = np.cumsum(sizes) - sizes
            opens = np.flatnonzero(np.append(True, np.diff(row) != 0)) if len(row) else row
            before = before - np.repeat(before[opens], np.diff(np.append(opens, len(row))))
            hit = owners < ids[row]
            first = (starts[row] + before)[hit]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row[hit]]), pa.array(first), pa.array(first + sizes[hit] - 1)],
                ["id", "first", "last"])

    return marks.mapInArrow(batches, "id long, first long, last long")


def _kept(docs: DataFrame, length: int, id_kind: str) -> DataFrame:
    """The result rows of ``id, text, runs, copy``."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out: list[tuple] = []
            for doc, data, runs, copy in zip(batch.column(0).to_pylist(), _rows(batch, 1),
                                             batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                gone = np.zeros(len(data) + 1, np.int32)
                if copy and len(data) >= length:
                    gone[0], gone[-1] = 1, -1
                for run in runs or ():
                    gone[min(run["first"], len(data))] += 1
                    gone[min(run["last"] + length, len(data))] -= 1
                off = np.cumsum(gone)[:-1] > 0
                spans = int(off[:1].sum() + (off[1:] & ~off[:-1]).sum())
                out.append((doc, len(data), int(off.sum()), spans,
                            hashlib.sha256(data[~off].tobytes()).hexdigest()))
            columns = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (
                    batch.column(0).type, pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return docs.mapInArrow(
        batches, f"id {id_kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _heavy(regions: DataFrame, name: str) -> DataFrame:
    """``gram`` of those whose regions are beyond HOT_BYTES."""
    return stage(
        regions.groupBy("gram").agg(F.sum(F.length("region")).alias("bytes"))
        .where(F.col("bytes") > HOT_BYTES).select("gram"), name)


def removed_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_bytes, n_removed, n_spans, kept_sha256``."""
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                        F.col(f"`{text_col}`").alias("text"))
    known = texts.where("id IS NOT NULL")
    digests = stage(known.select("id", F.unhex(F.sha2("text", 256)).alias("digest"))
                    .where("digest IS NOT NULL"), "text-digests")
    least = digests.groupBy("digest").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    copies = stage(digests.join(least.where("n > 1"), "digest").where("id > least")
                   .select("id", "digest").distinct(), "text-copies")
    listed = copies.withColumn("copy", F.lit(True))

    def with_copy_mark(rows: DataFrame) -> DataFrame:
        told = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
        return told.join(checked(listed), ["id", "digest"], "left").withColumn(
            "copy", F.coalesce("copy", F.lit(False))).drop("digest")

    singles = with_copy_mark(known).where(~F.col("copy")).drop("copy")
    holders = Window.partitionBy("gram")
    shared = stage(
        _samples(singles, length)
        .withColumn("low", F.min("id").over(holders)).withColumn("high", F.max("id").over(holders))
        .where("low < high").groupBy("id").agg(F.collect_set("gram").alias("shared")), "shared-grams")
    release(docs.sparkSession, digests)
    some = checked(stage(shared.select("id"), "sharing"))
    release(docs.sparkSession)
    regions = stage(_regions(singles.join(some, "id", "left_semi").join(shared, "id"), length), "regions")
    release(docs.sparkSession, shared)

    crowded = checked(_heavy(regions, "crowded-grams"))
    cuts = stage(_cuts(
        regions.join(crowded, "gram", "left_anti").withColumnRenamed("gram", "key"), length), "cuts")
    release(docs.sparkSession)

    common = regions.join(crowded, "gram").withColumn("rid", F.unhex(F.md5("region")))
    distinct = stage(common.groupBy("gram", "rid").agg(
        F.first("region").alias("region"), F.min("id").alias("owner")), "distinct-regions")
    release(docs.sparkSession)
    places = stage(common.select("rid", "id", "start"), "places")
    release(docs.sparkSession, regions)
    heavy = checked(_heavy(distinct, "heavy-grams"))
    usual = distinct.join(heavy, "gram", "left_anti").select(
        F.col("gram").alias("key"), "rid", F.lit(0).cast("long").alias("offset"), "owner", "region")
    windows = stage(_windows(distinct.join(heavy, "gram"), length), "crowded-windows")
    verdicts = stage(
        _verdicts(usual, length).unionByName(_crowded_verdicts(windows)), "verdicts")
    release(docs.sparkSession, windows, distinct)

    runs = (
        _removed(places.join(verdicts, "rid").select(
            "id", (F.col("start") + F.col("offset")).alias("start"), "owners", "counts"))
        .unionByName(cuts)
        .groupBy("id").agg(F.collect_list(F.struct("first", "last")).alias("runs")))
    runs = stage(runs, "removed-runs")
    release(docs.sparkSession, places, verdicts, cuts)
    touched = checked(stage(runs.select("id"), "touched"))
    marked = with_copy_mark(texts)
    plain = marked.join(touched, "id", "left_anti").withColumn(
        "runs", F.lit(None).cast("array<struct<first:bigint,last:bigint>>"))
    cut = marked.join(touched, "id", "left_semi").join(runs, "id")
    order = ["id", "text", "runs", "copy"]
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        _kept(plain.select(order).unionByName(cut.select(order)), length, "long")
        .withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col))
