"""Document fingerprints by improbable features: rare byte windows in chained Bloom filters.

A feature is a window of ``WINDOW`` bytes (the text is framed by zero bytes, so short texts have
windows too).  Its rarity comes from its entropy: a table says how many windows of the whole corpus
have each entropy level, and the rarer the level the better the rank.  In every run of ``RUN``
neighbouring windows the leftmost of best rank scores; windows that score often enough are selected,
in the order of the text.  Selected windows are hashed into Bloom filters of ``FILTER_BYTES`` bytes,
``FILTER_FEATURES`` to a filter, one filter after another.  The likeness of two fingerprints is the mean
over the filters of the shorter one of the best bit overlap with a filter of the other, less what
chance explains, as a share of what is possible.

Defined results: a null text is empty; a text without windows worth selecting (empty) has no filters,
and is like nothing but another such text (1).  Equal texts have equal fingerprints under one table.
Rows are ordered by falling id, then by text digest; rows without an id come last; rows repeating an
id stand next to each other, so one id should not hold a large share of all rows.  A single document
is its own next one.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailfold.llm.fixed_tables import parts_of, table_sum
from tailfold.session import stage

WINDOW = 32
RUN = 64
#: Runs of RUN in which a window must be the rarest.
LEAST_SCORE = 16
#: Texts with fewer selected windows lower the demand until they have so many (or no more windows).
LEAST_FEATURES = 16
LEVELS = 1024
#: Windows of a lower entropy (a share of LEVELS) say little; they count only where nothing else is.
PLAIN_LEVEL = 256
FILTER_BYTES = 256
FILTER_FEATURES = 160
HASHES = 5
#: Bytes of text that are held as arrays at a time.
CHUNK_BYTES = 1 << 21

_BITS = FILTER_BYTES * 8
# c * log2(c) in fixed point, so that running sums are exact.
_TERMS = np.zeros(WINDOW + 1, np.int64)
_TERMS[1:] = np.rint(np.arange(1, WINDOW + 1) * np.log2(np.arange(1, WINDOW + 1)) * (1 << 20))
_MOST = int(_TERMS[WINDOW])


def levels(data: np.ndarray) -> np.ndarray:
    """Entropy level of the window at every position of ``data`` (at least WINDOW bytes).

    Moving a window by one byte changes two counts, so the entropy is a running sum.
    """
    n = len(data)
    order = np.argsort(data, kind="stable")
    keys = data[order].astype(np.int64) * (n + WINDOW) + order
    ahead = np.searchsorted(keys, keys + WINDOW) - np.arange(n)
    count = np.empty(n, np.int64)   # of the byte here among the WINDOW bytes from here
    count[order] = ahead
    behind = np.arange(n) - np.searchsorted(keys, keys - WINDOW, "right") + 1
    before = np.empty(n, np.int64)  # of the byte here among the WINDOW bytes up to here
    before[order] = behind
    first = _TERMS[np.bincount(data[:WINDOW], minlength=256)].sum()
    leaving, entering = data[:n - WINDOW], data[WINDOW:]
    out, into = count[:n - WINDOW], before[WINDOW:]
    # a byte that leaves as its like enters changes nothing
    change = np.where(
        leaving == entering, 0,
        _TERMS[np.maximum(out - 1, 0)] - _TERMS[out] + _TERMS[into] - _TERMS[into - 1])
    sums = np.concatenate([[first], first + np.cumsum(change)])
    return ((_MOST - sums) * (LEVELS - 1) // _MOST).astype(np.int64)


def framed(text: bytes) -> np.ndarray:
    frame = bytes(WINDOW - 1)
    return np.frombuffer(frame + text + frame, np.uint8)


def _chunks(data: np.ndarray, margin: int) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of windows to work on, and the ranges of them that are final."""
    n = len(data) - WINDOW + 1
    for first in range(0, n, CHUNK_BYTES):
        last = min(first + CHUNK_BYTES, n)
        yield max(first - margin, 0), min(last + margin, n), first, last


def level_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows by entropy level of a task's texts."""
    counts = np.zeros(LEVELS, np.int64)
    for batch in batches:
        for text in batch.column(0):
            text = (text.as_py() or "").encode()
            if not text:
                continue
            data = framed(text)
            for first, last, _, _ in _chunks(data, 0):
                counts += np.bincount(levels(data[first:last + WINDOW - 1]), minlength=LEVELS)
    while counts.any():  # parts hold 32-bit counts; larger ones go out in several rows
        some = np.minimum(counts, np.iinfo(np.int32).max)
        counts -= some
        numbers, data = parts_of(some.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(data, pa.binary())], ["part", "data"])


def fit(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Rank of every entropy level by the windows of all texts, 0 for the rarest."""
    parts = docs.select(F.col(text_col)).mapInArrow(level_counts, "part int, data binary")
    return ranks_of(table_sum(parts, LEVELS))


def ranks_of(counts: np.ndarray) -> np.ndarray:
    ranks = np.empty(LEVELS, np.int64)
    ranks[np.lexsort((np.arange(LEVELS), counts))] = np.arange(LEVELS)
    ranks[:PLAIN_LEVEL] += LEVELS
    return ranks


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours (a power of two)."""
    step = 1
    while step < width:
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    return keys


def selected(text: bytes, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Framed bytes and the starts of the selected windows, in order."""
    data = framed(text)
    if not text:
        return data, np.zeros(0, np.int64)
    places, scores, best_rank = [], [], 2 * LEVELS
    for low, high, first, last in _chunks(data, 2 * RUN):
        own = ranks[levels(data[low:high + WINDOW - 1])]
        keys = np.full(len(own) + 2 * (RUN - 1), np.iinfo(np.int64).max)
        keys[RUN - 1:len(own) + RUN - 1] = own << 40 | np.arange(len(own))
        rarest = _sliding_min(keys, RUN) & ((1 << 40) - 1)
        score = np.bincount(rarest, minlength=len(own))[first - low:last - low]
        have = np.flatnonzero(score)
        places.append(first + have)
        scores.append(score[have])
        best_rank = min(best_rank, int(own.min()))
    places, scores = np.concatenate(places), np.concatenate(scores)
    telling = scores >= LEAST_SCORE
    if telling.sum() < LEAST_FEATURES:
        order = np.lexsort((places, -scores))
        telling = np.zeros(len(places), bool)
        telling[order[:LEAST_FEATURES]] = True
    return data, places[telling]


def filters(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Bloom filters of the windows at ``places``, one row of bytes each."""
    made = np.zeros((-(-len(places) // FILTER_FEATURES), FILTER_BYTES), np.uint8)
    raw = data.tobytes()
    digests = b"".join(hashlib.blake2b(raw[p:p + WINDOW], digest_size=2 * HASHES).digest()
                       for p in places.tolist())
    bits = np.frombuffer(digests, "<u2").reshape(-1, HASHES).astype(np.int64) % _BITS
    row = np.repeat(np.arange(len(places)) // FILTER_FEATURES, HASHES)
    bits = bits.ravel()
    np.bitwise_or.at(made, (row, bits >> 3), (1 << (bits & 7)).astype(np.uint8))
    return made


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Mean over the shorter chain of the best normalised overlap with the other, 0 to 1."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 1.0 if not len(b) else 0.0
    words_a, words_b = a.view(np.uint64), b.view(np.uint64)
    full_b = np.bitwise_count(words_b).sum(1, dtype=np.int64)
    total = 0.0
    for own in words_a:
        full = int(np.bitwise_count(own).sum())
        both = np.bitwise_count(own & words_b).sum(1, dtype=np.int64)
        chance = full * full_b / _BITS
        room = np.minimum(full, full_b) - chance
        total += max(float(((both - chance) / np.maximum(room, 1e-9)).max()), 0.0)
    return min(total / len(a), 1.0)


def fingerprint(text: bytes, ranks: np.ndarray) -> tuple[str, np.ndarray]:
    """Printable fingerprint (number of filters, then their bytes) and the filters."""
    made = filters(*selected(text, ranks))
    return f"{len(made)}:{base64.b64encode(made.tobytes()).decode()}", made


NAMES = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
_ANSWER = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
          "near_edited double, near_next double"
_FIRST, _LAST = 1, 2


def _answer(text: str, own, after: str, after_made: np.ndarray, ranks: np.ndarray) -> tuple:
    """What is said of a text with the fingerprint ``own`` that ``after`` follows."""
    half = len(text) // 2
    edited = (text[:len(text) - half] + after[:half]).encode()
    printed, made = fingerprint(edited, ranks)
    return (len(text), hashlib.sha256(edited).hexdigest(), own[0], printed,
            likeness(own[1], made), likeness(own[1], after_made))


def _record(types: list[pa.DataType], names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _streamed(ranks: np.ndarray):
    """Rows come in falling order; all but the last of a partition are answered.

    The first and the last row of every partition go on with their texts (``edge``)."""
    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous = part = None
        kinds = [pa.int64(), pa.int32(), None, pa.string(), pa.int64(), pa.string(), pa.string(),
                 pa.string(), pa.float64(), pa.float64()]
        names = ["part", "edge", "_id", "_text", *NAMES]
        nothing = (None,) * len(NAMES)
        for batch in batches:
            kinds[2] = batch.column(1).type
            rows = []
            for part, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                own = fingerprint(text.encode(), ranks)
                if previous is None:
                    rows.append((part, _FIRST, doc_id, text, *nothing))
                else:
                    rows.append((part, 0, previous[0], None,
                                 *_answer(*previous[1:], text, own[1], ranks)))
                previous = doc_id, text, own
            yield _record(kinds, names, rows)
        if previous is not None:
            yield _record(kinds, names, [(part, _LAST, previous[0], previous[1], *nothing)])
    return streamed


def _crossing(ranks: np.ndarray):
    """Last rows of partitions with the first row after them: ``_id, _text, _after``."""
    def crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for batch in batches:
            kinds[0] = batch.column(0).type
            rows = []
            for doc_id, text, after in zip(*(c.to_pylist() for c in batch.columns)):
                after_made = fingerprint(after.encode(), ranks)[1]
                rows.append((doc_id, *_answer(
                    text, fingerprint(text.encode(), ranks), after, after_made, ranks)))
            yield _record(kinds, ["_id", *NAMES], rows)
    return crossing


def compared(docs: DataFrame, ranks: np.ndarray | None = None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Every document with its fingerprint, that of its edited text, and both likenesses.

    The edited text is the first half and as much of the next document, by falling id; the first
    document follows the last.  Texts are shuffled once, into ranges of ids; what crosses from one range
    to the next is two rows a partition.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    ranks = fit(own, "_text") if ranks is None else ranks
    order = (F.col("_id").desc_nulls_last(), F.xxhash64("_text"))
    id_type = own.schema["_id"].dataType.simpleString()
    rows = stage(
        own.repartitionByRange(*order).sortWithinPartitions(*order)
        .select(F.spark_partition_id().cast("long").alias("part"), "_id", "_text")
        .mapInArrow(_streamed(ranks), f"part long, edge int, _id {id_type}, _text string, {_ANSWER}"),
        "fingerprints")
    firsts = rows.where(F.col("edge") == _FIRST)
    parts = [r["part"] for r in firsts.select("part").orderBy("part").collect()]
    following = spark.createDataFrame(
        list(zip(parts, parts[1:] + parts[:1])), "part long, after_part long")
    edges = (
        rows.where(F.col("edge") == _LAST).select("part", "_id", "_text")
        .join(F.broadcast(following), "part")
        .join(firsts.select(F.col("part").alias("after_part"), F.col("_text").alias("_after")), "after_part")
        .select("_id", "_text", "_after")
        .mapInArrow(_crossing(ranks), f"_id {id_type}, {_ANSWER}"))
    return (rows.where(F.col("edge") == 0).select("_id", *NAMES).union(edges)
            .withColumnRenamed("_id", id_col))
