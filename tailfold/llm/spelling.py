"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

One inserted code point raises one letter count by one, one replaced code point raises one count and
lowers another, so near words lie within an L1 distance of two.  Words of one length are cut into
cells by a k-d tree over their letter counts; every word goes into its own cell and asks the cells of
its own length (one count up, one down) and of the next length (one count up) whose box is that near.
A task holds the words of one cell in a k-d tree of its own, prunes boxes in the same way and compares
the letters in order with what is left.  Each word answers with its number of near words and the best
of them, so near pairs never become rows.

The cells are placed by a sample of about ``SAMPLE_WORDS`` words, chosen by hash; all words are indexed
and asked for.  A cell that holds more than ``CELL_WORDS`` words all the same (equal letter counts cannot be
split) is dealt into parts by hash, and all parts are asked.

Defined results: a null text has no words; a null id counts as empty before the colon; repeated rows
count as often as they come; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailfold.session import release, stage

LEAST_LETTERS = 7
LEAST_COUNT = 2
FORM_RATIO = 10
#: One deletion in so many runs.
SLIP = 31

SAMPLE_WORDS = 100_000
CELL_WORDS = 20_000
LEAF_WORDS = 64
QUERY_WORDS = 1 << 16
#: Word pairs compared at a time.
PAIRS = 1 << 20

LETTERS = "a-zÀ-ÿ"
_DIMS = np.zeros(256, np.int64)
_DIMS[97:123] = np.arange(26)
_DIMS[0xC0:0x100] = np.arange(26, 90)
N_DIMS = 90


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of all words with enough letters and occurrences (built-in functions only).

    Runs shorter than LEAST_LETTERS cannot become words, as a slip only shortens them.
    """
    upper = "".join(map(chr, range(65, 91)))
    run = F.explode(F.regexp_extract_all(
        F.col(text_col), F.lit(f"[A-Z{LETTERS}]{{{LEAST_LETTERS},}}+"), F.lit(0)))
    runs = docs.select(
        F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":")).alias("_head"),
        run.alias("_run"))
    hashed = runs.select("_head", F.translate("_run", upper, upper.lower()).alias("_run")).select(
        "_run", F.crc32(F.concat("_head", "_run").cast("binary")).alias("_h"))
    word = F.expr(
        f"CASE WHEN _h % {SLIP} <> 0 THEN _run ELSE "
        "concat(left(_run, cast(_h % char_length(_run) AS int)),"
        " substr(_run, cast(_h % char_length(_run) AS int) + 2)) END")
    return (hashed.select(word.alias("word")).where(F.char_length("word") >= LEAST_LETTERS)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT))


def letter_counts(letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Words x letters; ``letters`` are the Latin-1 bytes of all words after one another."""
    rows = np.repeat(np.arange(len(lengths)), lengths)
    flat = np.bincount(rows * N_DIMS + _DIMS[letters], minlength=len(lengths) * N_DIMS)
    return flat.reshape(len(lengths), N_DIMS).astype(np.int32)


class KdTree:
    """A k-d tree over integer points; a node keeps those with ``point[dim] <= at`` on its left."""

    def __init__(self, points: np.ndarray, leaf_size: float):
        # dim, at, left, right; a leaf has dim -1 and its number as ``at``
        self.nodes: list[tuple[int, int, int, int]] = []
        self.members: list[np.ndarray] = []
        todo = [(np.arange(len(points)), -1, 0)]
        while todo:  # no recursion: outliers can make a path long
            own, parent, side = todo.pop()
            node = len(self.nodes)
            if parent >= 0:
                above = list(self.nodes[parent])
                above[side] = node
                self.nodes[parent] = tuple(above)
            split = self._split(points[own]) if len(own) > leaf_size else None
            if split is None:
                self.nodes.append((-1, len(self.members), -1, -1))
                self.members.append(own)
                continue
            dim, at = split
            self.nodes.append((dim, at, -1, -1))
            below = points[own, dim] <= at
            todo += [(own[below], node, 2), (own[~below], node, 3)]

    @staticmethod
    def _split(points: np.ndarray) -> tuple[int, int] | None:
        """The dimension of largest variance, at its median."""
        dim = int(points.var(axis=0).argmax())
        values = points[:, dim]
        low, high = int(values.min()), int(values.max())
        if low == high:
            return None
        at = int(np.median(values))
        below, up_to = (values < at).mean(), (values <= at).mean()
        if at > low and abs(below - 0.5) <= abs(up_to - 0.5):
            at -= 1
        return dim, min(at, high - 1)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        leaves = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, own = todo.pop()
            dim, at, left, right = self.nodes[node]
            if dim < 0:
                leaves[own] = at
                continue
            below = points[own, dim] <= at
            todo += [(left, own[below]), (right, own[~below])]
        return leaves

    def reached(self, points: np.ndarray, ups: int, downs: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaf number and the points that reach its box with counts raised ``ups`` and lowered
        ``downs`` times."""
        zeros = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)), zeros, zeros, {}, {})]
        while todo:
            node, own, up, down, low, high = todo.pop()
            dim, at, left, right = self.nodes[node]
            if dim < 0:
                yield at, own
                continue
            values = points[own, dim]
            lower = np.maximum(values - at, 0)
            if dim in high:  # the path asks for part of it already
                lower = lower - np.maximum(values - high[dim], 0)
            lower = lower + down
            kept = lower <= downs
            if kept.any():
                todo.append((left, own[kept], up[kept], lower[kept], low, {**high, dim: at}))
            rise = np.maximum(at + 1 - values, 0)
            if dim in low:
                rise = rise - np.maximum(low[dim] - values, 0)
            rise = rise + up
            kept = rise <= ups
            if kept.any():
                todo.append((right, own[kept], rise[kept], down[kept], {**low, dim: at + 1}, high))


def fit_cells(words: DataFrame) -> dict[int, KdTree]:
    """A tree for every word length in the sample; their leaves are the cells of that length."""
    total = words.count()
    share = math.ceil(SAMPLE_WORDS / max(total, 1) * (1 << 30))
    rows = words.select("word").where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < share).collect()
    by_length: dict[int, list[str]] = {}
    for row in rows:
        by_length.setdefault(len(row["word"]), []).append(row["word"])
    leaf_size = CELL_WORDS * len(rows) / max(total, 1)
    trees = {
        length: KdTree(letter_counts(
            np.frombuffer("".join(own).encode("latin-1"), np.uint8), np.full(len(own), length)), leaf_size)
        for length, own in by_length.items()}
    for tree in trees.values():
        tree.members = []  # tasks need the cells, not the sample
    return trees


def _batch(batch: pa.RecordBatch, place: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Objects, letters and lengths of a column of words."""
    own = batch.column(place).to_pylist()
    lengths = np.fromiter(map(len, own), np.int64, len(own))
    return np.array(own, object), np.frombuffer("".join(own).encode("latin-1"), np.uint8), lengths


def _celled(trees: dict[int, KdTree]):
    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, letters, lengths = _batch(batch, 0)
            counts = letter_counts(letters, lengths)
            cells = np.zeros(len(own), np.int64)
            for length in np.unique(lengths):
                if length in trees:
                    here = np.flatnonzero(lengths == length)
                    cells[here] = trees[length].leaf_of(counts[here])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lengths), pa.array(cells)],
                ["word", "n", "length", "cell"])
    return celled


def _asked(trees: dict[int, KdTree], sizes: dict[tuple[int, int], int]):
    """Rows of every word for its own place (role 0) and for the places that it asks (role 1)."""
    parts = {key: -(-size // CELL_WORDS) for key, size in sizes.items()}

    def reaches(length: int, counts: np.ndarray, downs: int) -> Iterator[tuple[int, np.ndarray]]:
        if length in trees:
            yield from trees[length].reached(counts, 1, downs)
        elif (length, 0) in sizes:  # too few for the sample: one cell
            yield 0, np.arange(len(counts))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, letters, lengths = _batch(batch, 0)
            cells = batch.column(3).to_numpy()
            bounds = np.concatenate([[0], np.cumsum(lengths)])
            hashes = np.add.reduceat(
                letters.astype(np.int64) * (1 + np.arange(len(letters)) - np.repeat(bounds[:-1], lengths)),
                bounds[:-1]) if len(own) else bounds[:0]
            count = np.array([parts[key] for key in zip(lengths.tolist(), cells.tolist())], np.int64)
            part = hashes % np.maximum(count, 1)
            rows = [(np.arange(len(own)), lengths, cells, part, np.zeros(len(own), np.int64))]
            counts = letter_counts(letters, lengths)
            for length in np.unique(lengths):
                here = np.flatnonzero(lengths == length)
                for there, downs in ((length, 1), (length + 1, 0)):
                    for cell, hit in reaches(there, counts[here], downs):
                        hit = here[hit]
                        for p in range(parts.get((there, cell), 0)):
                            to = hit if there > length else hit[(cells[hit] != cell) | (part[hit] != p)]
                            rows.append((to, np.full(len(to), there), np.full(len(to), cell),
                                         np.full(len(to), p), np.ones(len(to), np.int64)))
            at, there, cell, p, role = (np.concatenate(c) for c in zip(*rows))
            for first in range(0, len(at), QUERY_WORDS):
                cut = slice(first, first + QUERY_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at[cut])), batch.column(1).take(pa.array(at[cut])),
                     pa.array(there[cut]), pa.array(cell[cut]), pa.array(p[cut]), pa.array(role[cut])],
                    ["word", "n", "length", "cell", "part", "role"])
    return asked


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words of ``a`` and ``b`` (positions x words, one length) differ at exactly one position."""
    differ = np.zeros((a.shape[1], b.shape[1]), np.uint8 if len(a) < 256 else np.int32)
    for one, other in zip(a, b):
        differ += one[:, None] != other[None, :]
    return differ == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words of ``b`` are words of ``a`` with one code point more."""
    size, shape = len(a), (a.shape[1], b.shape[1])
    kind = np.uint8 if size < 255 else np.int32
    same, equal = np.ones(shape, bool), np.zeros(shape, kind)
    for p in range(size):
        same &= a[p][:, None] == b[p][None, :]
        equal += same
    same[:] = True
    for p in range(size):
        same &= a[size - 1 - p][:, None] == b[size - p][None, :]
        equal += same
        # both runs may overlap; beyond the length of ``a`` it makes no difference
        np.minimum(equal, size, out=equal)
    return equal == size


def _rank(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places by falling n, then by code points."""
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    return rank


class _Cell:
    """The words of one place in a k-d tree."""

    def __init__(self, words: np.ndarray, n: np.ndarray, length: int):
        self.words, self.n, self.length = words, n, length
        letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        lengths = np.full(len(words), length)
        self.counts = letter_counts(letters, lengths)
        self.tree = KdTree(self.counts, LEAF_WORDS)
        self.letters = letters.reshape(-1, length).T
        self.leaves = [(own, np.ascontiguousarray(self.letters[:, own])) for own in self.tree.members]
        self.rank = _rank(words, n)
        self.by_rank = np.argsort(self.rank)

    def near(self, words: np.ndarray, n: np.ndarray, size: int):
        """Answers for asking words of one size, and for the cell's words if those are shorter."""
        letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        counts = letter_counts(letters, np.full(len(words), size))
        letters = np.ascontiguousarray(letters.reshape(-1, size).T)
        same = size == self.length
        test = one_replaced if same else one_inserted
        asking, found = [], []
        for leaf, hit in self.tree.reached(counts, 1, 1 if same else 0):
            own, theirs = self.leaves[leaf]
            step = max(PAIRS // max(len(own), 1), 1)
            for first in range(0, len(hit), step):
                some = hit[first:first + step]
                a, b = np.nonzero(test(letters[:, some], theirs))
                asking.append(some[a])
                found.append(own[b])
        if not asking:
            return
        asking, found = np.concatenate(asking), np.concatenate(found)
        yield from self._answers(words, asking, self.rank[found], self.by_rank, self.words, self.n)
        if not same:
            rank = _rank(words, n)
            yield from self._answers(self.words, found, rank[asking], np.argsort(rank), words, n)

    @staticmethod
    def _answers(words, at, ranks, by_rank, others, n):
        if not len(at):
            return
        times = np.bincount(at, minlength=len(words))
        best = np.full(len(words), len(others), np.int64)
        np.minimum.at(best, at, ranks)
        have = np.flatnonzero(times)
        best = by_rank[best[have]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words[have], pa.string()), pa.array(times[have]), pa.array(n[best]),
             pa.array(others[best], pa.string())], ["word", "n_near", "best_n", "best"])


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by place, the place's own words first; only those and QUERY_WORDS asking ones are held."""
    place, cell, held, size = None, None, {}, 0

    def flush(role: int):
        nonlocal cell, size
        own, size = dict(held), 0
        held.clear()
        for length, pairs in own.items():
            words = np.concatenate([w for w, _ in pairs])
            n = np.concatenate([c for _, c in pairs])
            if role == 0:
                cell = _Cell(words, n, length)
            if cell is not None:  # no word may have been dealt to this part
                yield from cell.near(words, n, length)

    last_role = 0
    for batch in batches:
        own, _, lengths = _batch(batch, 0)
        n = batch.column(1).to_numpy()
        keys = np.stack([batch.column(i).to_numpy() for i in (2, 3, 4, 5)], 1)
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for first, last in zip([0, *edges], [*edges, len(own)]):
            if first == last:
                continue
            *here, role = keys[first].tolist()
            if here != place or role != last_role:
                yield from flush(last_role)
            if here != place:
                place, cell = here, None
            last_role = role
            for length in np.unique(lengths[first:last]):
                mine = first + np.flatnonzero(lengths[first:last] == length)
                held.setdefault(int(length), []).append((own[mine], n[mine]))
            size += last - first
            if role and size >= QUERY_WORDS:
                yield from flush(role)
    yield from flush(last_role)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best`` for the staged ``word, n``; ``best`` is a struct of ``less`` (minus its
    n) and ``word``.  Words without near words are absent."""
    trees = fit_cells(words)
    celled = stage(words.select("word", "n").mapInArrow(
        _celled(trees), "word string, n long, length long, cell long"), "spelling-cells")
    sizes = {(r["length"], r["cell"]): r["count"]
             for r in celled.groupBy("length", "cell").count().collect()}
    places = sum(-(-size // CELL_WORDS) for size in sizes.values())
    asked = celled.mapInArrow(
        _asked(trees, sizes), "word string, n long, length long, cell long, part long, role long")
    key = ("length", "cell", "part")
    answers = (asked.repartition(max(2 * places, 1), *key).sortWithinPartitions(*key, "role")
               .mapInArrow(_answered, "word string, n_near long, best_n long, best string"))
    near = stage(answers.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best")),
        "spelling-near")
    release(words.sparkSession, celled)
    return near


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for the staged ``word, form``: forms followed to the last.

    A form is FORM_RATIO times as frequent as its word, so chains are short; every step doubles them.
    """
    current = forms.select("word", F.col("form").alias("root"))
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        following = stage(current.join(further, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "spelling-roots")
        current = following.select("word", "root")
        if following.where("_moved").isEmpty():
            return current


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words of ``docs``."""
    words = stage(vocabulary(docs, id_col, text_col), "spelling-words")
    near = near_words(words)
    has_form = -F.col("best.less") >= FORM_RATIO * F.col("n")
    known = stage(words.join(near, "word", "left").select(
        "word", F.when(has_form, F.col("best.word")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, -F.col("best.less")).alias("form_n")), "spelling-forms")
    last = roots(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
