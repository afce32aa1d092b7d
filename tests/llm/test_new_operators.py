"""Whitening, spelling variants and fingerprints against brute force, on small fixtures."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from tailfold.llm import exact_dedup, fingerprints, mixing, neighbours, pieces, spelling, whitening

DATA = "/root/testdata/sf0.001"

# ---------------------------------------------------------------- whitening


def spectrum(d, kind, rng):
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    e = {"clustered": 57 + 10 * rng.random(d), "decay": 1 / np.arange(1, d + 1) ** 2,
         "equal": np.full(d, 3.0), "flat": np.where(np.arange(d) < 4, 5.0, 0.0)}[kind]
    a = (q * e) @ q.T
    return (a + a.T) / 2, np.sort(e)[::-1]


@pytest.mark.parametrize("d, wanted, kind", [
    (64, 32, "clustered"), (200, 12, "decay"), (5, 32, "equal"), (60, 32, "flat"), (1, 1, "equal"), (90, 30, "equal")])
def test_leading_pairs(d, wanted, kind):
    a, expected = spectrum(d, kind, np.random.default_rng(d))
    values, vectors = whitening.leading_pairs(lambda u: a @ u, d, wanted)
    k = min(d, wanted)
    assert values.shape == (k,) and np.abs(values - expected[:k]).max() < 1e-13 * expected[0]
    assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() < 2e-13 * expected[0]
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(5)
    a, _ = spectrum(20, "clustered", rng)
    a -= 62 * np.eye(20)
    right = rng.standard_normal((20, 3))
    right[:, 1] = 0
    assert np.abs(a @ whitening.minres(lambda v: a @ v, right, 20) - right).max() < 1e-8


def whitened_rows(spark, rows, schema="vec_id long, embedding array<double>, component string, _x int", **more):
    return whitening.whitened(spark.createDataFrame(rows, schema).repartition(3), **more).collect()


def test_whitening(spark):
    rng = np.random.default_rng(2)
    data = rng.standard_normal((300, 6)) @ rng.standard_normal((6, 6)) * 40
    rows = [(i, v.tolist(), "clash", 7) for i, v in enumerate(data)]
    rows += [(1, data[1].tolist(), None, None), (None, data[2].tolist(), None, None)]
    rows += [(900, None, "x", 1), (901, [1.0, None, 2.0, 3.0, 4.0, 5.0], "x", 1),
             (902, [float("nan")] * 6, "x", 1), (903, [float("inf")] + [0.0] * 5, "x", 1),
             (904, [1.0, 2.0], "x", 1), (905, [], "x", 1), (906, [1e300] * 6, "x", 1)]
    kept = [(i, v) for i, v, *_ in rows[:302]]
    x = np.floor(64 * np.array([v for _, v in kept])).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = (n * x - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    out = whitened_rows(spark, rows)
    assert len(out) == 302 * 6 and {r.n for r in out} == {n}
    by_row = {}
    for r in out:
        by_row.setdefault(r.vec_id, []).append(r)
    assert set(by_row) == {i for i, _ in kept}
    assert len(by_row[1]) == 12
    signs = {}
    for (i, _), own in zip(kept, c):
        for r in by_row[i]:
            expected = own @ u[:, r.component - 1] / np.sqrt(e[r.component - 1])
            signs.setdefault(r.component, np.sign(expected * r.whitened))
            assert abs(r.whitened * signs[r.component] - expected) < 1e-8
            assert abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-9
            assert r.identity_error < 1e-9
    deviations = ((n * x - s) ** 2).sum(1)
    assert all(r.deviation == deviations[k] for k, (i, _) in enumerate(kept) for r in by_row[i])


def test_whitening_of_flat_tables(spark):
    assert whitened_rows(spark, []) == []
    assert whitened_rows(spark, [(1, [1.0, 2.0], "", 1)]) == []
    assert whitened_rows(spark, [(1, None, "", 1)]) == []
    out = whitened_rows(spark, [(i, [float(i % 3), 5.0, float(i % 3)], "", 1) for i in range(9)])
    assert len(out) == 9 and {r.component for r in out} == {1}
    assert all(abs(r.explained - 1) < 1e-12 for r in out)


def test_deviations_beyond_a_long():
    import pyarrow as pa
    centre = whitening.Centre(1 << 40, [5 << 40, 3])
    column = pa.array([[6, 0], [1 << 40, 0]], pa.list_(pa.int64()))
    expected = [((1 << 40) * 6 - (5 << 40)) ** 2 + 9, None]
    assert centre.deviations(column) == [expected[0] if expected[0] < 1 << 63 else None, None]
    small = whitening.Centre(7, [11, 3])
    assert small.deviations(pa.array([[2, 1]], pa.list_(pa.int64()))) == [3 ** 2 + 4 ** 2]


# ---------------------------------------------------------------- spelling


def brute_words(docs):
    counts = {}
    lower = {c: c + 32 for c in range(65, 91)}
    for doc_id, text in docs:
        run = ""
        for char in (text or "") + " ":
            if char.isascii() and char.isalpha() or "À" <= char <= "ÿ":
                run += char
                continue
            if run:
                word = run.translate(lower)
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
                if h % 31 == 0:
                    word = word[:h % len(word)] + word[h % len(word) + 1:]
                counts[word] = counts.get(word, 0) + 1
            run = ""
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(docs):
    words = brute_words(docs)
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and is_near(v, w)] for w in words}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None))
    return sorted(out)


def spelled(rng):
    base = ["colours", "theatre", "naïveté", "éclairs", "straßen", "a" * 9, "banana" * 2, "lettres", "settler"]
    docs = []
    for i in range(120):
        text = []
        for _ in range(60):
            word = rng.choice(base[:rng.randrange(1, len(base) + 1)])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                p = rng.randrange(len(word))
                word = rng.choice([word[:p] + word[p + 1:], word[:p] + rng.choice("aeÉß×") + word[p:],
                                   word[:p] + rng.choice("aeo") + word[p + 1:]])
            text.append(rng.choice([word, word, word.upper() if word.isascii() else word]))
        docs.append((i, rng.choice([" ", "-", "1", "ſ", "中"]).join(text)))
    long = "xyz" * 200
    docs += [(5, None), (None, "colours colours"), (7, ""), (8, " ".join(["abcdefgh"] * 300)),
             (9, f"{long} {long}q {long} {long}q {'w' * 254} {'w' * 255} {'w' * 254} {'w' * 255}"), (9, docs[9][1])]
    return docs


@pytest.mark.parametrize("cell, leaf, queries", [(20_000, 64, 1 << 16), (15, 4, 10), (3, 2, 7)])
def test_spelling(spark, monkeypatch, cell, leaf, queries):
    monkeypatch.setattr(spelling, "CELL_WORDS", cell)
    monkeypatch.setattr(spelling, "LEAF_WORDS", leaf)
    monkeypatch.setattr(spelling, "QUERY_WORDS", queries)
    docs = spelled(random.Random(4))
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    got = sorted(tuple(r) for r in spelling.variants(frame.repartition(5)).collect())
    assert got == brute_variants(docs)


def test_spelling_of_a_small_sample(spark, monkeypatch):
    """Lengths outside the sample have one place each, dealt into parts."""
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", 3)
    monkeypatch.setattr(spelling, "CELL_WORDS", 5)
    docs = spelled(random.Random(8))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(tuple(r) for r in spelling.variants(frame).collect()) == brute_variants(docs)
    assert spelling.variants(frame.where("doc_id < 0")).collect() == []


def test_letter_tests_and_tree_reach_all():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(200)})
    for a, b in itertools.product(words, repeat=2):
        x = np.frombuffer(a.encode(), np.uint8)[:, None]
        y = np.frombuffer(b.encode(), np.uint8)[:, None]
        if len(a) == len(b):
            assert spelling.one_replaced(x, y)[0, 0] == (a != b and is_near(a, b))
        if len(a) + 1 == len(b):
            assert spelling.one_inserted(x, y)[0, 0] == is_near(a, b)
    steps = np.minimum(np.arange(3000, dtype=np.int32)[:, None] ** 2, 1 << 22)
    assert len(spelling.KdTree(steps, 1).members) > 2000  # however deep
    points = np.random.default_rng(1).integers(0, 4, (300, 5)).astype(np.int32)
    tree = spelling.KdTree(points, 4)
    leaves = tree.leaf_of(points)
    for ups, downs in ((1, 1), (1, 0)):
        reached = {(leaf, p) for leaf, own in tree.reached(points, ups, downs) for p in own.tolist()}
        for p in range(300):
            rise = np.maximum(points - points[p], 0).sum(1)
            fall = np.maximum(points[p] - points, 0).sum(1)
            for q in np.flatnonzero((rise <= ups) & (fall <= downs)):
                assert (leaves[q], p) in reached


# ---------------------------------------------------------------- fingerprints


def brute_level(window):
    counts = np.bincount(np.frombuffer(window, np.uint8))
    said = fingerprints._TERMS[counts[counts > 0]].sum()
    return int((fingerprints._MOST - said) * (fingerprints.LEVELS - 1) // fingerprints._MOST)


def brute_selected(text, ranks):
    if not text:
        return []
    frame = bytes(fingerprints.WINDOW - 1)
    data = frame + text + frame
    own = [ranks[brute_level(data[i:i + fingerprints.WINDOW])] for i in range(len(data) - fingerprints.WINDOW + 1)]
    score = [0] * len(own)
    for first in range(1 - fingerprints.RUN, len(own)):
        run = range(max(first, 0), min(first + fingerprints.RUN, len(own)))
        score[min(run, key=lambda i: (own[i], i))] += 1
    chosen = [i for i, s in enumerate(score) if s >= fingerprints.LEAST_SCORE]
    if len(chosen) < fingerprints.LEAST_FEATURES:
        scored = [i for i, s in enumerate(score) if s]
        chosen = sorted(sorted(scored, key=lambda i: (-score[i], i))[:fingerprints.LEAST_FEATURES])
    return [data[i:i + fingerprints.WINDOW] for i in chosen]


@pytest.mark.parametrize("chunk", [1 << 21, 150])
def test_selected_windows(monkeypatch, chunk):
    monkeypatch.setattr(fingerprints, "CHUNK_BYTES", chunk)
    rng = random.Random(6)
    ranks = fingerprints.ranks_of(np.array([rng.randrange(5) for _ in range(fingerprints.LEVELS)]))
    for size in (0, 1, 2, 31, 32, 33, 64, 200, 900):
        for letters in ("a", "ab", "abcdefghijklmnop qrst"):
            text = "".join(rng.choice(letters) for _ in range(size)).encode()
            data, places = fingerprints.selected(text, ranks)
            assert [data[p:p + fingerprints.WINDOW].tobytes() for p in places] == brute_selected(text, ranks)


def brute_likeness(a, b):
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 1.0 if not len(b) else 0.0
    bits = [[int(x) for x in np.unpackbits(row)] for row in (*a, *b)]
    total = 0
    for x in bits[:len(a)]:
        best = 0
        for y in bits[len(a):]:
            chance = sum(x) * sum(y) / len(x)
            best = max(best, (sum(p & q for p, q in zip(x, y)) - chance) / max(min(sum(x), sum(y)) - chance, 1e-9))
        total += best
    return min(total / len(a), 1.0)


def test_fingerprints(spark):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghiklmnoprstuvé") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 40, 120])))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, docs[7][1]), (103, "x" * 3000), (7, docs[7][1]), (None, "no id"),
             (104, " ".join(rng.choice(words) for _ in range(9000))), (-5, "😀é" * 20)]
    frame = spark.createDataFrame([(i, t, 1, "clash") for i, t in docs],
                                  "doc_id long, text string, edge int, fingerprint string").repartition(6)
    rows = fingerprints.compared(frame).collect()
    assert len(rows) == len(docs)
    counts = np.zeros(fingerprints.LEVELS, np.int64)
    for _, text in docs:
        if text:
            data = bytes(fingerprints.framed(text.encode()))
            for i in range(0, len(data) - fingerprints.WINDOW + 1):
                counts[brute_level(data[i:i + fingerprints.WINDOW])] += 1
    ranks = fingerprints.ranks_of(counts)
    assert (fingerprints.fit(frame) == ranks).all()
    ordered = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is None, -(r[0] or 0)))
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        made = fingerprints.fingerprint(text.encode(), ranks)
        other = fingerprints.fingerprint(edited.encode(), ranks)
        follower = fingerprints.fingerprint(after.encode(), ranks)
        assert any(
            (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) ==
            (len(text), hashlib.sha256(edited.encode()).hexdigest(), made[0], other[0])
            and abs(r.near_edited - brute_likeness(made[1], other[1])) < 1e-9
            and abs(r.near_next - brute_likeness(made[1], follower[1])) < 1e-9 for r in by_id[doc_id]), doc_id
    assert by_id[102][0].fingerprint == by_id[7][0].fingerprint
    assert fingerprints.compared(frame.where("edge = 2")).collect() == []
    alone = fingerprints.compared(frame.where("doc_id = 3")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_likeness_tells_edited_texts_from_others(spark):
    rows = entry.queries()["op13_fingerprints"](spark, DATA).collect()
    assert len(rows) == 200 == len({r.doc_id for r in rows})
    assert sum(r.near_edited > r.near_next + 0.1 for r in rows) >= 190
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


# ---------------------------------------------------------------- clashing names and sizes


def clashing(spark, names):
    rows = [(i, f"src{i % 3}", f"text {i % 5}", *[f"{n}{i}" for n in names]) for i in range(40)]
    schema = ", ".join(["doc_id long", "source string", "text string", *(f"`{n}` string" for n in names)])
    return spark.createDataFrame(rows, schema), rows


def test_mixing_keeps_columns_of_any_name(spark):
    names = ["_lane", "_key", "_bucket", "_rank", "_before", "_first", "_of", "doc", "id", "_start", "_period"]
    frame, rows = clashing(spark, names)
    made = mixing.schedule(frame, {"src0": 2, "src1": 1}, 1, 3)
    assert made.columns == [*frame.columns, "lane", "block", "slot", "position"]
    assert sorted(tuple(r)[:len(rows[0])] for r in made.collect()) == rows
    own = frame.withColumnRenamed("_lane", "block").withColumnRenamed("_key", "position")
    made = mixing.schedule(own, {"src0": 2, "src1": 1}, 1, 3)
    assert len(set(made.columns)) == len(made.columns) and made.schema["position"].dataType.simpleString() == "bigint"
    mixed = mixing.mixed(own, {"src0": 2, "src1": 1}, 1, 3)
    assert mixed.columns == own.columns and sorted(tuple(r) for r in mixed.collect()) == rows


def test_exact_dedup_keeps_columns_of_any_name(spark):
    names = ["_digest", "_row", "_winner", "_place", "_doc", "_item", "_n", "_group_size"]
    frame, rows = clashing(spark, names)
    kept = exact_dedup.deduplicate(frame)
    assert kept.columns == frame.columns
    assert sorted(tuple(r) for r in kept.collect()) == rows[:5]


def test_pieces_keep_columns_of_any_name(spark):
    frame, rows = clashing(spark, ["id", "c0", "ids"])
    made = pieces.encoded(frame, extra=("id", "c0", "source")).collect()
    assert sorted((r.doc_id, r.id, r.c0, r.source) for r in made) == [(r[0], r[3], r[4], r[1]) for r in rows]


def test_cosine_of_very_large_and_small_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 4))
    sizes = [1e200, 1e-200, 1.0, 1e-310]
    rows = [(i, (v * sizes[i % 4]).tolist()) for i, v in enumerate(base)]
    found = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=10).collect()
    units = np.array([v for _, v in rows])
    units /= np.abs(units).max(1, keepdims=True)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    for r in found:
        cosines = units @ units[r.query_id]
        order = [i for i in np.argsort(-cosines) if i != r.query_id]
        assert r.vec_id == order[r.rank - 1] and abs(r.score - cosines[r.vec_id]) < 1e-12
    assert len(found) == 30
