"""Operators on texts against brute force, on documents with nulls, ties and repeated rows."""

import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tailfold.llm import exact_dedup, mixing, ngram_join, pieces, quality, suffix_dedup, words
from tailfold.llm import settings, sql

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string"


def corpus(seed=3, n=90):
    """Documents with exact and near copies, shared passages, blanks, long and odd texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    texts = []
    for i in range(n):
        kind = i % 9
        own = [rng.choice(vocabulary) for _ in range(rng.randint(3, 120))]
        if kind == 1 and texts:
            text = rng.choice(texts)
        elif kind == 2 and texts:
            near = (rng.choice(texts) or "a b c d e f").split(" ")
            near[rng.randrange(len(near))] = "changed"
            text = " ".join(near)
        elif kind == 3:
            text = " ".join(own) + " " + passage
        elif kind == 4 and texts:
            text = re.sub(" ", "\t\n", rng.choice(texts) or "", count=3)
        else:
            text = " ".join(own).upper() if kind == 5 else " ".join(own)
        texts.append(text)
    texts[10:14] = [None, "", " \t\n", "one"]
    texts[20] = "x " * 3000
    return [(i * 3 % 97, t, "en", rng.choice(["src0", "src1", "src9", None]), None, "clash")
            for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words_agree_with_a_pattern():
    texts = ["a  b\tc", "", None, "é ß\x0bx", "  ", "tail", "end ", "x" * 5000]
    got = []
    for part in words.slices(pa.array(texts)):
        for r in range(part.rows):
            got.append([part.data[a:b].tobytes() for a, b in zip(
                part.starts[part.bounds[r]:part.bounds[r + 1]], part.ends[part.bounds[r]:part.bounds[r + 1]])])
    assert got == [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    one, two = (next(words.slices(pa.array([t]))).hashes() for t in ("aa b aa", "b aa"))
    assert one[0] == one[2] == two[1] and one[1] == two[0] and one[0] != one[1]


def test_exact_dedup(docs, rows, empty):
    key = lambda t: re.sub("[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault(key(t), []).append(d)
    got = {r.doc_id: tuple(r)[1:] for r in exact_dedup.mark(docs).collect()}
    assert got == {d: (min(groups[key(t)]), len(groups[key(t)]), d == min(groups[key(t)]),
                       hashlib.sha256(key(t).encode()).hexdigest()) for d, t, *_ in rows}
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(map(min, groups.values()))
    assert exact_dedup.mark(empty).count() == 0 == exact_dedup.deduplicate(empty).count()


def test_exact_dedup_keeps_one_of_repeated_rows_and_of_rows_without_id(spark):
    rows = [(1, "a", None, None, None, "x")] * 40 + [(None, "b", None, None, None, "x")] * 3
    docs = spark.createDataFrame(rows + [(None, "a", None, None, None, "x")], SCHEMA)
    marked = exact_dedup.mark(docs).collect()
    assert sum(r.kept for r in marked) == 2
    assert {(r.keep_id, r.group_size) for r in marked} == {(1, 41), (None, 3)}
    assert sorted((r.doc_id, r.text) for r in exact_dedup.deduplicate(docs).collect() if r.doc_id) == [(1, "a")]
    assert exact_dedup.deduplicate(docs).count() == 2


@pytest.mark.parametrize("parts", [[1], [3, 1], [5, 3, 3, 2, 2, 1, 9], [2, 4, 6], [97, 2, 1]])
def test_a_period_never_deviates_by_a_block(parts):
    period = mixing.period_schedule(parts)
    total = sum(parts)
    for slot in range(1, len(period) + 1):
        for lane, p in enumerate(parts):
            assert abs(period[:slot].count(lane) * total - p * slot) < total
    assert all(period.count(i) * total == p * len(period) for i, p in enumerate(parts))


def test_runs_use_every_block_once():
    rng = random.Random(5)
    for _ in range(60):
        lanes = rng.randint(1, 5)
        parts, blocks = [rng.randint(1, 6) for _ in range(lanes)], [rng.randint(0, 30) for _ in range(lanes)]
        slots = {}
        for run in mixing.plan_runs(parts, blocks):
            for j in range(run.blocks):
                own = run.offsets
                slots[run.start_slot + j // len(own) * run.period + own[j % len(own)]] = (
                    run.lane, run.first + j)
        assert sorted(slots) == list(range(sum(blocks)))
        for lane in range(lanes):
            assert [b for _, (k, b) in sorted(slots.items()) if k == lane] == list(range(blocks[lane]))


def test_mixing(docs, rows, empty):
    result = mixing.schedule(docs, settings.MIX_PARTS, settings.MIX_REST_PARTS, 4, 17).collect()
    assert sorted(r.position for r in result) == list(range(len(rows)))
    assert sorted(r.doc_id for r in result) == sorted(r[0] for r in rows)
    for r in result:
        assert r.lane == (r.source if r.source in settings.MIX_PARTS else None)
    by_slot = {}
    for r in result:
        by_slot.setdefault(r.slot, set()).add((r.lane, r.block))
    assert all(len(v) == 1 for v in by_slot.values())
    ordered = mixing.mixed(docs, settings.MIX_PARTS, settings.MIX_REST_PARTS, 4, 17)
    assert ordered.columns == docs.columns
    assert [r.doc_id for r in ordered.collect()] == [
        r.doc_id for r in sorted(result, key=lambda r: r.position)]
    assert mixing.schedule(empty, {"a": 1}, 1, 4).count() == 0


def brute_links(rows, width=5, percent=75):
    sets = {}
    for d, t, *_ in rows:
        w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = ({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width
                   else {tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_ngram_join(docs, rows, empty):
    expected = brute_links(rows)
    got = {r.doc_id: tuple(r)[1:] for r in ngram_join.linked(docs).collect()}
    assert got == expected
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in expected.items() if c == d)
    assert ngram_join.linked(empty).count() == 0


def test_ngram_join_finds_copies_of_one_original(spark):
    """Copies that only their original links; borders at exactly 75 of 100."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(103)]  # 99 n-grams
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        own = list(base)
        for at in rng.sample(range(4, 99, 5), 3):
            own[at] = f"v{i}x{at}"
        rows.append((i, " ".join(own)))
    full = [(d, t, None, None, None, None) for d, t in rows + [(None, rows[0][1])]]
    got = {r.doc_id: tuple(r)[1:] for r in ngram_join.linked(spark.createDataFrame(full, SCHEMA)).collect()}
    assert got.pop(None) == (99, None)
    assert got == brute_links(full[:-1])


def test_pieces_are_exactly_the_librarys(docs, rows, empty):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    got = {r.doc_id: tuple(r)[1:] for r in pieces.encoded(docs).collect()}
    for d, text, *_ in rows:
        ids = [1, *library.encode(text or ""), 2]
        assert got[d] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(library.decode(ids).encode()).hexdigest())
    assert pieces.encoded(empty).count() == 0
    kept = pieces.encoded(docs, keep_ids=True).where("doc_id = 0").first()
    assert kept.ids == [1, *library.encode(rows[0][1]), 2]


def test_pieces_of_random_texts_and_ids():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    own = pieces.Encoder(pieces.read_vocabulary(pieces.default_model()))
    rng, vocabulary = random.Random(2), list(own.v.ids)
    makers = [
        lambda: "".join(rng.choice(" ab\n\t.▁") for _ in range(rng.randrange(60))),
        lambda: "".join(rng.choice(vocabulary) for _ in range(rng.randrange(12))),
        lambda: " " * rng.randrange(70) + rng.choice(["", "a", "the"]) + " " * rng.randrange(40),
        lambda: "".join(chr(rng.choice([rng.randrange(1, 0xD7FF), rng.randrange(0x1F300, 0x1F700)]))
                        for _ in range(rng.randrange(30))),
        lambda: rng.choice("ab0=- ") * rng.randrange(300)]
    for i in range(3000):
        text = makers[i % len(makers)]()
        ids = library.encode(text)
        assert own.encode(text) == ids
        assert own.decode([1, *ids, 2]) == library.decode([1, *ids, 2])
    for _ in range(500):
        ids = [rng.randrange(1, 32000) if rng.random() < 0.5 else rng.randrange(3, 259)
               for _ in range(rng.randrange(12))]
        assert own.decode(ids) == library.decode(ids)


def brute_repeats(rows, length):
    first, out = {}, {}
    for d, t, *_ in sorted(rows, key=lambda r: r[0]):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if first.setdefault(data[k:k + length], d) < d:
                gone[k:k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(rb"\x01+", gone))
        out[d] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("heavy", [suffix_dedup.HOT_BYTES, 200])
def test_suffix_dedup(docs, rows, empty, monkeypatch, heavy):
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", heavy)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 3000)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removed_repeats(docs).collect()}
    assert got == brute_repeats(rows, 50)
    assert suffix_dedup.removed_repeats(empty).count() == 0


def test_suffix_order_and_owners():
    rng = random.Random(4)
    for _ in range(200):
        text = np.array([rng.randrange(1, rng.choice([2, 3, 5, 300])) for _ in range(rng.randrange(150))], np.int64)
        assert suffix_dedup.suffix_order(text).tolist() == sorted(
            range(len(text)), key=lambda i: tuple(text[i:]))
    regions = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(6, 30))) for _ in range(25)]
    owners = np.array([rng.randrange(9) for _ in regions])
    least = {}
    for region, owner in zip(regions, owners):
        for i in range(len(region) - 5):
            least[region[i:i + 6]] = min(least.get(region[i:i + 6], 99), owner)
    found = suffix_dedup.least_owners(regions, owners, 6)
    assert [f.tolist() for f in found] == [
        [least[r[i:i + 6]] for i in range(len(r) - 5)] for r in regions]


def test_quality_learns_and_keeps_to_its_folds(spark):
    rng = random.Random(6)

    def text(good):
        base = ["".join(rng.choice("aeioubcdfg") for _ in range(rng.randint(2, 8))) for _ in range(80)]
        return " ".join(base if good else [w + rng.choice(["***", "%%%", "&&&"]) for w in base])

    rows = [(i, text(i % 3 > 0), None, None, None, None) for i in range(400)]
    rows += [(1000, None, None, None, None, None), (1001, "", None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0)) for i in range(400)] + [(5000, 1), (None, 0)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.scored(docs, labels).collect()}
    assert len(got) == 402 and all(0 <= r.score <= 1 for r in got.values())
    assert got[1000].score == got[1001].score
    apart = [i for i in range(400) if got[i].held_out]
    assert 40 < len(apart) < 130
    assert sum(got[i].predicted == int(i % 3 > 0) for i in apart) >= 0.97 * len(apart)
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
    # Labels of the held-out fold teach nothing.
    flipped = spark.createDataFrame(
        [(i, int((i % 3 > 0) != got[i].held_out)) for i in range(400)], "doc_id long, quality int")
    again = {r.doc_id: r.score for r in quality.scored(docs, flipped).collect()}
    assert all(again[i] == pytest.approx(got[i].score) for i in range(400))
    none = quality.scored(docs, labels.where("doc_id < 0")).collect()
    assert {r.score for r in none} == {0.5}


def test_sql_agrees_on_the_fixture(spark, docs, rows):
    db = duckdb.connect()
    db.register("fixture", docs.drop("_row").toPandas())
    db.execute("CREATE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text, source FROM fixture")
    got = {r[0]: (r[1], r[2]) for r in db.execute(
        f"SELECT doc_id, n_shingles, component_id FROM ({sql.SQL['op8_ngram_join']})").fetchall()}
    assert got == brute_links(rows)


def test_suffix_dedup_of_repeated_ids(spark):
    """Rows sharing an id: the same text twice, other texts, none; and rows without an id."""
    passage = "a passage of more than fifty bytes that comes again and again here"
    rows = [(1, passage), (1, passage), (2, "x" + passage), (2, "short"), (2, passage), (None, passage),
            (3, None), (3, passage + "tail")]
    docs = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.removed_repeats(docs).collect()),
                 key=repr)
    n = len(passage)
    assert len(got) == len(rows)
    assert got.count((1, n, 0)) == 2 and (2, n, n) in got and (2, n + 1, n) in got
    assert (None, n, 0) in got and (3, n + 4, n) in got and (3, 0, 0) in got


def test_suffix_dedup_of_crowded_windows(spark, monkeypatch):
    """Runs of one character and a common passage: no key holds more than HOT_BYTES for a task."""
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 4000)
    dealt, real = [], suffix_dedup._verdicts
    monkeypatch.setattr(suffix_dedup, "_verdicts", lambda d, n: dealt.append(d) or real(d, n))
    monkeypatch.setattr(suffix_dedup, "release", lambda *_: None)
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(120))
    tail = lambda: "".join(rng.choice("ijklmnop ") for _ in range(60))
    texts = [tail() + passage + tail() for _ in range(150)]
    texts += [tail() + "x" * 20_000, "x" * 12_000 + tail(), "xyz" * 6000, tail() + "yzx" * 5000]
    rows = [(i * 7 % 211, t, None, None, None, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removed_repeats(docs).collect()}
    assert got == brute_repeats(rows, 50)
    sizes = dealt[0].groupBy("key").agg(F.sum(F.length("region")).alias("bytes"))
    assert all(r.bytes <= 4000 for r in sizes.collect())
    run = spark.createDataFrame([(b"r", 1, b"x" * 20_000)], "rid binary, owner long, region binary")
    assert suffix_dedup._windows(run, 50).count() == -(-(20_000 - 49) // suffix_dedup.SLICE)


def test_long_words_are_not_kept():
    encoder = pieces.encoder(pieces.read_vocabulary(pieces.default_model()))
    lines = [f"{i}" + "ab" * 500 for i in range(20)]
    first = [encoder.round_trip(line) for line in lines]
    encoder.round_trip("short words")
    assert first == [encoder.round_trip(line) for line in lines]
    assert 0 < max(map(len, encoder.seen)) <= pieces.CACHE_CHARS
