"""Operators hold few copies of their rows on disk at a time."""

from __future__ import annotations

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from tailfold import session
from tailfold.llm import suffix_dedup

SCHEMA = "doc_id long, text string"


def expected(rows, length=50):
    first, out = {}, {}
    for doc, text in sorted(rows):
        data = text.encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if first.setdefault(data[k:k + length], doc) < doc:
                gone[k:k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not before for g, before in zip(gone, b"\0" + gone))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def size(path):
    return sum(os.path.getsize(os.path.join(folder, f)) for folder, _, files in os.walk(path) for f in files)


def line_texts(rng, n_docs, n_lines):
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 "
    pool = ["".join(rng.choices(letters, k=rng.randrange(60, 121))) for _ in range(n_lines)]
    return [(7 * i % 1009, "\n".join(rng.choices(pool, k=40))) for i in range(n_docs)]


def test_suffix_dedup_stages_regions_once(spark, monkeypatch):
    """Lines that some documents share: beside the regions, only what is removed and small tables."""
    rows = line_texts(random.Random(3), 300, 3000)
    paths, sizes, held = {}, {}, {}

    def stage(table, name):
        staged = session.stage(table, name)
        paths[name] = session._paths[id(staged)][1].removeprefix("file:")
        sizes[name] = size(paths[name])
        held[name] = sum(map(size, paths.values()))
        return staged

    monkeypatch.setattr(suffix_dedup, "stage", stage)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removed_repeats(docs).collect()}
    assert got == expected(rows)
    assert sizes["regions"] > 500_000
    # Before: regions, distinct ones and places at a time, 2.1 times the regions over 0.51 GB.
    assert max(held.values()) < 1.5 * sizes["regions"]


@pytest.mark.parametrize("hot", [600, 4000, 1 << 22])
def test_regions_of_crowded_grams_are_not_dealt_one_by_one(spark, monkeypatch, hot):
    """A line in every document, others in a few, a long run of one character; ids come twice."""
    rng = random.Random(9)
    rows = line_texts(rng, 60, 400)
    common = "a line that every one of these documents holds somewhere inside, as it is"
    rows = [(d, t[:500 + d % 90] + common + t[500 + d % 90:]) for d, t in rows]
    rows += [(2000, "z" * 5000), (2001, common + "z" * 3000), (2002, "z" * 49), (2003, "")]
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", hot)
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "release", lambda *_: None)
    dealt, real = [], suffix_dedup._cuts
    monkeypatch.setattr(suffix_dedup, "_cuts", lambda d, n: dealt.append(d) or real(d, n))
    docs = spark.createDataFrame(rows + rows[:3], SCHEMA).repartition(4)
    found = suffix_dedup.removed_repeats(docs).collect()
    assert len(found) == len(rows) + 3
    assert {r.doc_id: tuple(r)[1:] for r in found} == expected(rows)
    sums = [r.n for r in dealt[0].groupBy("key").agg(F.sum(F.length("region")).alias("n")).collect()]
    assert sums and max(sums) <= hot
