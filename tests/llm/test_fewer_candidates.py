"""Candidates and sorted bytes that cannot matter are left out, and nothing else."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np

from tailfold.llm import ngram_join, suffix_dedup


def test_suffix_sorting_takes_only_what_may_repeat(monkeypatch):
    """Of regions of one gram only the stretches that differ and repeat are sorted."""
    rng = random.Random(5)
    text = bytes(rng.choice(b"abcdefgh") for _ in range(120))
    alone = [bytes(rng.choice(b"abcdefgh") for _ in range(90)) for _ in range(50)]
    regions = [*alone, b"x" + text, text + b"y", text, text[30:100], text[:25] + text[30:]]
    owners = np.array([*range(10, 60), 4, 9, 7, 3, 2])
    sorted_bytes, real = [], suffix_dedup.suffix_order
    monkeypatch.setattr(suffix_dedup, "suffix_order", lambda t: sorted_bytes.append(len(t)) or real(t))
    found = suffix_dedup.least_owners(regions, owners, 50)
    least = {}
    for region, owner in zip(regions, owners.tolist()):
        for i in range(len(region) - 49):
            least[region[i:i + 50]] = min(least.get(region[i:i + 50], 99), owner)
    assert [f.tolist() for f in found] == [
        [least[r[i:i + 50]] for i in range(len(r) - 49)] for r in regions]
    assert sorted_bytes and max(sorted_bytes) < 600  # all regions: 5,000


def test_all_pairs_of_crowded_components_meet_once(spark, monkeypatch):
    """A large component beside sets of their own, and two that share few n-grams."""
    sets = [(i, 0 if i < 12 else i, 40) for i in range(18)]          # component 0 and six others
    rows = [(t, i, size, t, own) for t in range(10) for i, own, size in sets]
    rows += [(100, 50, 40, 3, 50), (100, 51, 40, 3, 51), (100, 52, 90, 3, 52)]  # 52: too large
    rows += [(200 + i, i, 40, 5, 60) for i in range(60, 66)]
    rows += [(300 + i, i, 40, 5, 70) for i in range(70, 76)]
    rows += [(400, 60, 40, 2, 60), (400, 75, 40, 2, 70)]
    table = spark.createDataFrame(rows, "token long, id long, size int, pos int, own long")
    staged, real = {}, ngram_join.stage
    monkeypatch.setattr(ngram_join, "release", lambda *_: None)
    monkeypatch.setattr(ngram_join, "stage", lambda d, n: staged.setdefault(n, real(d, n)))
    got = sorted((r.id_a, r.id_b) for r in ngram_join._all_pairs(table, 75).collect())
    assert got == sorted(
        [(a, b) for (a, x, _), (b, y, _) in combinations(sets, 2) if x != y] + [(50, 51), (60, 75)])
    assert staged["held"].where("token = 0").count() == 7  # components, not 18 sets
    assert {(r.own_a, r.own_b): r.whole for r in staged["met"].collect()}[60, 70] is False


def test_lengths_rule_out_sets_that_share_two_thirds(spark):
    """400 of 500 n-grams are shared: a similarity of two thirds, and one of 0.9 stays."""
    rng = random.Random(3)
    base = [f"w{rng.random()}" for _ in range(504)]
    docs = [(0, " ".join(base)), (1, " ".join(base[:404] + [f"v{i}" for i in range(100)])),
            (2, " ".join(base[:480] + [f"u{i}" for i in range(24)]))]
    first = ngram_join._first_pass(spark.createDataFrame(docs, "id long, text string"), 5)
    classes = first.where("part IS NULL").selectExpr("id", "n AS size", "lengths")
    pairs = spark.createDataFrame([(0, 1), (0, 2)], "id_a long, id_b long")
    got = ngram_join._plausible(pairs, classes, 75).collect()
    assert [tuple(r) for r in got] == [(0, 2)]
    same = " ".join("a b c d e f".split() * 3)
    long = spark.createDataFrame([(5, same), (6, same)], "id long, text string")
    members = ngram_join._first_pass(long, 5).where("part IS NULL").selectExpr("id", "n AS size", "lengths")
    pair = spark.createDataFrame([(5, 6)], "id_a long, id_b long")
    assert ngram_join._plausible(pair, members, 75).count() == 1
    cut = members.selectExpr("id", "100000L AS size", "unhex(repeat('FF', 512)) AS lengths")
    assert ngram_join._plausible(pair, cut, 75).count() == 1  # lengths that were cut rule nothing out
