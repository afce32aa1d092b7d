"""Records against query chunks, by brute force."""

import random

import pytest

from tailfold.operators import ranges

FEATURES = "chrom string, tss long, feature_id string"


def chunks_of(features, distance, size):
    """Windows by marking positions one by one, then cut."""
    out = []
    for chrom in sorted({c for c, *_ in features}):
        covered = sorted({p for c, t, _ in features if c == chrom
                          for p in range(max(1, t - distance), t + distance + 1)})
        # closed windows that only touch stay apart
        edges = {max(1, t - distance) for c, t, _ in features if c == chrom}
        ends = {t + distance for c, t, _ in features if c == chrom}
        start = previous = None
        for p in covered:
            fresh = previous is None or p != previous + 1 or (
                p in edges and previous in ends and not any(
                    c == chrom and max(1, t - distance) <= previous and p <= t + distance
                    for c, t, _ in features))
            if fresh:
                if start is not None:
                    out.append((chrom, start, previous))
                start = p
            previous = p
        out.append((chrom, start, previous))
    return [(c, w, i, a, min(a + size - 1, e)) for c, w, e in out
            for i, a in enumerate(range(w, e + 1, size))]


@pytest.mark.parametrize("distance, size, longest, broadcast", [
    (0, 1, 40, 10**6), (5, 3, 60, 10**6), (5, 100, 5, 0), (40, 7, 5000, 10**6), (40, 7, 5000, 0)])
def test_every_record_meets_the_chunks_that_it_reaches(spark, monkeypatch, distance, size, longest, broadcast):
    monkeypatch.setattr(ranges, "BROADCAST_ROWS", broadcast)
    rng = random.Random(distance + longest)
    features = [(rng.choice(["a", "b"]), rng.randrange(1, 3000), f"f{i}") for i in range(25)]
    records = []
    for i in range(400):
        pos = rng.randrange(1, 3300)
        records.append((i, rng.choice(["a", "b", "c"]), pos, pos + rng.choice([0, 0, 1, 2, rng.randrange(longest)]), "x"))
    records += [(400, "a", None, None, "x"), (401, None, 5, 9, "x"), (402, "a", 1, 10**12, "x")]
    frame = spark.createDataFrame(records, "id int, chrom string, pos long, end_pos long, _other string")
    windows = ranges.query_windows(spark.createDataFrame(features, FEATURES), distance)
    got = ranges.records_in_chunks(frame, windows, distance, size).collect()
    expected = {(i, w, n, a <= p <= e) for c, w, n, a, e in chunks_of(features, distance, size)
                for i, chrom, p, q, _ in records if chrom == c and p is not None and p <= e and q >= a}
    assert len(got) == len(expected)
    assert {(r.id, r.chunk.window, r.chunk.piece, r.starts_here) for r in got} == expected
    assert set(got[0].asDict()) == {"id", "chrom", "pos", "end_pos", "_other", "chunk", "starts_here"}
