"""Timers by pointer doubling: chains of any length, no task with more than a chunk."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.operators import timers


def walked(found, due, start):
    """Openers of one group, row by row."""
    pending, out = start, []
    for i, (f, d) in enumerate(zip(found, due, strict=True)):
        if f >= pending:
            pending = d
            out.append(i)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_pointers_by_brute_force(seed):
    rng = np.random.default_rng(seed)
    group = np.sort(rng.integers(0, 5, 200))
    found = np.concatenate([np.sort(rng.integers(0, 60, n)) for n in np.bincount(group) if n])
    due = np.maximum(found + 1, found + rng.integers(-5, 12, 200))
    after = timers._after(group, found, due)
    for i in range(200):
        later = [j for j in range(200) if group[j] == group[i] and found[j] >= due[i]]
        assert after[i] == min(later, default=200)
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    opens = timers._reached(first, after)
    want = []
    for g in np.unique(group):
        mine = np.flatnonzero(group == g)
        want += [mine[i] for i in walked(found[mine], due[mine], -1)]
    assert np.flatnonzero(opens).tolist() == want
    for i, end in enumerate(timers._ends(after).tolist()):
        while after[i] < 200:
            i = after[i]
        assert i == end


@pytest.mark.parametrize("window", ["10 seconds", "12 hours"])
def test_a_hot_key_never_meets_in_one_task(spark, monkeypatch, window):
    """20,000 evenly spaced rows of one key, in chunks of 1,000."""
    rows = spark.range(20_000).select(
        F.lit("a").alias("k"), F.col("id").alias("seq"), F.timestamp_seconds("id").alias("rt")
    )
    sizes = []
    real = timers.map_frames

    def counting(df, task, schema):
        group = [c for c in ("k", "_segment", timers.o.CHUNK) if c in df.columns]
        counted = df.groupBy(*group).count().agg(F.max("count")).first()[0]
        sizes.append(counted)
        return real(df, task, schema)

    monkeypatch.setattr(timers, "map_frames", counting)
    got = timers.repeated_failures(rows, "k", "rt", "seq", F.lit(False), window, 2, rows_per_chunk=1_000)
    span = 10 if window == "10 seconds" else 43_200
    # The row after the one that moves the watermark to the deadline opens the next timer.
    starts = list(range(0, 20_000, span + 1))
    want = [("a", s, min(span + 1, 20_000 - s), "timer") for s in starts if 20_000 - s >= 2]
    assert sorted(map(tuple, got.collect())) == want
    assert sizes and max(sizes) <= 2_000
