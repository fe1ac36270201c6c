"""Hot keys split over chunks must give what one ordered pass per key gives."""

import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import ordered as o


def _rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = rng.choice(["hot", "hot", "hot", "a", "b", None])
        value = rng.choice([None, rng.randint(-5, 20)])
        rows.append((key, seq, value))
    return rows


def _expected(rows):
    state, out = {}, {}
    for key, seq, value in rows:
        s = state.setdefault(key, [])
        before = [v for v in s if v is not None]
        s.append(value)
        seen = [v for v in s if v is not None]
        out[seq] = (
            sum(seen) if seen else None,
            len(s),
            max(seen) if seen else None,
            min(before) if before else None,
            s[0],
            before[-1] if before else None,
            s[-2] if len(s) > 1 else None,
        )
    return out


def _values():
    v = F.col("v")
    return {
        "total": o.running_sum(v),
        "rn": o.running_count(),
        "top": o.running_max(v),
        "low_before": o.running_min(v, before=True),
        "first": o.first_value(v),
        "seen_before": o.last_seen(v, before=True),
        "prev": o.previous(v),
    }


@pytest.mark.parametrize("limit", [7, 10_000])
def test_running_equals_sequential(spark, limit):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "k string, seq long, v int")
    plan = o.layout(df, ["k"], ["seq"], limit)
    assert plan.chunked == (limit == 7)
    got = o.running(df, ["k"], ["seq"], _values(), plan=plan).collect()
    expected = _expected(rows)
    assert {r["seq"]: tuple(r[n] for n in _values()) for r in got} == expected


def test_reverse_and_global(spark):
    rows = _rows(2)
    df = spark.createDataFrame(rows, "k string, seq long, v int")
    got = o.running(df, [], ["seq"], {"nxt": o.last_seen(F.col("v"), before=True)}, reverse=True)
    expected, seen = {}, None
    for _, seq, value in reversed(rows):
        expected[seq] = seen
        seen = value if value is not None else seen
    assert {r["seq"]: r["nxt"] for r in got.collect()} == expected


@pytest.mark.parametrize("limit", [5, 10_000])
def test_following(spark, limit):
    rows = _rows(3)
    df = spark.createDataFrame(rows, "k string, seq long, v int")
    got = o.following(df, ["k"], ["seq"], F.col("seq"), 3, "g", rows_per_chunk=limit).collect()
    by_key = {}
    for key, seq, _ in rows:
        by_key.setdefault(key, []).append(seq)
    expected = {s: seqs[i : i + 3] for seqs in by_key.values() for i, s in enumerate(seqs)}
    assert {r["seq"]: r["g"] for r in got} == expected


@pytest.mark.parametrize("limit", [5, 10_000])
def test_beside(spark, limit):
    rows = _rows(4)
    df = spark.createDataFrame(rows, "k string, seq long, v int")
    plan = o.layout(df, ["k"], ["seq"], limit)
    assert plan.chunked == (limit == 5)
    value = F.when(F.col("seq") % 7 > 0, F.col("seq"))  # a null value is a value
    got = o.beside(df, ["k"], ["seq"], F.struct(value.alias("x")), "one", "two", plan=plan).collect()
    by_key = {}
    for key, seq, _ in rows:
        by_key.setdefault(key, []).append(seq)
    held = lambda seq: (seq if seq % 7 else None,)
    expected = {}
    for seqs in by_key.values():
        for i, seq in enumerate(seqs):
            expected[seq] = (
                held(seqs[i - 1]) if i else None, held(seqs[i + 1]) if i + 1 < len(seqs) else None
            )
    assert {r["seq"]: tuple(v and tuple(v) for v in (r["one"], r["two"])) for r in got} == expected


def test_only_summaries_reach_one_task(spark):
    """Without a key the rows stay spread; only one row per chunk is brought together."""
    df = spark.range(1000).withColumnRenamed("id", "seq")
    out = o.running(df, [], ["seq"], {"m": o.running_max(F.col("seq"), before=True)})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("_chunk" in line.split("windowspecdefinition(")[1].split(" ")[0] for line in windows)


@pytest.mark.parametrize("direct", [0, 3, 256])
def test_chunks_by_one_search_and_by_two(spark, monkeypatch, direct):
    monkeypatch.setattr(o, "DIRECT_CUTS", direct)
    rows = _rows(3)
    df = spark.createDataFrame(rows, "k string, seq long, v int")
    plan = o.layout(df, [], ["v", "seq"], 7)
    cuts = sorted(((v is not None, v or 0, s) for v, s in ((None if v is None else int(v), int(s)) for v, s in plan.splits)))
    got = plan.tag(df)
    assert got.columns == [*df.columns, o.CHUNK]
    for r in got.collect():
        assert r[o.CHUNK] == sum(c <= (r["v"] is not None, r["v"] or 0, r["seq"]) for c in cuts)
    assert len(cuts) > 30


def test_running_with_many_cuts(spark, monkeypatch):
    monkeypatch.setattr(o, "DIRECT_CUTS", 4)
    rows = _rows(4)
    df = spark.createDataFrame(rows, "k string, seq long, v int")
    got = o.running(df, ["k"], ["seq"], _values(), rows_per_chunk=7).collect()
    assert {r["seq"]: tuple(r[n] for n in _values()) for r in got} == _expected(rows)


def test_the_plan_holds_few_of_many_cuts(spark, monkeypatch):
    """Of 1,000 cuts only those between groups are part of the plan, and no other row is
    brought to the driver than the cuts."""
    rows = _rows(3)
    df = spark.createDataFrame(rows, "k string, seq long, v int")
    plan = o.Layout((), ("v", "seq"), (), tuple((str(i // 40), str(i % 40)) for i in range(1000)))
    cuts = [(True, i // 40, i % 40) for i in range(1000)]
    put, lit = [], F.lit
    monkeypatch.setattr(F, "lit", lambda value: put.append(value) or lit(value))
    got = plan.tag(df)
    monkeypatch.undo()
    assert len(put) < 300
    for r in got.collect():
        assert r[o.CHUNK] == sum(c <= (r["v"] is not None, r["v"] or 0, r["seq"]) for c in cuts)
    collected, kind = [], type(df)
    whole = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: collected.append(whole(self)) or collected[-1])
    found = o.layout(df, [], ["seq"], 1)
    assert len(found.splits) + 1 >= o.MIN_CHUNKS and max(map(len, collected)) <= len(found.splits)
