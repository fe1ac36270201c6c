"""Operators carried over micro-batches give what the batch operators give on all rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import aggregates, eventtime, joins, ranking
from rivulet.operators import ordered as o
from rivulet.operators import windows as w
from rivulet.operators.patterns import FOLLOWED_BY_ANY, NEXT, Stage, match_pattern
from rivulet.session import run_folder
from rivulet.streaming import incremental as inc

SCHEMA = "k string, seq long, ts long, v long"


def make_rows(seed, n=150, disorder=3):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = rng.choice(["hot", "hot", "hot", "a", None])
        rows.append((key, seq, seq // 2 + rng.randint(-disorder, 0), rng.choice([None, 0, 1, 2, 3])))
    return rows


def timed(df):
    return df.withColumn("rt", F.timestamp_seconds("ts"))


@pytest.fixture
def feed(spark, tmp_path):
    """Rows as a stream of micro-batches of uneven size, one without rows, and as a batch."""

    def make(rows, cuts=(0, 1, 1, 40, 41, 100)):
        folder = tmp_path / "in"
        folder.mkdir()
        for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(rows)], strict=True)):
            path = folder / f"{i:04d}.csv"
            path.write_text("\n".join(",".join("" if c is None else str(c) for c in r) for r in rows[a:b]))
            os.utime(path, (1_000_000 + i, 1_000_000 + i))
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).csv(str(folder))
        return timed(stream), timed(spark.createDataFrame(rows, SCHEMA))

    return make


def same(got, want, columns=None):
    columns = columns or want.columns
    rows = [sorted(map(repr, df.select(*columns).collect())) for df in (got, want)]
    assert rows[0] == rows[1] and rows[0]


@pytest.mark.parametrize("limit", ["7", "100000"])
def test_running_values(spark, feed, limit):
    stream, batch = feed(make_rows(1))
    values = {
        "total": o.running_sum(F.col("v")), "n": o.running_count(), "seen": o.running_count(F.col("v"), before=True),
        "top": o.running_max(F.col("v")), "low": o.running_min(F.col("v"), before=True),
        "last": o.last_seen(F.col("v")), "previous": o.previous(F.col("v")),
    }
    spark.conf.set("spark.rivulet.rowsPerChunk", limit)
    try:
        got = inc.collect_incremental(spark, stream, "running", inc.RunningValues, ["k"], "seq", values)
        same(got, o.running(batch, ["k"], ["seq"], values))
    finally:
        spark.conf.unset("spark.rivulet.rowsPerChunk")
    with pytest.raises(ValueError):
        inc.carried(None, batch, 0, ["k"], ["seq"], {"f": o.first_value(F.col("v"))})


def test_distinct_and_count_windows(spark, feed):
    stream, batch = feed(make_rows(2))
    got = inc.collect_incremental(spark, stream, "distinct", inc.DistinctSoFar, ["k"], "seq", "v", "n")
    same(got, aggregates.running_distinct(batch, ["k"], "v", "seq", "n"))
    for size, slide in ((5, 2), (2, 5)):
        got = inc.collect_incremental(spark, stream, "windows", inc.CountWindows, ["k"], "seq", "v", size, slide)
        want = w.count_sliding(batch, ["k"], "seq", size, slide, {"total": F.sum("v")})
        same(got, want.select("k", "firing", "total"))


@pytest.mark.parametrize("lateness", ["0 seconds", "3 seconds"])
def test_late_firings(spark, feed, lateness):
    stream, batch = feed(make_rows(3, disorder=9))
    times = ["5 seconds", "1 second", lateness]
    got = inc.collect_incremental(spark, stream, "firings", inc.Firings, ["k"], "rt", "seq", *times)
    want = eventtime.firings(batch, ["k"], "rt", "seq", *times)
    same(got, want)
    assert (want.where("firing = 'refire'").count() > 3) == (lateness != "0 seconds")


def test_over_range(spark, feed):
    stream, batch = feed(make_rows(4))
    got = inc.collect_incremental(spark, stream, "over", inc.OverRange, ["k"], "rt", "v", "n", "4 seconds")
    same(got, ranking.over_range_count(batch, ["k"], "rt", "v", "n"))


def stages(kind):
    one, two, three = (F.col("v") == i for i in (1, 2, 3))
    return {
        "next": [Stage("a", one), Stage("b", F.col("v") > 0, NEXT)],
        "followed": [Stage("a", one), Stage("b", two), Stage("c", three)],
        "any": [Stage("a", one), Stage("b", two, FOLLOWED_BY_ANY)],
        "times": [Stage("a", one, times=(1, 3)), Stage("b", two)],
    }[kind]


@pytest.mark.parametrize(
    "kind, within",
    [("next", None), ("followed", None), ("next", "4 seconds"), ("followed", "9 seconds"), ("any", "6 seconds")],
)
def test_patterns(spark, feed, kind, within):
    stream, batch = feed(make_rows(5))
    columns = ["k", "seq", "rt", "v"]
    got = inc.collect_incremental(
        spark, stream.select(*columns), "patterns", inc.Patterns, ["k"], "rt", "seq", stages(kind), within, "4 seconds"
    )
    want = match_pattern(batch.select(*columns), ["k"], "rt", "seq", stages(kind), within)
    same(got.where("kind = 'match'").drop("kind", "timeout_ts"), want["matches"])
    if within is not None:
        same(got.where("kind = 'timeout'"), want["timeouts"])


def test_patterns_refuse_what_would_wait_for_ever(spark):
    for kind, within in (("any", None), ("times", "9 seconds")):
        with pytest.raises(ValueError):
            inc.Patterns(spark, "", None, ["k"], "rt", "seq", stages(kind), within)


def test_waiting_and_deadlines(spark, feed):
    rows = [(k, s, t, v) for k, s, t, v in make_rows(6) if v in (0, 1) and k]
    stream, batch = feed(rows, (0, 10, 11, 30))
    side = (F.col("v") == 1).alias("is_left")
    args = ["k", "seq", "rt", side]
    got = inc.collect_incremental(spark, stream.select(*args), "waiting", inc.Waiting, ["k"], "seq")
    sides = batch.select(*args)
    want = joins.match_waiting(sides.where("is_left"), sides.where("not is_left"), ["k"], "seq")
    same(got.where("left is not null and right is not null").select("left", "right"),
         want["matches"].select(F.col("l_seq").alias("left"), F.col("r_seq").alias("right")))
    alone = want["left"].unionByName(want["right"]).select("k", "seq")
    same(got.where("left is null or right is null").select("k", F.coalesce("left", "right").alias("seq")), alone)

    folder = run_folder(spark, "deadline")
    seen = []
    operator = inc.Waiting(
        spark, folder, lambda out, i: seen.append((i, sorted(tuple(r) for r in out.collect()))), ["k"], "seq", "rt", "5 seconds"
    )
    make = lambda *r: timed(spark.createDataFrame(r, "k string, seq long, ts long, is_left boolean"))
    first = make(("a", 0, 10, True), ("b", 1, 11, False))
    operator(first, 0)
    operator(make(("c", 2, 15, True)), 1)
    operator(make(("c", 2, 15, True)), 1)  # a repeated micro-batch
    operator(make(("b", 3, 15, True)), 2)
    operator.finish(first.schema)
    assert seen == [(0, []), (1, [("a", 0, None)]), (1, [("a", 0, None)]), (2, [("b", 3, 1)]), (3, [("c", 2, None)])]


def test_top_windows(spark, feed):
    stream, batch = feed(make_rows(7))
    got = inc.collect_incremental(
        spark, stream, "top", inc.TopWindows, "v", "rt", "10 seconds", "5 seconds", 2, "4 seconds"
    )
    counts = w.sliding(batch, ["v"], "rt", "10 seconds", "5 seconds", [F.count("*").alias("cnt")])
    same(got, ranking.top_n(counts, ["window_end"], "cnt", ["v"], 2).select("window_end", "v", "cnt", "rank"))


def test_log_is_written_whole_now_and_then(spark, monkeypatch):
    monkeypatch.setattr(inc, "WHOLE_EVERY", 3)
    log = inc.Log(spark, run_folder(spark, "log"), ["k"])
    schema = "k string, n long, _gone boolean"
    state, plain = {}, spark.createDataFrame([], "k string, n long").schema
    for i in range(9):
        changed = {f"k{i % 4}": i, None: i * 10}
        gone = {f"k{(i + 1) % 4}"} if i % 2 else set()
        rows = [(k, n, False) for k, n in changed.items()] + [(k, 0, True) for k in gone]
        log.put(i, spark.createDataFrame(rows, schema))
        state.update(changed)
        for k in gone:
            state.pop(k, None)
        assert {r["k"]: r["n"] for r in log.before(i + 1, plain).collect()} == state
    # A repeated micro-batch replaces its own version and no other.
    log.put(8, spark.createDataFrame([("k0", 99, False)], schema))
    assert {r["k"]: r["n"] for r in log.before(9, plain).collect()}["k0"] == 99
    assert [p for p in os.listdir(log.folder) if p.startswith("batch=")]
