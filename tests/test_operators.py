"""Operators against small sequential models, with and without hot keys."""

import random
from collections.abc import Iterator

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.operators import aggregates as a
from rivulet.operators import changelog, eventtime, joins, ranking, timers
from rivulet.operators import ordered as o
from rivulet.operators import transforms as t
from rivulet.operators import windows as w

SPLIT = [6, 100_000]


def stream(spark, rows, columns):
    """Frame of rows with event time ``rt`` from the seconds column ``ts``."""
    return spark.createDataFrame(rows, columns).withColumn("rt", F.timestamp_seconds("ts"))


def events(seed, n=300, keys=("hot", "hot", "hot", "a", "b"), disorder=6):
    rng = random.Random(seed)
    return [
        (rng.choice(keys), seq, max(0, seq + rng.randint(-disorder, disorder)), rng.randint(0, 9))
        for seq in range(n)
    ]


COLUMNS = "k string, seq long, ts long, v int"


@pytest.mark.parametrize("limit", SPLIT)
def test_running_distinct(spark, limit):
    rows = events(1)
    got = a.running_distinct(
        spark.createDataFrame(rows, COLUMNS), ["k"], "v", "seq", rows_per_chunk=limit
    )
    seen, expected = {}, {}
    for k, seq, _, v in rows:
        seen.setdefault(k, set()).add(v)
        expected[seq] = len(seen[k])
    assert {r["seq"]: r["distinct_count"] for r in got.collect()} == expected


def test_accumulate_merges_partials(spark):
    rows = events(2)
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)

    def add(groups):
        return groups["v"].agg(total="sum", n="size")

    def merge(groups):
        return groups.agg({"total": "sum", "n": "sum"})

    got = a.accumulate(
        df, ["k"], add, merge, "total long, n long", {"mean": F.col("total") / F.col("n")}
    )
    groups = {}
    for k, _, _, v in rows:
        groups.setdefault(k, []).append(v)
    assert {r["k"]: r["mean"] for r in got.collect()} == {
        k: sum(v) / len(v) for k, v in groups.items()
    }


@pytest.mark.parametrize("limit", SPLIT)
def test_count_windows(spark, limit):
    rows = events(3)
    df = spark.createDataFrame(rows, COLUMNS)
    total = F.sum("v").alias("total")
    by_key = {}
    for k, _, _, v in rows:
        by_key.setdefault(k, []).append(v)
    tumbling = w.count_tumbling(df, ["k"], "seq", 4, [total], rows_per_chunk=limit)
    assert {(r["k"], r["pane"]): r["total"] for r in tumbling.collect()} == {
        (k, i // 4 + 1): sum(vs[i : i + 4]) for k, vs in by_key.items() for i in range(0, len(vs) - 3, 4)
    }
    for size, slide in ((5, 2), (2, 5)):
        for value in (F.sum("v"), o.running_sum(F.col("v"))):
            sliding = w.count_sliding(df, ["k"], "seq", size, slide, {"total": value}, rows_per_chunk=limit)
            assert "Generate" not in sliding._jdf.queryExecution().executedPlan().toString()
            assert {(r["k"], r["firing"]): r["total"] for r in sliding.collect()} == {
                (k, n // slide): sum(vs[max(0, n - size) : n])
                for k, vs in by_key.items()
                for n in range(slide, len(vs) + 1, slide)
            }


def test_panes_equal_row_expansion(spark):
    df = stream(spark, events(4), COLUMNS)
    direct = w.sliding(df, ["k"], "rt", "60 seconds", "5 seconds", [F.count("*").alias("cnt")])
    panes = w.sliding_from_panes(df, ["k"], "rt", "60 seconds", "5 seconds", {"cnt": F.lit(1)})
    assert sorted(direct.collect()) == sorted(panes.collect())


def test_panes_refuse_floating_point_and_uneven_slides(spark):
    df = stream(spark, events(4), COLUMNS)
    with pytest.raises(ValueError):
        w.sliding_from_panes(df, ["k"], "rt", "60 seconds", "5 seconds", {"x": F.col("v") / 2})
    with pytest.raises(ValueError):
        w.sliding_from_panes(df, ["k"], "rt", "60 seconds", "7 seconds", {"x": F.col("v")})


def test_running_values_refuse_streams(spark):
    rate = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        o.running(rate, ["value"], ["timestamp"], {"n": o.running_count()})


@pytest.mark.parametrize("limit", SPLIT)
def test_session_split_equals_session_window(spark, limit):
    rng = random.Random(5)
    rows = [(rng.choice("hha"), i, rng.randint(0, 900), 1) for i in range(150)]
    df = stream(spark, rows, COLUMNS)
    count = F.count("*").alias("cnt")
    expected = w.session(df, ["k"], "rt", "10 seconds", [count]).collect()
    got = w.session_split(df, ["k"], "rt", "seq", "10 seconds", [count], rows_per_chunk=limit)
    assert sorted(got.collect()) == sorted(expected)
    chosen = w.session(df, ["k"], "rt", "10 seconds", [count], "seq", rows_per_chunk=limit)
    assert sorted(chosen.collect()) == sorted(expected)


@pytest.mark.parametrize("limit", SPLIT)
def test_over_range_count(spark, limit):
    rows = [(k, s, ts // 3, v) for k, s, ts, v in events(6)]
    df = stream(spark, rows, COLUMNS)
    got = ranking.over_range_count(df, ["k"], "rt", "k", "n", rows_per_chunk=limit).collect()
    expected = {s: sum(1 for r in rows if r[0] == k and r[2] <= ts) for k, s, ts, _ in rows}
    assert {r["seq"]: r["n"] for r in got} == expected


def test_process_window_reads_batches(spark):
    rows = events(14)
    df = stream(spark, rows, COLUMNS).select("k", "rt", "v")

    def middle(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        values = sorted(v for batch in batches for v in batch["v"])
        yield pd.DataFrame([[*key, values[len(values) // 2]]], columns=["k", "s", "e", "mid"])

    got = w.process_window(
        df, ["k"], "rt", "50 seconds", middle, "k string, s timestamp, e timestamp, mid int"
    )
    groups = {}
    for k, _, ts, v in rows:
        groups.setdefault((k, ts // 50 * 50), []).append(v)
    expected = sorted((k, s, sorted(v)[len(v) // 2]) for (k, s), v in groups.items())
    seconds = got.select("k", F.unix_seconds("s").alias("s"), "mid")
    assert sorted(tuple(r) for r in seconds.collect()) == expected


def test_daily_limit_sends_few_rows(spark):
    from rivulet.plans.cases import daily_limit

    rows = [("u", i, 1000 + i, 0) for i in range(121)] + [("u", 200 + i, 90_000, 0) for i in range(3)]
    out = daily_limit(stream(spark, rows, COLUMNS), ["k"], "rt", "seq", 100)
    assert out["pass"].count() == 103
    assert [r["seq"] for r in out["alarm"].collect()] == [100]
    assert "WindowGroupLimit" in out["pass"]._jdf.queryExecution().executedPlan().toString()


def test_top_n_ties_and_report(spark):
    rows = [("w", "b", 3), ("w", "a", 3), ("w", "c", 5), ("w", "d", 1)]
    df = spark.createDataFrame(rows, "win string, k string, n long")
    got = ranking.top_n(df, ["win"], "n", ["k"], 3).orderBy("rank").collect()
    assert [r["k"] for r in got] == ["c", "a", "b"]
    text = ranking.top_n_report(
        df, "win", "n", ["k"], 2, F.concat(F.lit("end "), "win"), F.concat_ws("=", "k", "n")
    ).first()["report"]
    assert text == "end w\nTop1:c=5\nTop2:a=3"


@pytest.mark.parametrize("limit", SPLIT)
def test_changelog_replays_to_the_count(spark, limit):
    rows = [(k, s, ts, None if v == 0 else v) for k, s, ts, v in events(7)]
    df = spark.createDataFrame(rows, COLUMNS)
    log = changelog.retract_counts(df, ["k"], "seq", "v", rows_per_chunk=limit)
    expected = {}
    for k, _, _, v in rows:
        expected[k] = expected.get(k, 0) + (v is not None)
    got = changelog.replay_changelog(log, ["k"]).collect()
    assert {r["k"]: r["cnt"] for r in got} == expected
    assert len(got) == len(expected)


def test_replay_example(spark):
    """Window 5 s, bound 3 s, lateness 2 s, arrival 1 4 8 3 10 2."""
    rows = [("k", i, ts, 0) for i, ts in enumerate([1, 4, 8, 3, 10, 2])]
    df = stream(spark, rows, COLUMNS)
    status = eventtime.classify(df, "rt", "seq", "5 seconds", "3 seconds", "2 seconds")
    got = {r["ts"]: r["status"] for r in status.collect()}
    assert got == {1: "on_time", 4: "on_time", 8: "on_time", 3: "refire", 10: "on_time", 2: "late"}
    fired = eventtime.firings(df, ["k"], "rt", "seq", "5 seconds", "3 seconds", "2 seconds")
    refire = [r for r in fired.collect() if r["firing"] == "refire"]
    assert [(r["seq"], r["cnt"]) for r in refire] == [(3, 3)]
    parts = eventtime.split_late(df, "rt", "seq", "5 seconds", "3 seconds", "2 seconds")
    assert [r["ts"] for r in parts["late"].collect()] == [2]
    assert parts["main"].count() == 5


@pytest.mark.parametrize("slide", [None, "2 seconds"])
def test_replay_partitions_all_pairs(spark, slide):
    rows = events(8, disorder=20)
    df = stream(spark, rows, COLUMNS)
    got = eventtime.classify(df, "rt", "seq", "6 seconds", "2 seconds", "4 seconds", slide)
    counts = {r["status"]: r["n"] for r in got.groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert set(counts) == {"on_time", "refire", "late"}
    assert sum(counts.values()) == len(rows) * (3 if slide else 1)
    latest, expected = None, {}
    if slide is None:
        for _, seq, ts, _ in rows:
            end = (ts // 6 + 1) * 6 - 0.001
            wm = None if latest is None else latest - 2
            expected[seq] = (
                "on_time" if wm is None or end > wm else "refire" if wm < end + 4 else "late"
            )
            latest = ts if latest is None else max(latest, ts)
        assert {r["seq"]: r["status"] for r in got.collect()} == expected


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("limit", SPLIT)
def test_match_waiting(spark, seed, limit):
    rng = random.Random(seed)
    rows = [(rng.choice("hha"), i, rng.choice("lr")) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, seq long, side string")
    out = joins.match_waiting(
        df.where("side='l'"), df.where("side='r'"), ["k"], "seq", rows_per_chunk=limit
    )
    waiting, pairs = {"l": {}, "r": {}}, set()
    for k, seq, side in rows:
        other = "r" if side == "l" else "l"
        if k in waiting[other]:
            partner = waiting[other].pop(k)
            pairs.add((seq, partner) if side == "l" else (partner, seq))
        else:
            waiting[side][k] = seq
    got = {(r["l_seq"], r["r_seq"]) for r in out["matches"].collect()}
    assert got == pairs
    for side, name in (("l", "left"), ("r", "right")):
        assert {r["k"]: r["seq"] for r in out[name].collect()} == waiting[side]


def test_match_occurrences(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, s long")
    right = spark.createDataFrame([("a", 5), ("c", 6)], "k string, s long")
    got = joins.match_occurrences(left, right, ["k"], "s", "s", "full").collect()
    assert {(r["l_s"], r["r_s"]) for r in got} == {(1, 5), (2, None), (3, None), (None, 6)}


def test_interval_join_ends_included(spark):
    rng = random.Random(9)
    left = [(rng.choice("hha"), i, rng.randint(0, 200), 0) for i in range(80)]
    right = [(rng.choice("hha"), i, rng.randint(0, 200), 0) for i in range(80)]
    got = joins.interval_join(
        stream(spark, left, COLUMNS), stream(spark, right, COLUMNS), ["k"], "rt", "rt",
        "-7 seconds", "5 seconds",
    ).collect()
    assert sorted((r["l_seq"], r["r_seq"]) for r in got) == sorted(
        (x[1], y[1]) for x in left for y in right if x[0] == y[0] and -7 <= y[2] - x[2] <= 5
    )


def test_window_join_example(spark):
    left = stream(spark, [(1, 111), (2, 211), (3, 311), (4, 411)], "k int, ts long")
    right = stream(spark, [(1, 211), (2, 211), (3, 311), (4, 411)], "k int, ts long")
    got = joins.window_join(left, right, ["k"], "rt", "10 seconds").collect()
    assert sorted(r["l_k"] for r in got) == [2, 3, 4]


def test_enrich_latest(spark):
    main = spark.createDataFrame([(1, "a"), (3, "b"), (6, "c")], "seq long, x string")
    control = spark.createDataFrame([(2, "1"), (4, "0"), (5, "1")], "seq long, c string")
    value = F.when(F.col("c") == "1", "true").otherwise("false")
    got = joins.enrich_latest(main, control, "seq", value, "switch").orderBy("seq").collect()
    assert [r["switch"] for r in got] == [None, "true", "true"]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("limit", [9, 100_000])
def test_repeated_failures(spark, seed, limit):
    rng = random.Random(seed)
    rows = []
    for seq in range(260):
        key = rng.choice(["hot", "hot", "hot", "a"])
        ok = rng.random() < (0.01 if key == "hot" else 0.3)
        rows.append((key, seq, max(0, seq // 4 + rng.randint(-4, 1)), "success" if ok else "fail"))
    df = stream(spark, rows, "k string, seq long, ts long, kind string")
    got = timers.repeated_failures(
        df, "k", "rt", "seq", F.col("kind") == "success", "2 seconds", 2, "1 second", limit
    )
    state, expected, wm = {}, [], None

    def fire(k):
        first, count, _ = state.pop(k)
        if count >= 2:
            expected.append((k, first, count, "timer"))

    for k, seq, ts, kind in rows:
        if k in state and wm is not None and wm >= state[k][2]:
            fire(k)
        if kind == "success":
            if k in state:
                first, count, _ = state.pop(k)
                if count >= 2:
                    expected.append((k, first, count, "success"))
        elif k in state:
            state[k][1] += 1
        else:
            due = ts + 2
            # A timer set for the past goes off when the watermark next moves.
            state[k] = [seq, 1, due if wm is None else max(due, wm + 0.000001)]
        wm = ts - 1 if wm is None else max(wm, ts - 1)
    for k in list(state):
        fire(k)
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
    assert any(e[3] == "success" for e in expected) and any(e[3] == "timer" for e in expected)


@pytest.mark.parametrize("limit", [9, 100_000])
def test_rising_alarms(spark, limit):
    rng = random.Random(11)
    level, rows = {}, []
    for seq in range(240):
        k = rng.choice(["hot", "hot", "hot", "a"])
        level[k] = level.get(k, 0) + 1 if rng.random() < 0.93 else 0
        rows.append((k, seq, seq // 3, level[k]))
    df = stream(spark, rows, COLUMNS)
    got = timers.rising_alarms(df, "k", "rt", "seq", "v", "5 seconds", rows_per_chunk=limit)
    last, timer, expected, wm = {}, {}, [], None
    for k, seq, ts, v in rows:
        for other in list(timer):
            if wm is not None and wm >= timer[other][1]:
                expected.append((other, timer.pop(other)[0]))
        if v > last.get(k, -1):
            timer.setdefault(k, (seq, ts + 5))
        else:
            timer.pop(k, None)
        last[k] = v
        wm = ts if wm is None else max(wm, ts)
    expected += [(k, first) for k, (first, _) in timer.items()]
    assert sorted((r["k"], r["first_seq"]) for r in got.collect()) == sorted(expected)


def test_tags_and_side_output(spark):
    df = spark.createDataFrame([(10,), (60,), (90,)], "vc int")
    vc = F.col("vc")
    tagged = t.tag(
        df,
        [(vc < 50, ["normal", "low"]), (vc < 80, ["warn", "low"]), (F.lit(True), ["alarm"])],
    )
    assert t.select_tag(tagged, "low").count() == 2
    out = t.side_output(df, vc > 50, F.concat(F.lit("high "), "vc"))
    assert out["main"].count() == 1 and out["side"].count() == 2


def test_tokens(spark):
    df = spark.createDataFrame([("a  b ",), ("",), ("  ",), (" x",)], "value string")
    assert [r["word"] for r in t.explode_tokens(df).collect()] == ["a", "", "b", "", "", "x"]


def test_not_in_null_rule(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    some = spark.createDataFrame([(1,)], "y int")
    null = spark.createDataFrame([(1,), (None,)], "y int")
    none = some.where("y > 5")
    assert [r["x"] for r in t.not_in(df, "x", some, "y").collect()] == [2]
    assert t.not_in(df, "x", null, "y").count() == 0
    assert t.not_in(df, "x", none, "y").count() == 3


def test_map_with_setup(spark):
    df = spark.range(6).withColumnRenamed("id", "x")
    out = t.map_with_setup(df, lambda: 10, lambda add, b: b.assign(x=b["x"] + add), "x long")
    assert sorted(r["x"] for r in out.collect()) == list(range(10, 16))


def test_bitmap_offset(spark):
    from rivulet.functions.text import bitmap_offset

    row = spark.range(1).select(bitmap_offset(F.lit("937166")).alias("b")).first()
    assert row["b"] == 542414600
