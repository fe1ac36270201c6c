"""Streams fed one file per micro-batch give what the batch operators give."""

import os
import time

import pytest
from pyspark.sql import functions as F

from rivulet.operators import joins, ranking, timers
from rivulet.operators import windows as w
from rivulet.streaming import processors as p
from rivulet.streaming import run

FAR = 10_000


@pytest.fixture
def feed(spark, tmp_path):
    """Turn lists of rows into a stream of one micro-batch per list."""

    def make(batches, schema, name="in"):
        folder = tmp_path / name
        folder.mkdir()
        for i, rows in enumerate(batches):
            path = folder / f"{i:04d}.csv"
            path.write_text("\n".join(",".join(map(str, r)) for r in rows))
            os.utime(path, (1_000_000 + i, 1_000_000 + i))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).csv(str(folder))
        return stream

    return make


def timed(df, bound="0 seconds"):
    df = df.withColumn("rt", F.timestamp_seconds("ts")).withColumn("ms", F.col("ts") * 1000)
    return df.withWatermark("rt", bound) if df.isStreaming else df


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


SCHEMA = "k string, seq long, ts long, v long"
ROWS = [
    ("a", 0, 0, 10), ("a", 1, 1, 20), ("b", 2, 2, 5), ("a", 3, 4, 20),
    ("b", 4, 6, 7), ("a", 5, 7, 10), ("b", 6, 9, 7), ("a", 7, 12, 30),
]
BATCHES = [ROWS[:3], ROWS[3:5], ROWS[5:]]


def test_tumbling_append_needs_later_rows(spark, feed):
    stream = timed(feed([*BATCHES, [("end", 99, FAR, 0)]], SCHEMA))
    counts = w.tumbling(stream, ["k"], "rt", "5 seconds", [F.count("*").alias("cnt")])
    got = run.collect_stream(spark, counts, "tumbling").where("k <> 'end'")
    batch = timed(spark.createDataFrame(ROWS, SCHEMA))
    expected = w.tumbling(batch, ["k"], "rt", "5 seconds", [F.count("*").alias("cnt")])
    columns = ["k", "window_start", "window_end", "cnt"]
    assert rows(got, *columns) == rows(expected, *columns)


def test_session_and_distinct_streams(spark, feed):
    stream = timed(feed([*BATCHES, [("end", 99, FAR, 0)]], SCHEMA))
    uv = w.distinct_per_window(stream, [], "rt", "10 seconds", "v")
    got = run.collect_stream(spark, uv, "uv").where("uv > 1")
    batch = timed(spark.createDataFrame(ROWS, SCHEMA))
    expected = w.distinct_per_window(batch, [], "rt", "10 seconds", "v").where("uv > 1")
    assert rows(got, "window_start", "uv") == rows(expected, "window_start", "uv")


def test_top_n_stream(spark, feed):
    stream = timed(feed([*BATCHES, [("end", 99, FAR, 0)], [("end", 100, 2 * FAR, 0)]], SCHEMA))
    counts = stream.groupBy("k", F.window("rt", "10 seconds").alias("w")).agg(
        F.count("*").alias("cnt")
    )
    got = run.collect_stream(spark, ranking.top_n_stream(counts, "k", "cnt", 1), "topn")
    batch = timed(spark.createDataFrame(ROWS, SCHEMA))
    counted = w.tumbling(batch, ["k"], "rt", "10 seconds", [F.count("*").alias("cnt")])
    expected = ranking.top_n(counted, ["window_end"], "cnt", ["k"], 1)
    columns = ["window_end", "k", "cnt", "rank"]
    assert rows(got.where("k <> 'end'"), *columns) == rows(expected, *columns)


def test_update_mode_log(spark, feed):
    counts = feed(BATCHES, SCHEMA).groupBy("k").agg(F.sum("v").alias("total"))
    log = run.collect_stream(spark, counts, "update", "update")
    assert log.count() > 2
    assert rows(run.latest(log, ["k"]), "k", "total") == [("a", 90), ("b", 19)]


def test_interval_join_stream(spark, feed):
    left = timed(feed([[("a", 0, 100, 1)], [("a", 1, 110, 1)]], SCHEMA, "left"))
    right = timed(feed([[("a", 5, 103, 1)], [("a", 6, 114, 1)]], SCHEMA, "right"))
    joined = joins.interval_join(left, right, ["k"], "rt", "rt", "-5 seconds", "5 seconds")
    got = run.collect_stream(spark, joined.select("l_seq", "r_seq"), "interval")
    assert rows(got, "l_seq", "r_seq") == [(0, 5), (1, 6)]


@pytest.mark.parametrize(
    "processor,columns,expected",
    [
        (
            p.Reduce("v", "long", lambda x, y: x + y),
            "seq long, total long",
            [("a", 0, 10), ("a", 1, 30), ("a", 3, 50), ("a", 5, 60), ("a", 7, 90),
             ("b", 2, 5), ("b", 4, 12), ("b", 6, 19)],
        ),
        (
            p.Distinct("v", "long"),
            "seq long, n long",
            [("a", 0, 1), ("a", 1, 2), ("a", 3, 2), ("a", 5, 2), ("a", 7, 3),
             ("b", 2, 1), ("b", 4, 2), ("b", 6, 2)],
        ),
        (p.CountWindow("v", 3, 2), "firing long, total long",
         [("a", 1, 30), ("a", 2, 50), ("b", 1, 12)]),
        (
            p.RetractCount(),
            "seq long, is_add boolean, cnt long",
            [("a", 0, True, 1), ("a", 1, False, 1), ("a", 1, True, 2), ("a", 3, False, 2),
             ("a", 3, True, 3), ("a", 5, False, 3), ("a", 5, True, 4), ("a", 7, False, 4),
             ("a", 7, True, 5), ("b", 2, True, 1), ("b", 4, False, 1), ("b", 4, True, 2),
             ("b", 6, False, 2), ("b", 6, True, 3)],
        ),
    ],
    ids=["reduce", "distinct", "count_window", "retract"],
)
def test_keyed_state(spark, feed, processor, columns, expected):
    stream = feed(BATCHES, SCHEMA)
    out = p.process(stream, ["k"], processor, columns)
    got = run.collect_stream(spark, out, "keyed").drop("batch")
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_previous(spark, feed):
    stream = feed(BATCHES, SCHEMA)
    schema = "seq long, v long, last_v long"
    out = p.process(stream, ["k"], p.Previous("v", "long"), schema)
    got = run.collect_stream(spark, out, "previous")
    expected = ranking.previous_value(
        spark.createDataFrame(ROWS, SCHEMA), ["k"], "seq", "v", "last_v"
    )
    key = ["seq", "v", "last_v"]
    assert {tuple(r[c] for c in key) for r in got.collect()} == {
        tuple(r[c] for c in key) for r in expected.collect()
    }


def test_match_waiting_stream(spark, feed):
    data = [("a", 0, "l"), ("a", 1, "l"), ("a", 2, "r"), ("b", 3, "r"), ("b", 4, "l"), ("a", 5, "r")]
    schema = "k string, seq long, side string"
    stream = feed([data[:2], data[2:4], data[4:]], schema)
    tagged = stream.withColumn("is_left", F.col("side") == "l")
    out = p.process(
        tagged, ["k"], p.MatchWaiting(), "l_seq long, r_seq long"
    )
    got = run.collect_stream(spark, out, "match")
    batch = spark.createDataFrame(data, schema)
    sides = [batch.where(F.col("side") == s).drop("side") for s in "lr"]
    expected = joins.match_waiting(*sides, ["k"], "seq")["matches"]
    assert rows(got, "l_seq", "r_seq") == rows(expected, "l_seq", "r_seq") == [(1, 2), (4, 3)]


def one_by_one(data):
    return [[r] for r in data]


def test_daily_limit_stream(spark, feed):
    day = 86_400
    data = [("a", i, t, 0) for i, t in enumerate([10, 20, 30, 40, day + 1, day + 2])]
    stream = timed(feed([data[:3], data[3:5], data[5:]], SCHEMA))
    schema = "seq long, route string"
    out = p.process(stream, ["k"], p.DailyLimit(2), schema, "eventTime")
    got = run.collect_stream(spark, out, "limit")
    assert rows(got, "seq", "route") == [
        (0, "pass"), (1, "pass"), (2, "alarm"), (4, "pass"), (5, "pass"),
    ]


def test_repeated_failures_stream(spark, feed):
    # A stream drops rows at or before its watermark, so no time comes three times.
    times = [(100, 0), (101, 0), (105, 0), (106, 0), (106, 0), (107, 1), (109, 0)]
    data = [("a" if i < 6 else "b", i, t, ok) for i, (t, ok) in enumerate(times)]
    stream = timed(feed([*one_by_one(data), [("end", 9, FAR, 1)], [("end", 10, FAR, 1)]], SCHEMA))
    stream = stream.withColumn("ok", F.col("v") == 1)
    schema = "first_seq long, failures long, closed_by string"
    out = p.process(stream, ["k"], p.RepeatedFailures(2000), schema, "eventTime")
    got = run.collect_stream(spark, out, "failures")
    batch = timed(spark.createDataFrame(data, SCHEMA))
    expected = timers.repeated_failures(batch, "k", "rt", "seq", F.col("v") == 1, "2 seconds")
    columns = ["k", "first_seq", "failures", "closed_by"]
    assert rows(got, *columns) == rows(expected, *columns)
    assert len(rows(got, *columns)) == 2


def test_rising_stream(spark, feed):
    """Nine readings of three sensors: all rise, so each raises its alarm once."""
    ids = ["s1"] * 4 + ["s2", "s3", "s2", "s2", "s3"]
    data = [(k, i, 122 + i, 10 * (i + 1)) for i, k in enumerate(ids)]
    stream = timed(feed([*one_by_one(data), [("end", 98, FAR, 1)], [("end", 99, FAR, 1)]], SCHEMA))
    schema = "first_seq long, due long"
    out = p.process(stream, ["k"], p.Rising("v", 5000), schema, "eventTime")
    got = run.collect_stream(spark, out, "rising").where("k <> 'end'")
    assert rows(got, "k", "due") == [("s1", 127_000), ("s2", 131_000), ("s3", 132_000)]
    batch = timed(spark.createDataFrame(data, SCHEMA))
    expected = timers.rising_alarms(batch, "k", "rt", "seq", "v", "5 seconds")
    assert rows(got, "k", "first_seq") == rows(expected, "k", "first_seq")


def test_payment_status_stream(spark, feed):
    from rivulet.plans.cases import payment_status

    schema = "order_id long, seq long, ts long, event_type string"
    data = [
        (1, 0, 10, "create"), (2, 1, 11, "create"), (1, 2, 15, "pay"),
        (3, 3, 16, "pay"), (4, 4, 17, "pay"), (4, 5, 18, "create"),
    ]
    stream = timed(feed([data[:3], data[3:], [(9, 8, FAR, "pay")], [(9, 9, FAR, "create")]], schema))
    out_schema = "status string"
    out = p.process(stream, ["order_id"], p.PaymentStatus(900_000), out_schema, "eventTime")
    got = run.collect_stream(spark, out, "payment").where("order_id < 9")
    batch = timed(spark.createDataFrame(data, schema))
    expected = payment_status(batch, "order_id", "event_type", "rt", 900)
    assert rows(got, "order_id", "status") == rows(expected, "order_id", "status")


def test_timer_after_delay(spark, feed):
    stream = timed(feed([[("a", 0, 1, 0), ("a", 1, 1, 0)], [("a", 2, 50, 0)], [("a", 3, 51, 0)]], SCHEMA))
    out = p.process(
        stream, ["k"], p.After(5000), "due long", "eventTime"
    )
    assert rows(run.collect_stream(spark, out, "after"), "due") == [(6000,)]


def test_late_rows_are_routed(spark, feed):
    batches = [[("a", 0, 1, 0)], [("a", 1, 30, 0)], [("a", 2, 2, 0)], [("a", 3, 31, 0)]]
    stream = timed(feed(batches, SCHEMA), "3 seconds")
    schema = "seq long, ms long, route string"
    out = p.process(stream, ["k"], p.RouteLate(5000, 2000), schema, "processingTime")
    kept, late = [], []
    sinks = {
        "main": lambda b, i: kept.extend(r["seq"] for r in b.collect()),
        "late": lambda b, i: late.extend(r["seq"] for r in b.collect()),
    }
    # In processing-time mode a stream goes on without new data, so it is stopped here.
    folder = run.run_folder(spark, "late")
    query = run.start(out, run.fan_out(sinks), folder, interval="1 second")
    deadline = time.monotonic() + 60
    while len(kept) + len(late) < 4 and time.monotonic() < deadline:
        time.sleep(0.5)
    query.stop()
    assert sorted(kept) == [0, 1, 3] and late == [2]


def test_latest_control(spark, feed, tmp_path):
    control = spark.createDataFrame([(1, "1"), (2, "0")], "seq long, c string")
    out = []
    sink = run.with_latest_control(
        lambda: control, "seq", "c", "switch", lambda b, i: out.extend(r["switch"] for r in b.collect())
    )
    query = run.start(feed([[("a", 0, 0, 0)]], SCHEMA), sink, run.run_folder(spark, "control"))
    query.awaitTermination()
    assert out == ["0"]


def test_control_by_arrival_over_batches(spark, feed, tmp_path):
    folder, out = run.run_folder(spark, "arrival"), []
    sink = run.with_control_by_arrival(
        folder, "s", F.col("k") == "c", F.col("v"), "switch",
        lambda b, i: out.extend((r["s"], r["switch"]) for r in b.collect()), spark,
    )
    stream = feed([[("a", 0, 0, 1)], [("c", 0, 1, 7), ("a", 0, 2, 1), ("c", 0, 3, 8)], [("a", 0, 4, 1)], [("a", 0, 5, 1), ("c", 0, 6, None), ("a", 0, 7, 1)], [("a", 0, 8, 1)]], SCHEMA)
    names = stream.columns
    stream = stream.toDF("k", "t", "s", "v") if len(names) == 4 else stream
    run.start(stream, sink, f"{folder}/checkpoint").awaitTermination()
    assert sorted(out, key=lambda r: r[0]) == [(0, None), (2, 7), (4, 8), (5, 8), (7, None), (8, None)]


def test_restart_continues_state(spark, feed, tmp_path):
    stream = feed([[("a", 0, 0, 10)]], SCHEMA)
    totals = stream.groupBy("k").agg(F.sum("v").alias("total"))
    folder, seen = run.run_folder(spark, "restart"), []

    def sink(batch, batch_id):
        seen.extend(r["total"] for r in batch.collect())

    run.start(totals, sink, folder, "update").awaitTermination()
    path = tmp_path / "in" / "next.csv"
    path.write_text("a,1,1,5")
    run.start(totals, sink, folder, "update").awaitTermination()
    assert seen == [10, 15]
