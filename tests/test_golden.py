"""Expected values on small inputs."""

import pytest
from pyspark.sql import functions as F

from rivulet import schemas
from rivulet.operators import aggregates as a
from rivulet.operators import ordered as o
from rivulet.operators import ranking, timers
from rivulet.operators import transforms as t
from rivulet.operators import windows as w
from rivulet.operators.patterns import NEXT, Stage, match_pattern
from rivulet.plans.cases import payment_status

T0 = 1549044122
IDS = ["sensor_1"] * 4 + ["sensor_2", "sensor_3", "sensor_2", "sensor_2", "sensor_3"]


@pytest.fixture(scope="module")
def sensors(spark):
    """Nine readings, one per second, each ten higher than the one before."""
    rows = [(k, T0 + i, 10 * (i + 1), i) for i, k in enumerate(IDS)]
    df = spark.createDataFrame(rows, schemas.SENSOR + ", seq long")
    return df.withColumn("rt", F.timestamp_seconds("ts"))


def test_word_count(spark):
    text = "hello java\nhello scala\nhello hadoop\nhello you\nhow are you"
    lines = spark.createDataFrame([(x,) for x in text.split("\n")], "value string")
    counts = t.explode_tokens(lines).groupBy("word").count().collect()
    assert {r["word"]: r["count"] for r in counts} == {
        "hello": 4, "you": 2, "java": 1, "scala": 1, "hadoop": 1, "how": 1, "are": 1,
    }


def test_running_max_keeps_other_fields_of_the_first_row(sensors):
    got = a.running_agg(
        sensors.drop("rt"), ["id"], "seq", {"top": o.running_max(F.col("vc"))}, ["ts"]
    ).orderBy("seq").collect()
    assert [r["top"] for r in got] == [10, 20, 30, 40, 50, 60, 70, 80, 90]
    assert [r["ts"] - T0 for r in got] == [0, 0, 0, 0, 4, 5, 4, 4, 5]


def counted(df):
    rows = df.select("id", F.unix_seconds("window_start").alias("s"), "cnt").collect()
    return sorted((r["id"][-1], r["s"] - 1549044000, r["cnt"]) for r in rows)


def test_tumbling_five_seconds(sensors):
    got = counted(w.tumbling(sensors, ["id"], "rt", "5 seconds", [F.count("*").alias("cnt")]))
    assert got == [("1", 120, 3), ("1", 125, 1), ("2", 125, 3), ("3", 125, 1), ("3", 130, 1)]


def test_sliding_five_by_two_seconds(sensors):
    got = counted(
        w.sliding(sensors, ["id"], "rt", "5 seconds", "2 seconds", [F.count("*").alias("cnt")])
    )
    assert got == [
        ("1", 118, 1), ("1", 120, 3), ("1", 122, 4), ("1", 124, 2),
        ("2", 122, 1), ("2", 124, 2), ("2", 126, 3), ("2", 128, 2),
        ("3", 124, 1), ("3", 126, 2), ("3", 128, 1), ("3", 130, 1),
    ]


def test_count_window_five_by_two(sensors):
    got = w.count_sliding(sensors, ["id"], "seq", 5, 2, {"n": F.count("*")}).collect()
    assert sorted((r["id"][-1], r["n"]) for r in got) == [("1", 2), ("1", 4), ("2", 2), ("3", 2)]


def test_tags(sensors):
    vc = F.col("vc")
    rules = [(vc < 50, ["normal", "low"]), (vc < 80, ["warn", "low"]), (F.lit(True), ["alarm"])]
    tagged = t.tag(sensors, rules)
    counts = {x: t.select_tag(tagged, x).count() for x in ("normal", "warn", "alarm", "low")}
    assert counts == {"normal": 4, "warn": 3, "alarm": 2, "low": 7}
    routed = t.side_output(sensors, vc > 50, F.col("id"))
    assert routed["side"].count() == 4 and routed["main"].count() == 5


def test_rising_alarm_times(sensors):
    got = timers.rising_alarms(sensors, "id", "rt", "seq", "vc", "5 seconds").collect()
    assert sorted((r["id"][-1], int(r["alarm_ts"].timestamp()) - T0) for r in got) == [
        ("1", 5), ("2", 9), ("3", 10),
    ]


def test_union_and_even(spark):
    frames = [spark.createDataFrame([(i,) for i in x], "n int") for x in ((1, 2, 3, 4), (5, 6, 7, 8), (15, 16, 17, 18))]
    every = t.union(*frames)
    assert every.count() == 12
    assert sorted(r["n"] for r in frames[0].where("n % 2 = 0").collect()) == [2, 4]


def test_clicks_of_one_user_pass_a_hundred_times(spark):
    from rivulet.plans.cases import daily_limit

    day = 1511658000
    rows = [(937166, 1715, "beijing", "beijing", day + i) for i in range(121)]
    rows += [(1000 + i, 2000 + i, "shanghai", "shanghai", day + i) for i in range(22)]
    clicks = spark.createDataFrame(rows, schemas.AD_CLICK).withColumn("rt", F.timestamp_seconds("ts"))
    clicks = clicks.withColumn("seq", F.col("ts") * 10_000 + F.col("user_id") % 10_000)
    out = daily_limit(clicks, ["user_id", "ad_id"], "rt", "seq", 100)
    assert out["pass"].count() == 122
    assert [r["user_id"] for r in out["alarm"].collect()] == [937166]
    counts = w.sliding_from_panes(
        clicks, ["province", "ad_id"], "rt", "1 hour", "5 minutes", {"cnt": F.lit(1)}
    )
    best = ranking.top_n(counts, ["window_end"], "cnt", ["province", "ad_id"], 1)
    assert {(r["province"], r["cnt"]) for r in best.collect()} >= {("beijing", 121)}


def test_login_order_decides(spark):
    """Two failures one second apart: seen in event time, not as they arrive around a success."""
    rows = [(1035, "fail", 43, 0), (1035, "success", 44, 1), (1035, "fail", 42, 2)]
    df = spark.createDataFrame(rows, "user_id long, kind string, ts long, seq long")
    df = df.withColumn("rt", F.timestamp_seconds("ts"))
    fail = F.col("kind") == "fail"
    pairs = match_pattern(
        df, ["user_id"], "rt", "seq", [Stage("a", fail), Stage("b", fail, NEXT)], "3 seconds"
    )["matches"]
    assert [(r["a"]["ts"], r["b"]["ts"]) for r in pairs.collect()] == [(42, 43)]
    alarms = timers.repeated_failures(
        df, "user_id", "rt", "seq", ~fail, "2 seconds", 2, "10 seconds"
    )
    assert alarms.count() == 0


def test_payment_limits(spark):
    """Exactly at the limit: paid by the status rule, timed out for the pattern."""
    rows = [
        (1, "create", 0, 0), (1, "pay", 900, 1), (2, "create", 0, 2), (2, "pay", 1038, 3),
        (3, "create", 5, 4), (4, "pay", 6, 5), (5, "create", 7, 6), (5, "pay", 7, 7),
    ]
    df = spark.createDataFrame(rows, "order_id long, event_type string, ts long, seq long")
    df = df.withColumn("rt", F.timestamp_seconds("ts"))
    status = payment_status(df, "order_id", "event_type", "rt", 900).collect()
    assert {r["order_id"]: r["status"] for r in status} == {
        1: "paid", 2: "paid_late", 3: "pay_timeout", 4: "create_missing", 5: "paid",
    }
    stages = [
        Stage("create", F.col("event_type") == "create"),
        Stage("pay", F.col("event_type") == "pay"),
    ]
    out = match_pattern(df, ["order_id"], "rt", "seq", stages, "900 seconds")
    assert [r["order_id"] for r in out["matches"].collect()] == [5]
    assert sorted(r["order_id"] for r in out["timeouts"].collect()) == [1, 2, 3]


def test_approximate_visitors_stay_close(spark):
    users = spark.range(20_000).select((F.col("id") % 5_000).alias("u"), F.lit(1).alias("g"))
    got = a.approx_distinct(users, ["g"], F.col("u"), 0.01).first()["uv"]
    assert abs(got - 5_000) < 150


def test_arrival_order_does_not_change_windows(spark):
    rows = [("k", i, 37 * i % 100) for i in range(100)]
    schema = "k string, seq long, ts long"
    results = []
    for order in (rows, rows[::-1], sorted(rows, key=lambda r: r[2])):
        df = spark.createDataFrame(order, schema).withColumn("rt", F.timestamp_seconds("ts"))
        out = w.sliding_from_panes(df, ["k"], "rt", "20 seconds", "10 seconds", {"cnt": F.lit(1)})
        results.append(sorted(out.collect()))
    assert results[0] == results[1] == results[2]


def test_processing_time_windows(spark):
    stream = spark.readStream.format("rate").load().withColumn("k", F.lit("a"))
    out = w.processing_time_windows(stream, ["k"], "5 seconds", [F.count("*").alias("cnt")])
    assert out.isStreaming and out.columns == ["k", "window_start", "window_end", "cnt"]
