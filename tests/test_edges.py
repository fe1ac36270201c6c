"""Empty tables, nulls, long values and ties: what the test tables do not hold."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.functions.time import floor_div
from rivulet.operators import aggregates as agg
from rivulet.operators import ordered as o
from rivulet.operators import transforms as t
from rivulet.operators import windows as w
from rivulet.plans import QUERIES
from rivulet.streaming import run

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
BIG = 10**18


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("events", "orders", "lineitem"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize(
    "name",
    [
        "late_status", "late_side", "late_main", "lateness_firings", "page_views_running",
        "unique_visitors_running", "login_fail_process", "rising_level_alarm", "broadcast_control",
        "cep_unkeyed", "running_ties", "session_null_times", "sliding_panes", "whole_window",
    ],
)
def test_queries_on_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("kind", ["string", "double", "timestamp", "boolean", "decimal(20,3)"])
def test_any_order_gives_the_same_rows_in_chunks(spark, kind):
    base = spark.range(2000).withColumn("k", F.col("id") % 3)
    made = {
        "string": F.concat(F.lit("x"), F.col("id") % 70),
        "double": F.when(F.col("id") % 9 == 0, float("nan")).otherwise((F.col("id") * 37 % 50) / 7 - 3),
        "timestamp": F.timestamp_seconds(F.col("id") * 7 % 40),
        "boolean": F.col("id") % 2 == 0,
        "decimal(20,3)": (F.col("id") * 13 % 60).cast("decimal(20,3)"),
    }[kind]
    df = base.withColumn("at", F.when(F.col("id") % 11 > 0, made))
    values = {
        "n": o.running_count(),
        "before": o.previous(F.col("id")),
        "last": o.last_seen(F.when(F.col("id") % 5 == 0, F.col("id")), before=True),
    }
    for keys in (["k"], []):
        plain = o.running(df, keys, ["at", "id"], values, plan=o.Layout(tuple(keys), ("at", "id")))
        for size in (25, 300):
            plan = o.layout(df, keys, ["at", "id"], size)
            assert len(plan.splits) >= 2000 // 3 // size - 1
            split = o.running(df, keys, ["at", "id"], values, plan=plan)
            assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))


def test_rows_of_one_time_are_spread(spark):
    df = spark.range(2000).withColumn("k", F.lit(1)).withColumn("at", F.lit(5))
    plan = o.layout(df, ["k"], ["at", "id"], 100)
    sizes = [r["count"] for r in plan.tag(df).groupBy(o.CHUNK).count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 400


def test_floating_sums_are_refused_and_decimals_are_not(spark):
    df = spark.range(10).withColumn("v", F.col("id") / 3)
    with pytest.raises(ValueError):
        o.running(df, [], ["id"], {"s": o.running_sum(F.col("v"))})
    exact = o.running(df, [], ["id"], {"s": o.running_sum(F.col("v").cast("decimal(18,6)"))})
    assert exact.agg(F.max("s")).first()[0] is not None


WIDE = [(BIG + 1, 1, BIG + 3), (BIG + 2, 2, None), (None, 3, BIG + 4), (BIG + 1, 4, BIG + 5), (None, 5, None)]


def test_accumulator_keeps_long_keys_apart_beside_nulls(spark):
    df = spark.createDataFrame(WIDE, "k long, n int, v long")
    got = agg.accumulate(
        df,
        ["k"],
        lambda g: g.agg(n=("n", "size"), top=("v", "max")),
        lambda g: g.agg(n=("n", "sum"), top=("top", "max")),
        "n long, top long",
        {"n": F.col("n"), "top": F.col("top")},
    ).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(BIG + 1, 2, BIG + 5), (BIG + 2, 1, None), (None, 2, BIG + 4)], key=repr
    )


def test_map_with_setup_keeps_long_values(spark):
    df = spark.createDataFrame(WIDE, "k long, n int, v long")
    got = t.map_with_setup(df, lambda: 1, lambda one, b: b.assign(v=b["v"] + one)[["n", "v"]], "n int, v long")
    assert sorted(map(tuple, got.collect())) == [(1, BIG + 4), (2, None), (3, BIG + 5), (4, BIG + 6), (5, None)]


def test_window_function_keeps_long_values(spark):
    df = spark.createDataFrame(WIDE, "k long, n int, v long").withColumn("at", F.timestamp_seconds("n"))

    def widest(key, batches):
        rows = pd.concat(list(batches))
        yield pd.DataFrame({"k": pd.array([key[0]], "Int64"), "v": pd.array([rows["v"].max()], "Int64")})

    got = w.process_window(df, ["k"], "at", "1 minute", widest, "k long, v long").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(BIG + 1, BIG + 5), (BIG + 2, None), (None, BIG + 4)], key=repr)


@pytest.mark.parametrize("rows_per_chunk", [3, None])
def test_rows_without_time_are_in_no_session(spark, rows_per_chunk):
    rows = [(1, s, i) for i, s in enumerate([None, 10, 12, None, 100, None, 101])]
    df = spark.createDataFrame(rows, "k long, s int, seq long").withColumn("at", F.timestamp_seconds("s"))
    n = [F.count("*").alias("n")]
    plain = w.session(df, ["k"], "at", "5 seconds", n)
    split = w.session_split(df, ["k"], "at", "seq", "5 seconds", n, rows_per_chunk)
    assert sorted(split.select("n").collect()) == sorted(plain.select("n").collect()) == [(2,), (2,)]


def test_pane_sums_of_nulls_are_null(spark):
    rows = [(1, 0, 5), (1, 2, None), (1, 3, None), (2, 0, None), (2, 9, 7)]
    df = spark.createDataFrame(rows, "k long, s int, v long").withColumn("at", F.timestamp_seconds("s"))
    panes = w.sliding_from_panes(df, ["k"], "at", "2 seconds", "1 second", {"total": F.col("v")})
    plain = w.sliding(df, ["k"], "at", "2 seconds", "1 second", [F.sum("v").alias("total")])
    assert sorted(map(repr, panes.collect())) == sorted(map(repr, plain.select(*panes.columns).collect()))


def test_division_of_large_values_is_exact(spark):
    values = [2**62 + 1, -(2**62) - 1, -1, 0, 7]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = df.select("v", floor_div(F.col("v"), 1000).alias("q")).collect()
    assert {r.v: r.q for r in got} == {v: v // 1000 for v in values}


def test_a_stream_without_rows_gives_none(spark, tmp_path):
    folder = str(tmp_path / "in")
    os.makedirs(folder)
    stream = spark.readStream.schema("a long, b string").parquet(folder)
    assert run.collect_stream(spark, stream, "nothing").collect() == []
