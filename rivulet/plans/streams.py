"""The same questions asked of the event table read as a stream.

Each query runs the stream over the data available now, with its own checkpoint below the
shared folder, and reads back what it wrote. Results in update mode are kept as a log, of
which the last version of every key counts, so windows still open at the end are seen too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import joins
from rivulet.operators import ordered as o
from rivulet.operators import transforms as t
from rivulet.operators import windows as w
from rivulet.operators.patterns import NEXT, Stage
from rivulet.plans.registry import SQL, events, query
from rivulet.session import run_folder
from rivulet.sources.streams import table_stream
from rivulet.streaming import incremental as inc
from rivulet.streaming import processors as p
from rivulet.streaming import run


def _stream(spark, sf_dir, *more):
    """Events as a stream, with ``rt`` as event time, ``ms`` and ``seq``."""
    schema = events(spark, sf_dir).schema
    stream = table_stream(spark, f"{sf_dir}/events.parquet", schema)
    rt = F.col("ts").cast("timestamp")
    return stream.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("event_id").alias("seq"),
        rt.alias("rt"),
        F.unix_millis(rt).alias("ms"),
        *more,
    )


def _ntz(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


@query("stream_running_totals", "select event_type, count(*) as cnt from events group by event_type")
def stream_running_totals(spark, sf_dir):
    counts = _stream(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("cnt"))
    return run.latest(run.collect_stream(spark, counts, "totals", "update"), ["event_type"])


@query("stream_tumbling_count", SQL["tumbling_count"])
def stream_tumbling_count(spark, sf_dir):
    timed = _stream(spark, sf_dir).withWatermark("rt", "0 seconds")
    counts = w.tumbling(timed, ["user_id"], "rt", "6 hours", [F.count("*").alias("cnt")])
    log = run.collect_stream(spark, counts, "tumbling", "update")
    keys = ["user_id", "window_start", "window_end"]
    return _ntz(run.latest(log, keys), "window_start", "window_end")


@query("stream_sliding_hop", SQL["sliding_hop"])
def stream_sliding_hop(spark, sf_dir):
    timed = _stream(spark, sf_dir).withWatermark("rt", "0 seconds")
    counts = w.sliding(
        timed, ["event_type"], "rt", "3 hours", "1 hour", [F.count("*").alias("cnt")]
    )
    log = run.collect_stream(spark, counts, "sliding", "update")
    keys = ["event_type", "window_start", "window_end"]
    return _ntz(run.latest(log, keys), "window_start", "window_end")


@query("stream_unique_visitors", SQL["unique_visitors_hourly"])
def stream_unique_visitors(spark, sf_dir):
    views = _stream(spark, sf_dir).where("event_type = 'view'").withWatermark("rt", "0 seconds")
    # Duplicates are dropped per hour on the stream; the hours are counted from its log.
    hour = F.window("rt", "1 hour").alias("w")
    once = views.select(hour, "user_id").dropDuplicates(["w", "user_id"])
    log = run.collect_stream(spark, once, "visitors")
    counted = log.groupBy("w").agg(F.count("user_id").alias("uv"))
    return _ntz(
        counted.select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uv"
        ),
        "window_start",
        "window_end",
    )


@query("stream_interval_join", SQL["interval_join"])
def stream_interval_join(spark, sf_dir):
    def kind(name):
        e = _stream(spark, sf_dir).where(F.col("event_type") == name)
        return e.select("user_id", "event_id", "rt").withWatermark("rt", "0 seconds")

    joined = joins.interval_join(
        kind("click"), kind("purchase"), ["user_id"], "rt", "rt", "-6 hours", "6 hours"
    )
    pairs = joined.select(
        F.col("l_user_id").alias("user_id"),
        F.col("l_event_id").alias("click_id"),
        F.col("r_event_id").alias("purchase_id"),
    )
    return run.collect_stream(spark, pairs, "interval").drop("batch")


def _processed(spark, stream, keys, processor, columns, name, time_mode="none"):
    out = p.process(stream, keys, processor, columns, time_mode)
    return run.collect_stream(spark, out, name).drop("batch")


@query(
    "stream_reduce",
    """select user_id, event_id as seq, max(value) over (partition by user_id order by event_id
              rows unbounded preceding) as highest from events""",
)
def stream_reduce(spark, sf_dir):
    stream = _stream(spark, sf_dir).select("user_id", "seq", "value")
    values = {"highest": o.running_max(F.col("value"))}
    out = inc.collect_incremental(spark, stream, "reduce", inc.RunningValues, ["user_id"], "seq", values)
    return out.drop("value")


@query(
    "stream_distinct",
    SQL["running_distinct"].replace("select event_id, event_type", "select event_id as seq, event_type"),
)
def stream_distinct(spark, sf_dir):
    stream = _stream(spark, sf_dir).select("event_type", "seq", "user_id")
    out = inc.collect_incremental(
        spark, stream, "distinct", inc.DistinctSoFar, ["event_type"], "seq", "user_id"
    )
    return out.drop("user_id")


@query(
    "stream_previous",
    """select user_id, event_id as seq, value, lag(value) over (partition by user_id
              order by event_id) as last_value from events""",
)
def stream_previous(spark, sf_dir):
    stream = _stream(spark, sf_dir).select("user_id", "seq", "value")
    values = {"last_value": o.previous(F.col("value"))}
    return inc.collect_incremental(spark, stream, "previous", inc.RunningValues, ["user_id"], "seq", values)


@query("stream_count_window", SQL["count_window_sliding"])
def stream_count_window(spark, sf_dir):
    stream = _stream(spark, sf_dir).select("user_id", "seq", "event_id")
    return inc.collect_incremental(
        spark, stream, "count_window", inc.CountWindows, ["user_id"], "seq", "event_id", 5, 2
    )


@query(
    "stream_retract",
    "select event_type, event_id as seq, is_add, cnt from (" + SQL["retract_changelog"] + ")",
)
def stream_retract(spark, sf_dir):
    stream = _stream(spark, sf_dir).select("event_type", "seq")
    counts = {"_n": o.running_count()}
    out = inc.collect_incremental(spark, stream, "retract", inc.RunningValues, ["event_type"], "seq", counts)
    # The old count goes, the new one comes.
    change = lambda add, n: F.struct(F.lit(add).alias("is_add"), n.alias("cnt"))
    n = F.col("_n")
    new = F.array(change(True, n))
    both = F.when(n > 1, F.array(change(False, n - 1), change(True, n))).otherwise(new)
    return out.select("event_type", "seq", F.inline(both))


@query("stream_lateness_firings", SQL["lateness_firings"])
def stream_lateness_firings(spark, sf_dir):
    delay = (F.col("event_id") * 7919 % 7200) * 1_000_000
    arrival = (F.unix_micros("rt") + delay) * 1000 + F.col("event_id") % 1000
    stream = _stream(spark, sf_dir).select("event_type", "rt", arrival.alias("seq"))
    out = inc.collect_incremental(
        spark, stream, "firings", inc.Firings, ["event_type"], "rt", "seq", "1 hour", "1 hour", "10 minutes"
    )
    return _ntz(out, "window_start", "window_end")


def _patterns(spark, sf_dir, stages, within=None):
    stream = _stream(spark, sf_dir).select("user_id", "event_type", "rt", "seq")
    return inc.collect_incremental(
        spark, stream, "patterns", inc.Patterns, ["user_id"], "rt", "seq", stages, within
    )


def _found(out, kind, *names):
    ids = [F.col(f"{n}.seq").alias(f"{n}_id") for n in names]
    return out.where(F.col("kind") == kind).select("user_id", *ids)


def _is(kind):
    return F.col("event_type") == kind


def _clicks_then_purchases(spark, sf_dir):
    stages = [Stage("start", _is("click")), Stage("then", _is("purchase"))]
    return _patterns(spark, sf_dir, stages, "6 hours")


@query("stream_cep_next", SQL["cep_next"])
def stream_cep_next(spark, sf_dir):
    stages = [Stage("start", _is("error")), Stage("then", _is("error"), NEXT)]
    return _found(_patterns(spark, sf_dir, stages), "match", "start", "then")


@query("stream_cep_followed_by", SQL["cep_followed_by"])
def stream_cep_followed_by(spark, sf_dir):
    return _found(_clicks_then_purchases(spark, sf_dir), "match", "start", "then")


@query("stream_cep_timeouts", SQL["cep_timeouts"])
def stream_cep_timeouts(spark, sf_dir):
    out = _clicks_then_purchases(spark, sf_dir).where("kind = 'timeout'")
    return _ntz(out.select("user_id", F.col("start.seq").alias("start_id"), "timeout_ts"), "timeout_ts")


@query("stream_hot_items_topn", SQL["hot_items_topn"])
def stream_hot_items_topn(spark, sf_dir):
    views = _stream(spark, sf_dir, "props").where(_is("view"))
    k = F.get_json_object("props", "$.k").cast("int")
    items = views.select("rt", F.floor(k / 10).cast("int").alias("item"))
    out = inc.collect_incremental(
        spark, items, "hot_items", inc.TopWindows, "item", "rt", "1 hour", "5 minutes", 3
    )
    return _ntz(out, "window_end")


@query("stream_over_range_count", SQL["over_range_count"])
def stream_over_range_count(spark, sf_dir):
    day = F.date_trunc("day", "rt").alias("rt")
    stream = _stream(spark, sf_dir).select("user_id", "event_id", day)
    out = inc.collect_incremental(spark, stream, "over", inc.OverRange, ["user_id"], "rt", "user_id", "cnt")
    return out.select("user_id", "event_id", "cnt")


@query("stream_reconcile_unmatched", SQL["reconcile_unmatched"])
def stream_reconcile_unmatched(spark, sf_dir):
    """Clicks and purchases that wait at the end of the input."""
    sides = _stream(spark, sf_dir).where("event_type in ('click', 'purchase')")
    stream = sides.select("user_id", "seq", "rt", _is("click").alias("is_left"))
    out = inc.collect_incremental(spark, stream, "unmatched", inc.Waiting, ["user_id"], "seq")
    alone = out.where(F.col("left").isNull() | F.col("right").isNull())
    return alone.select("user_id", F.coalesce("left", "right").alias("event_id"), F.col("left").isNotNull().alias("is_click"))


@query("stream_reconcile", SQL["reconcile_connect"])
def stream_reconcile(spark, sf_dir):
    sides = _stream(spark, sf_dir).where("event_type in ('click', 'purchase')")
    stream = sides.select("user_id", "seq", (F.col("event_type") == "click").alias("is_left"))
    columns = "click_id long, purchase_id long"
    return _processed(spark, stream, ["user_id"], p.MatchWaiting(), columns, "reconcile")


@query(
    "stream_blacklist",
    """select user_id, event_type, event_id as seq, case when n <= 2 then 'pass' else 'alarm' end as route
       from (select *, row_number() over (partition by user_id, event_type, ts::date
                                          order by event_id) as n from events) where n <= 3""",
)
def stream_blacklist(spark, sf_dir):
    timed = _stream(spark, sf_dir).withWatermark("rt", "0 seconds")
    stream = timed.select("user_id", "event_type", "seq", "ms", "rt")
    return _processed(
        spark,
        stream,
        ["user_id", "event_type"],
        p.DailyLimit(2),
        "seq long, route string",
        "blacklist",
        "eventTime",
    )


@query(
    "stream_side_output",
    """select event_id, 'main' as route from events where not value > 50 union all
       select event_id, 'side' from events where value > 50""",
)
def stream_side_output(spark, sf_dir):
    """Both outputs of one stream, written by their own sinks."""
    route = F.when(F.col("value") > 50, "side").otherwise("main").alias("route")
    stream = _stream(spark, sf_dir).select("event_id", route)
    folder = run_folder(spark, "routes")
    sinks = {r: run.parquet_log(f"{folder}/{r}") for r in ("main", "side")}
    run.start(stream, run.fan_out(sinks), f"{folder}/checkpoint").awaitTermination()
    parts = [
        spark.read.schema("event_id long").parquet(f"{folder}/{r}").select(
            "event_id", F.lit(r).alias("route")
        )
        for r in sinks
    ]
    return t.union(*parts)


@query("stream_control", SQL["broadcast_control"])
def stream_control(spark, sf_dir):
    """Rows with the control value that arrived last before them, in one stream of both."""
    folder = run_folder(spark, "control")
    is_control = F.col("event_type") == "signup"
    value = F.when(F.col("user_id") % 2 == 1, "true").otherwise("false")
    sink = run.with_control_by_arrival(
        folder, "event_id", is_control, value, "switch", run.parquet_log(f"{folder}/out"), spark
    )
    stream = _stream(spark, sf_dir).select("event_id", "event_type", "user_id")
    run.start(stream, sink, f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema("event_id long, switch string").parquet(f"{folder}/out").select(
        "event_id", "switch"
    )
