"""Windows, late data and ranking over the event table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from rivulet.operators import aggregates as agg
from rivulet.operators import eventtime, ranking
from rivulet.operators import ordered as o
from rivulet.operators import windows as w
from rivulet.plans.registry import events, query, with_k


def hop(source: str, keys: str, size: int, slide: int, aggs: str) -> str:
    """SQL for a sliding window of ``size`` and ``slide`` seconds over ``source``'s ``ts``."""
    size_us, slide_us = size * 1_000_000, slide * 1_000_000
    copies = -(-size // slide)
    head = f"{keys}, " if keys else ""
    return f"""
        select {head}make_timestamp(start) as window_start,
               make_timestamp(start + {size_us}) as window_end, {aggs}
        from (select s.*, (epoch_us(ts) // {slide_us} - step) * {slide_us} as start
              from {source} s cross join (select unnest(range({copies})) as step))
        where start + {size_us} > epoch_us(ts)
        group by {head}start"""


def _count():
    return [F.count("*").alias("cnt")]


@query("tumbling_count", hop("events", "user_id", 21600, 21600, "count(*) as cnt"))
def tumbling_count(spark, sf_dir):
    return w.tumbling(events(spark, sf_dir), ["user_id"], "ts", "6 hours", _count())


@query("sliding_hop", hop("events", "event_type", 10800, 3600, "count(*) as cnt"))
def sliding_hop(spark, sf_dir):
    return w.sliding(events(spark, sf_dir), ["event_type"], "ts", "3 hours", "1 hour", _count())


@query("sliding_uneven", hop("events", "event_type", 18000, 7200, "count(*) as cnt"))
def sliding_uneven(spark, sf_dir):
    """The slide need not divide the size."""
    return w.sliding(events(spark, sf_dir), ["event_type"], "ts", "5 hours", "2 hours", _count())


@query("sliding_panes", hop("events", "user_id", 86400, 3600, "count(*)::bigint as cnt"))
def sliding_panes(spark, sf_dir):
    e = events(spark, sf_dir)
    return w.sliding_from_panes(e, ["user_id"], "ts", "24 hours", "1 hour", {"cnt": F.lit(1)})


@query(
    "sliding_panes_null_values",
    hop("(select *, case when user_id % 3 > 0 then event_id end as v from events)", "user_id", 86400, 3600,
        "sum(v)::bigint as total"),
)
def sliding_panes_null_values(spark, sf_dir):
    """A window whose values are all null has a null sum."""
    e = events(spark, sf_dir).withColumn("v", F.when(F.col("user_id") % 3 > 0, F.col("event_id")))
    return w.sliding_from_panes(e, ["user_id"], "ts", "24 hours", "1 hour", {"total": F.col("v")})


@query("sql_hop", hop("events", "event_type as id", 10800, 1800, "count(user_id) as cnt").replace(
    "group by event_type as id", "group by event_type"))
def sql_hop(spark, sf_dir):
    return spark.sql(
        """select event_type as id, w.start as window_start, w.end as window_end, cnt from (
             select event_type, window(ts, '3 hours', '30 minutes') as w, count(user_id) as cnt
             from {e} group by event_type, window(ts, '3 hours', '30 minutes'))""",
        e=events(spark, sf_dir),
    )


_SESSIONS = """
    select user_id, min(ts) as window_start, max(ts) + interval 6 hours as window_end,
           count(*) as cnt
    from (select *, sum(opens) over (partition by user_id order by ts, event_id
                                     rows unbounded preceding) as session
          from (select *, coalesce(ts > lag(ts) over (partition by user_id order by ts, event_id)
                                        + interval 6 hours, true)::int as opens from events))
    group by user_id, session"""


@query("session_gap", _SESSIONS)
def session_gap(spark, sf_dir):
    e = events(spark, sf_dir).select("user_id", "ts", "event_id")
    return w.session(e, ["user_id"], "ts", "6 hours", _count(), seq="event_id")


@query("session_gap_split", _SESSIONS)
def session_gap_split(spark, sf_dir):
    e = events(spark, sf_dir).select("user_id", "ts", "event_id")
    return w.session_split(e, ["user_id"], "ts", "event_id", "6 hours", _count())


def _some_times(spark, sf_dir):
    late = F.when(F.col("event_id") % 5 > 0, F.col("ts")).alias("ts")
    return events(spark, sf_dir).select("user_id", late, "event_id")


@query("session_null_times", _SESSIONS.replace("from events", "from (select * from events where event_id % 5 > 0)"))
def session_null_times(spark, sf_dir):
    """Rows without a time are in no session, in the split plan too."""
    e = _some_times(spark, sf_dir)
    return w.session_split(e, ["user_id"], "ts", "event_id", "6 hours", _count(), rows_per_chunk=250)


@query(
    "count_window_tumbling",
    """select user_id, (rn - 1) // 5 + 1 as pane, sum(event_id)::bigint as total
       from (select *, row_number() over (partition by user_id order by event_id) as rn from events)
       group by user_id, (rn - 1) // 5 having count(*) = 5""",
)
def count_window_tumbling(spark, sf_dir):
    total = F.sum("event_id").alias("total")
    return w.count_tumbling(events(spark, sf_dir), ["user_id"], "event_id", 5, [total])


@query(
    "count_window_sliding",
    """select user_id, rn // 2 as firing, total from (
         select user_id, row_number() over (partition by user_id order by event_id) as rn,
                sum(event_id) over (partition by user_id order by event_id
                                    rows between 4 preceding and current row)::bigint as total
         from events) where rn % 2 = 0""",
)
def count_window_sliding(spark, sf_dir):
    total = {"total": o.running_sum(F.col("event_id"))}
    return w.count_sliding(events(spark, sf_dir), ["user_id"], "event_id", 5, 2, total)


@query(
    "count_window_sliding_max",
    """select user_id, rn // 20 as firing, highest from (
         select user_id, row_number() over (partition by user_id order by event_id) as rn,
                max(value) over (partition by user_id order by event_id
                                 rows between 99 preceding and current row) as highest
         from events) where rn % 20 = 0""",
)
def count_window_sliding_max(spark, sf_dir):
    e = events(spark, sf_dir).select("user_id", "event_id", "value")
    return w.count_sliding(e, ["user_id"], "event_id", 100, 20, {"highest": F.max("value")})


@query("window_all", hop("events", "", 3600, 3600, "count(*) as cnt"))
def window_all(spark, sf_dir):
    return w.tumbling(events(spark, sf_dir), [], "ts", "1 hour", _count())


@query(
    "whole_window",
    hop("events", "event_type", 86400, 86400, "count(*) as cnt, quantile_disc(event_id, 0.5) as middle"),
)
def whole_window(spark, sf_dir):
    """A function of all rows of a window, the middle id, without holding them together."""
    e = events(spark, sf_dir).select("event_type", "event_id", "ts")
    middle = F.floor((F.col("cnt") + 1) / 2)
    found = w.rows_at_rank(e, ["event_type"], "ts", "1 day", ["event_id"], middle)
    return found.select("event_type", "window_start", "window_end", "cnt", F.col("event_id").alias("middle"))


@query(
    "process_window",
    hop("events", "event_type", 86400, 86400,
        "count(*) as cnt, min(event_id) as first_id, max(event_id) as last_id"),
)
def process_window(spark, sf_dir):
    day = F.window("ts", "1 day")
    stamped = events(spark, sf_dir).select(
        "event_type",
        "event_id",
        day["start"].alias("window_start"),
        day["end"].alias("window_end"),
    )

    # Rows fold into one state per window where they are read, however many they are.
    def add(groups):
        return groups["event_id"].agg(cnt="size", first_id="min", last_id="max")

    def merge(groups):
        return groups.agg({"cnt": "sum", "first_id": "min", "last_id": "max"})

    names = ["cnt", "first_id", "last_id"]
    return agg.accumulate(
        stamped,
        ["event_type", "window_start", "window_end"],
        add,
        merge,
        "cnt long, first_id long, last_id long",
        {n: F.col(n) for n in names},
    )


@query(
    "trigger_every_row",
    """select event_id, make_timestamp((epoch_us(ts) // 3600000000 + 1) * 3600000000) as window_end,
              count(*) over (partition by epoch_us(ts) // 3600000000 order by event_id
                             rows unbounded preceding) as cnt from events""",
)
def trigger_every_row(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "ts")
    values = {"cnt": o.running_count()}
    return w.running_in_window(e, [], "ts", "event_id", "1 hour", values).drop("ts")


# Arrival out of order: a delay of up to two hours that depends on the id decides the order.
def _arriving(spark, sf_dir):
    delay = (F.col("event_id") * 7919 % 7200) * 1_000_000
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) + delay
    seq = arrival * 1000 + F.col("event_id") % 1000
    return events(spark, sf_dir).select("event_id", "event_type", "ts", seq.alias("seq"))


def _status(size: int, slide: int, bound: int, lateness: int) -> str:
    size_us, slide_us = size * 1_000_000, slide * 1_000_000
    return f"""
      (select event_id, event_type, ts, seq, make_timestamp(start) as window_start,
              make_timestamp(start + {size_us}) as window_end,
              case when wm is null or start + {size_us} - 1000 > wm then 'on_time'
                   when wm < start + {size_us} - 1000 + {lateness * 1_000_000} then 'refire'
                   else 'late' end as status
       from (select a.*, (epoch_us(ts) // {slide_us} - step) * {slide_us} as start
             from (select event_id, event_type, ts, seq, max(epoch_us(ts)) over
                     (order by seq rows between unbounded preceding and 1 preceding)
                     - {bound * 1_000_000} as wm
                   from (select event_id, event_type, ts,
                     (epoch_us(ts) + (event_id * 7919 % 7200) * 1000000) * 1000
                       + event_id % 1000 as seq from events)) a
             cross join (select unnest(range({size // slide})) as step)))"""


@query(
    "late_status",
    f"select event_id, window_start, window_end, status from {_status(3600, 1800, 3600, 600)}",
)
def late_status(spark, sf_dir):
    rows = _arriving(spark, sf_dir)
    out = eventtime.classify(
        rows, "ts", "seq", "1 hour", "1 hour", "10 minutes", slide="30 minutes"
    )
    return out.select("event_id", "window_start", "window_end", "status")


@query("late_side", f"select event_id from {_status(3600, 3600, 3600, 600)} where status = 'late'")
def late_side(spark, sf_dir):
    rows = _arriving(spark, sf_dir)
    return eventtime.split_late(rows, "ts", "seq", "1 hour", "1 hour", "10 minutes")[
        "late"
    ].select("event_id")


@query("late_main", f"select event_id from {_status(3600, 3600, 3600, 600)} where status <> 'late'")
def late_main(spark, sf_dir):
    rows = _arriving(spark, sf_dir)
    return eventtime.split_late(rows, "ts", "seq", "1 hour", "1 hour", "10 minutes")[
        "main"
    ].select("event_id")


@query(
    "lateness_firings",
    f"""with s as (select * from {_status(3600, 3600, 3600, 600)} where status <> 'late')
        select event_type, window_start, window_end, null::bigint as seq, count(*) as cnt,
               'on_time' as firing from s where status = 'on_time' group by all
        union all
        select event_type, window_start, window_end, seq, cnt, status from (
          select *, count(*) over (partition by event_type, window_start order by seq
                                   rows unbounded preceding) as cnt from s)
        where status = 'refire'""",
)
def lateness_firings(spark, sf_dir):
    rows = _arriving(spark, sf_dir)
    return eventtime.firings(
        rows, ["event_type"], "ts", "seq", "1 hour", "1 hour", "10 minutes"
    )


_ITEMS = "(select ts, regexp_extract(props, '[0-9]+')::int // 10 as item from events where event_type = 'view')"
_HOT = f"""
    select window_end, item, cnt, row_number() over
        (partition by window_end order by cnt desc, item) as rank
    from ({hop(_ITEMS, 'item', 3600, 300, 'count(*)::bigint as cnt')})
    qualify rank <= 3"""


def item_counts(spark, sf_dir):
    views = with_k(events(spark, sf_dir).where("event_type = 'view'"))
    items = views.select("ts", F.floor(F.col("k") / 10).cast("int").alias("item"))
    return w.sliding_from_panes(items, ["item"], "ts", "1 hour", "5 minutes", {"cnt": F.lit(1)})


@query("hot_items_topn", f"select window_end, item, cnt, rank from ({_HOT})")
def hot_items_topn(spark, sf_dir):
    """Every five minutes, the three most viewed items of the last hour."""
    best = ranking.top_n(item_counts(spark, sf_dir), ["window_end"], "cnt", ["item"], 3)
    return best.select("window_end", "item", "cnt", "rank")


@query("hot_items_sql", f"select window_end, item, cnt, rank from ({_HOT})")
def hot_items_sql(spark, sf_dir):
    return spark.sql(
        """select window_end, item, cnt, cast(rank as bigint) as rank from (
             select window_end, item, cnt,
                    row_number() over (partition by window_end order by cnt desc, item) as rank
             from {counts}) where rank <= 3""",
        counts=item_counts(spark, sf_dir),
    )


@query(
    "hot_items_report",
    f"""select window_end, 'window end ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10) ||
          string_agg('Top' || rank || ':' || item || '=' || cnt, chr(10) order by rank) as report
        from ({_HOT}) group by window_end""",
)
def hot_items_report(spark, sf_dir):
    header = F.concat(F.lit("window end "), F.date_format("window_end", "yyyy-MM-dd HH:mm:ss"))
    return ranking.top_n_report(
        item_counts(spark, sf_dir),
        "window_end",
        "cnt",
        ["item"],
        3,
        header,
        F.concat_ws("=", "item", "cnt"),
    )
