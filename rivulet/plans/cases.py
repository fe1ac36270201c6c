"""The business questions: traffic, marketing, ads, login security, order payment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators import aggregates as agg
from rivulet.operators import ordered as o
from rivulet.operators import ranking, timers
from rivulet.operators import windows as w
from rivulet.operators.patterns import NEXT, Stage, match_pattern
from rivulet.plans.registry import events, order_events, query, table, with_k
from rivulet.plans.windowing import hop

VIEWS = "(select * from events where event_type = 'view')"


def _views(spark, sf_dir):
    return events(spark, sf_dir).where("event_type = 'view'")


@query(
    "page_views_running",
    """select event_id, row_number() over (order by event_id) as pv from events
       where event_type = 'view'""",
)
def page_views_running(spark, sf_dir):
    """Total page views so far, at each view."""
    views = _views(spark, sf_dir).select("event_id")
    return agg.running_agg(views, [], "event_id", {"pv": o.running_count()})


@query("page_views_hourly", hop(VIEWS, "", 3600, 3600, "count(*) as pv"))
def page_views_hourly(spark, sf_dir):
    return w.tumbling(_views(spark, sf_dir), [], "ts", "1 hour", [F.count("*").alias("pv")])


@query(
    "unique_visitors_running",
    """select event_id, sum(fresh) over (order by event_id rows unbounded preceding)::bigint as uv
       from (select event_id, (row_number() over (partition by user_id order by event_id) = 1)::int
               as fresh from events where event_type = 'view')""",
)
def unique_visitors_running(spark, sf_dir):
    views = _views(spark, sf_dir).select("event_id", "user_id")
    return agg.running_distinct(views, [], "user_id", "event_id", "uv").drop("user_id")


@query("unique_visitors_hourly", hop(VIEWS, "", 3600, 3600, "count(distinct user_id) as uv"))
def unique_visitors_hourly(spark, sf_dir):
    return w.distinct_per_window(_views(spark, sf_dir), [], "ts", "1 hour", "user_id")


@query(
    "unique_visitors_approx",
    "select window_start, window_end, true as near from ("
    + hop(VIEWS, "", 3600, 3600, "count(*) as cnt")
    + ")",
)
def unique_visitors_approx(spark, sf_dir):
    """Per hour whether the approximate number is within 5 % of the exact one."""
    views = _views(spark, sf_dir)
    hour = F.window("ts", "1 hour").alias("w")
    counted = agg.approx_distinct(views, [hour], F.col("user_id"), 0.01)
    guess = counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), F.col("uv").alias("guess")
    )
    exact = w.distinct_per_window(views, [], "ts", "1 hour", "user_id")
    near = F.abs(F.col("guess") - F.col("uv")) <= 0.05 * F.col("uv")
    return exact.join(guess, ["window_start", "window_end"]).select(
        "window_start", "window_end", near.alias("near")
    )


_BLOOM_BITS = 64
_BLOOM = f"""
    with f as (
        select epoch_us(ts) // 3600000000 as hour, user_id, min(event_id) as first
        from events where event_type = 'view' group by 1, 2
    ), b as (
        select hour, user_id, first,
            ('0x' || substr(md5(i::varchar || ':' || user_id::varchar), 1, 12))::bigint % {_BLOOM_BITS} as bit
        from f cross join (select unnest(range(2)) as i)
    ), s as (select hour, bit, min_by(user_id, first) as user_id from b group by hour, bit)
    select make_timestamp(hour * 3600000000) as window_start,
        make_timestamp((hour + 1) * 3600000000) as window_end, count(distinct user_id) as uv
    from s group by hour"""


@query("unique_visitors_bloom", _BLOOM)
def unique_visitors_bloom(spark, sf_dir):
    """Visitors per hour by a filter so small that it misses some."""
    hour = F.window("ts", "1 hour").alias("w")
    counted = agg.bloom_distinct(
        _views(spark, sf_dir), [hour], F.col("user_id"), "event_id", _BLOOM_BITS, 2
    )
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uv"
    )


_BIT = """list_reduce(list_prepend(0::bigint, list_transform(string_split(user_id::varchar, ''),
            lambda z: ascii(z)::bigint)), lambda h, v: (h * 61 + v) & 1073741823)"""


@query(
    "unique_visitors_bitmap",
    hop(f"(select *, {_BIT} as bit from events where event_type = 'view')", "", 3600, 3600,
        "count(distinct bit) as uv"),
)
def unique_visitors_bitmap(spark, sf_dir):
    hour = F.window("ts", "1 hour").alias("w")
    counted = agg.bitmap_distinct(_views(spark, sf_dir), [hour], F.col("user_id"))
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "uv"
    )


def _marketing(spark, sf_dir) -> DataFrame:
    e = with_k(events(spark, sf_dir))
    channel = F.concat(F.lit("channel_"), F.col("k") % 4)
    return e.select("event_id", "event_type", channel.alias("channel"))


@query(
    "marketing_by_channel",
    """select event_id, label, count(*) over (partition by label order by event_id
              rows unbounded preceding) as cnt
       from (select event_id, 'channel_' || (regexp_extract(props, '[0-9]+')::int % 4) || '_'
                    || event_type as label from events)""",
)
def marketing_by_channel(spark, sf_dir):
    label = F.concat_ws("_", "channel", "event_type").alias("label")
    m = _marketing(spark, sf_dir).select("event_id", label)
    return agg.running_agg(m, ["label"], "event_id", {"cnt": o.running_count()})


@query(
    "marketing_by_behavior",
    """select event_id, event_type, count(*) over (partition by event_type order by event_id
              rows unbounded preceding) as cnt from events""",
)
def marketing_by_behavior(spark, sf_dir):
    m = _marketing(spark, sf_dir).select("event_id", "event_type")
    return agg.running_agg(m, ["event_type"], "event_id", {"cnt": o.running_count()})


def ad_clicks(spark, sf_dir) -> DataFrame:
    """Orders seen as ad clicks: the priority is the ad, the customer's nation the province."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("province"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("ad"),
        F.col("o_orderdate").alias("ts"),
    )
    located = orders.join(customers, F.col("user_id") == F.col("c_custkey"))
    return located.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        *orders.columns, "province"
    )


_CLICKS = """(select o_orderkey as seq, o_custkey as user_id, o_orderpriority as ad,
      o_orderdate as ts, n_name as province
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""


@query(
    "ad_clicks_running",
    f"""select seq, province || '_' || ad as label, count(*) over
          (partition by province, ad order by seq rows unbounded preceding) as cnt from {_CLICKS}""",
)
def ad_clicks_running(spark, sf_dir):
    label = F.concat_ws("_", "province", "ad").alias("label")
    clicks = ad_clicks(spark, sf_dir).select("seq", label)
    return agg.running_agg(clicks, ["label"], "seq", {"cnt": o.running_count()})


def _ad_top(clicks, group):
    counts = w.sliding_from_panes(clicks, [group, "ad"], "ts", "7 days", "1 day", {"cnt": F.lit(1)})
    best = ranking.top_n(counts, ["window_end"], "cnt", [group, "ad"], 3)
    return best.select("window_end", group, "ad", "cnt", "rank")


def _ad_top_sql(source, group):
    counts = hop(source, f"{group}, ad", 604800, 86400, "count(*)::bigint as cnt")
    return f"""select window_end, {group}, ad, cnt, row_number() over (partition by window_end
                 order by cnt desc, {group}, ad) as rank from ({counts}) qualify rank <= 3"""


@query("ad_clicks_by_province_topn", _ad_top_sql(_CLICKS, "province"))
def ad_clicks_by_province_topn(spark, sf_dir):
    return _ad_top(ad_clicks(spark, sf_dir), "province")


_USER_CLICKS = "(select o_custkey as user_id, o_orderpriority as ad, o_orderdate as ts from orders)"


@query("ad_clicks_by_user_topn", _ad_top_sql(_USER_CLICKS, "user_id"))
def ad_clicks_by_user_topn(spark, sf_dir):
    clicks = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("ad"),
        F.col("o_orderdate").alias("ts"),
    )
    return _ad_top(clicks, "user_id")


@query(
    "hot_pages_topn",
    f"""select window_end, url, cnt, row_number() over (partition by window_end
          order by cnt desc, url) as rank
        from ({hop("(select ts, '/' || event_type || '/' || user_id % 10 as url from events)", "url",
                   600, 5, "count(*)::bigint as cnt")}) qualify rank <= 5""",
)
def hot_pages_topn(spark, sf_dir):
    """Every five seconds, the five most viewed pages of the last ten minutes."""
    url = F.concat(F.lit("/"), "event_type", F.lit("/"), F.col("user_id") % 10).alias("url")
    pages = events(spark, sf_dir).select("ts", url)
    counts = w.sliding_from_panes(
        pages, ["url"], "ts", "10 minutes", "5 seconds", {"cnt": F.lit(1)}
    )
    best = ranking.top_n(counts, ["window_end"], "cnt", ["url"], 5)
    return best.select("window_end", "url", "cnt", "rank")


def daily_limit(
    df: DataFrame, keys: list[str], rt: str, seq: str, limit: int
) -> dict[str, DataFrame]:
    """Per key and UTC day the first ``limit`` rows ``pass``; the next one is an ``alarm``.

    No row after these matters, and Spark drops such rows before the shuffle: however hot a
    key is, a task sends at most ``limit + 1`` of its rows per day.
    """
    window = Window.partitionBy(*keys, F.to_date(rt)).orderBy(seq)
    first = df.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= limit + 1)
    return {
        "pass": first.where(F.col("_n") <= limit).select(*df.columns),
        "alarm": first.where(F.col("_n") == limit + 1).select(*df.columns),
    }


_LIMITED = """(select *, row_number() over (partition by user_id, event_type, ts::date
                                            order by event_id) as n from events)"""


def _limited(spark, sf_dir):
    e = events(spark, sf_dir).select("user_id", "event_type", "ts", "event_id")
    return daily_limit(e, ["user_id", "event_type"], "ts", "event_id", 2)


@query("blacklist_pass", f"select user_id, event_type, event_id from {_LIMITED} where n <= 2")
def blacklist_pass(spark, sf_dir):
    return _limited(spark, sf_dir)["pass"].drop("ts")


@query("blacklist_alarm", f"select user_id, event_type, event_id from {_LIMITED} where n = 3")
def blacklist_alarm(spark, sf_dir):
    return _limited(spark, sf_dir)["alarm"].drop("ts")


@query(
    "blacklist_topn",
    f"""select window_end, user_id, event_type, cnt, row_number() over (partition by window_end
          order by cnt desc, user_id, event_type) as rank
        from ({hop(f"(select * from {_LIMITED} where n <= 2)", "user_id, event_type", 21600, 3600,
                   "count(*)::bigint as cnt")}) qualify rank <= 3""",
)
def blacklist_topn(spark, sf_dir):
    """What passes the blacklist, ranked per six hours."""
    counts = w.sliding_from_panes(
        _limited(spark, sf_dir)["pass"], ["user_id", "event_type"], "ts", "6 hours", "1 hour",
        {"cnt": F.lit(1)},
    )
    best = ranking.top_n(counts, ["window_end"], "cnt", ["user_id", "event_type"], 3)
    return best.select("window_end", "user_id", "event_type", "cnt", "rank")


_LOGIN = "(select * from events where event_type in ('error', 'signup'))"


def _logins(spark, sf_dir):
    """Errors as failed logins, signups as successful ones."""
    e = events(spark, sf_dir).where(F.col("event_type").isin("error", "signup"))
    return e.select("user_id", "event_type", "ts", "event_id")


@query(
    "login_fail_cep",
    f"""select user_id, event_id as first_id, next_id as second_id from (
          select *, lead(event_id) over p as next_id, lead(event_type) over p as next_type,
                 lead(ts) over p as next_ts
          from {_LOGIN} window p as (partition by user_id order by ts, event_id))
        where event_type = 'error' and next_type = 'error' and next_ts < ts + interval 12 hours""",
)
def login_fail_cep(spark, sf_dir):
    fail = F.col("event_type") == "error"
    found = match_pattern(
        _logins(spark, sf_dir),
        ["user_id"],
        "ts",
        "event_id",
        [Stage("first", fail), Stage("second", fail, NEXT)],
        "12 hours",
    )["matches"]
    return found.select(
        "user_id",
        F.col("first.event_id").alias("first_id"),
        F.col("second.event_id").alias("second_id"),
    )


# One step per row and user. The watermark a row finds is the time of the login before it (the
# table arrives in time order) less one hour.
_FAILURES = f"""
    with recursive e as (
      select user_id, event_id, event_type = 'signup' as ok, epoch_us(ts) as t,
             coalesce(lag(epoch_us(ts)) over (order by event_id) - 3600000000, -1) as wm,
             row_number() over (partition by user_id order by event_id) as n
      from {_LOGIN}),
    -- (anchor, due, fails) is what is pending after the row; (a0, f0, by0) what the row ended.
    walk as (
      select user_id, n, case when not ok then event_id end as anchor,
             t + 43200000000 as due, case when ok then 0 else 1 end as fails,
             null::bigint as a0, 0 as f0, null::varchar as by0
      from e where n = 1
      union all
      select e.user_id, e.n,
             case when e.ok then null when w.anchor is null or w.due <= e.wm then e.event_id
                  else w.anchor end,
             case when w.anchor is null or w.due <= e.wm then e.t + 43200000000 else w.due end,
             case when e.ok then 0 when w.anchor is null or w.due <= e.wm then 1
                  else w.fails + 1 end,
             case when w.anchor is not null and (e.ok or w.due <= e.wm) then w.anchor end,
             w.fails,
             case when w.due <= e.wm then 'timer' else 'success' end
      from walk w join e on e.user_id = w.user_id and e.n = w.n + 1)
    select user_id, a0 as first_seq, f0::bigint as failures, by0 as closed_by from walk
    where a0 is not null and f0 >= 2
    union all
    select user_id, anchor, fails::bigint, 'timer' from walk
    where anchor is not null and fails >= 2
      and n = (select max(n) from e where e.user_id = walk.user_id)"""


@query(
    "login_fail_null_users",
    f"""select case when user_id = 0 then null else user_id + 1000000000000000000 end as user_id,
               first_seq, failures, closed_by from ({_FAILURES})""",
)
def login_fail_null_users(spark, sf_dir):
    """The same with users above 2^53 and one without id."""
    wide = F.when(F.col("user_id") != 0, F.col("user_id") + 10**18).alias("user_id")
    logins = _logins(spark, sf_dir)
    logins = logins.select(*[wide if c == "user_id" else c for c in logins.columns])
    success = F.col("event_type") == "signup"
    return timers.repeated_failures(logins, "user_id", "ts", "event_id", success, "12 hours", 2, "1 hour")


@query("login_fail_process", _FAILURES)
def login_fail_process(spark, sf_dir):
    """Users with two failures or more before a success or within twelve hours."""
    success = F.col("event_type") == "signup"
    return timers.repeated_failures(
        _logins(spark, sf_dir), "user_id", "ts", "event_id", success, "12 hours", 2, "1 hour"
    )


_RISING = """
    with recursive e as (
      select user_id, event_id, value, epoch_us(ts) as t,
             coalesce(lag(epoch_us(ts)) over (order by event_id), -1) as wm,
             row_number() over (partition by user_id order by event_id) as n
      from events),
    -- (anchor, due) is the timer pending after the row; (a0, d0) the one that went off before it.
    walk as (
      select user_id, n, value, case when value > -1 then event_id end as anchor,
             t + 43200000000 as due, null::bigint as a0, null::bigint as d0
      from e where n = 1
      union all
      select e.user_id, e.n, e.value,
             case when e.value <= w.value then null
                  when w.anchor is null or w.due <= e.wm then e.event_id else w.anchor end,
             case when w.anchor is null or w.due <= e.wm then e.t + 43200000000 else w.due end,
             case when w.due <= e.wm then w.anchor end, w.due
      from walk w join e on e.user_id = w.user_id and e.n = w.n + 1)
    select user_id, a0 as first_seq, make_timestamp(d0) as alarm_ts from walk where a0 is not null
    union all
    select user_id, anchor, make_timestamp(due) from walk
    where anchor is not null and n = (select max(n) from e where e.user_id = walk.user_id)"""


@query("rising_level_alarm", _RISING)
def rising_level_alarm(spark, sf_dir):
    """Users whose value kept rising for twelve hours."""
    e = events(spark, sf_dir).select("user_id", "event_id", "ts", "value")
    return timers.rising_alarms(e, "user_id", "ts", "event_id", "value", "12 hours")


def payment_status(df: DataFrame, key: str, kind: str, rt: str, limit_seconds: int) -> DataFrame:
    """How each order ended: ``paid``, ``paid_late`` (more than the limit after its
    creation), ``pay_timeout`` (no payment) or ``create_missing``.

    ``df`` holds both event kinds, each at most once per order (of repeats the first
    counts). One grouped pass, combined before the shuffle, stands for a full outer join.
    """
    created = F.min(F.when(F.col(kind) == "create", F.col(rt)))
    paid = F.min(F.when(F.col(kind) == "pay", F.col(rt)))
    orders = df.where(F.col(kind).isin("create", "pay")).groupBy(key).agg(
        created.alias("_created"), paid.alias("_paid")
    )
    late = F.unix_micros(F.col("_paid").cast("timestamp")) - F.unix_micros(
        F.col("_created").cast("timestamp")
    ) > F.lit(limit_seconds * 1_000_000)
    status = (
        F.when(F.col("_paid").isNull(), "pay_timeout")
        .when(F.col("_created").isNull(), "create_missing")
        .when(late, "paid_late")
        .otherwise("paid")
    )
    return orders.select(key, status.alias("status"))


@query(
    "order_timeout",
    """select coalesce(o_orderkey, l_orderkey) as order_id,
              case when paid is null then 'pay_timeout' when o_orderdate is null then 'create_missing'
                   when paid > o_orderdate + interval 90 days then 'paid_late' else 'paid' end as status
       from orders full join (select l_orderkey, min(l_shipdate) as paid from lineitem group by 1)
         on o_orderkey = l_orderkey""",
)
def order_timeout(spark, sf_dir):
    return payment_status(order_events(spark, sf_dir), "order_id", "event_type", "rt", 90 * 86400)


_ORDER_EVENTS = """(
    select o_orderkey as order_id, 'create' as event_type, o_orderdate as rt, o_orderkey * 100 as seq
    from orders union all
    select l_orderkey, 'pay', l_shipdate, l_orderkey * 100 + l_linenumber from lineitem)"""
_PAID = f"""
    select c.order_id, c.rt as created, min_by(p.rt, (p.rt, p.seq)) as paid,
           min_by(p.seq, (p.rt, p.seq)) as pay_seq
    from (select * from {_ORDER_EVENTS} where event_type = 'create') c
    left join (select * from {_ORDER_EVENTS} where event_type = 'pay') p
      on c.order_id = p.order_id and (p.rt, p.seq) > (c.rt, c.seq)
    group by c.order_id, c.rt"""


def _payments(spark, sf_dir):
    stages = [
        Stage("create", F.col("event_type") == "create"),
        Stage("pay", F.col("event_type") == "pay"),
    ]
    return match_pattern(
        order_events(spark, sf_dir), ["order_id"], "rt", "seq", stages, "90 days"
    )


@query(
    "order_timeout_cep",
    f"""select order_id, created + interval 90 days as timeout_ts from ({_PAID})
        where paid is null or paid >= created + interval 90 days""",
)
def order_timeout_cep(spark, sf_dir):
    return _payments(spark, sf_dir)["timeouts"].select("order_id", "timeout_ts")


@query(
    "order_paid_cep",
    f"select order_id, paid as pay_ts from ({_PAID}) where paid < created + interval 90 days",
)
def order_paid_cep(spark, sf_dir):
    return _payments(spark, sf_dir)["matches"].select(
        "order_id", F.col("pay.rt").alias("pay_ts")
    )
