"""Joins between event kinds and event patterns per user."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import joins
from rivulet.operators.patterns import FOLLOWED_BY_ANY, NEXT, Stage, match_pattern
from rivulet.plans.registry import events, query, table


def _kind(spark, sf_dir, kind):
    e = events(spark, sf_dir).where(F.col("event_type") == kind)
    return e.select("user_id", "event_id", "ts")


def _sides(spark, sf_dir):
    return _kind(spark, sf_dir, "click"), _kind(spark, sf_dir, "purchase")


_A = "(select * from events where event_type = 'click')"
_B = "(select * from events where event_type = 'purchase')"


@query(
    "window_join",
    f"""select a.user_id as user_id, a.event_id as click_id, b.event_id as purchase_id,
          make_timestamp(epoch_us(a.ts) // 21600000000 * 21600000000) as window_start
        from {_A} a join {_B} b on a.user_id = b.user_id
         and epoch_us(a.ts) // 21600000000 = epoch_us(b.ts) // 21600000000""",
)
def window_join(spark, sf_dir):
    joined = joins.window_join(*_sides(spark, sf_dir), ["user_id"], "ts", "6 hours")
    return joined.select(
        F.col("l_user_id").alias("user_id"),
        F.col("l_event_id").alias("click_id"),
        F.col("r_event_id").alias("purchase_id"),
        "window_start",
    )


@query(
    "interval_join",
    f"""select a.user_id as user_id, a.event_id as click_id, b.event_id as purchase_id
        from {_A} a join {_B} b on a.user_id = b.user_id
         and b.ts between a.ts - interval 6 hours and a.ts + interval 6 hours""",
)
def interval_join(spark, sf_dir):
    joined = joins.interval_join(
        *_sides(spark, sf_dir), ["user_id"], "ts", "ts", "-6 hours", "6 hours"
    )
    return joined.select(
        F.col("l_user_id").alias("user_id"),
        F.col("l_event_id").alias("click_id"),
        F.col("r_event_id").alias("purchase_id"),
    )


@query(
    "interval_join_orders",
    """select o_orderkey, l_linenumber from orders join lineitem on o_orderkey = l_orderkey
       and l_shipdate between o_orderdate and o_orderdate + interval 90 days""",
)
def interval_join_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), "l_linenumber", "l_shipdate"
    )
    joined = joins.interval_join(
        orders, lines, ["k"], "o_orderdate", "l_shipdate", "0 days", "90 days"
    )
    return joined.select(
        F.col("l_k").alias("o_orderkey"), F.col("r_l_linenumber").alias("l_linenumber")
    )


@query(
    "match_occurrences",
    f"""select coalesce(a.user_id, b.user_id) as user_id, a.event_id as click_id,
               b.event_id as purchase_id
        from (select *, row_number() over (partition by user_id order by event_id) as n from {_A}) a
        full join (select *, row_number() over (partition by user_id order by event_id) as n
                   from {_B}) b on a.user_id = b.user_id and a.n = b.n""",
)
def match_occurrences(spark, sf_dir):
    joined = joins.match_occurrences(
        *_sides(spark, sf_dir), ["user_id"], "event_id", "event_id", how="full"
    )
    return joined.select(
        F.coalesce("l_user_id", "r_user_id").alias("user_id"),
        F.col("l_event_id").alias("click_id"),
        F.col("r_event_id").alias("purchase_id"),
    )


# One step per row and user: who waits after it, and the pair it completes.
_WALK = """
    with recursive e as (
      select user_id, event_id, event_type = 'click' as is_click,
             row_number() over (partition by user_id order by event_id) as n
      from events where event_type in ('click', 'purchase')),
    walk as (
      select user_id, n, event_id as waiting, is_click as waiting_click,
             null::bigint as click_id, null::bigint as purchase_id from e where n = 1
      union all
      select e.user_id, e.n,
             case when w.waiting is not null and w.waiting_click <> e.is_click then null
                  else e.event_id end,
             e.is_click,
             case when w.waiting is not null and w.waiting_click <> e.is_click
                  then case when e.is_click then e.event_id else w.waiting end end,
             case when w.waiting is not null and w.waiting_click <> e.is_click
                  then case when e.is_click then w.waiting else e.event_id end end
      from walk w join e on e.user_id = w.user_id and e.n = w.n + 1)
"""


def _waiting(spark, sf_dir):
    return joins.match_waiting(*_sides(spark, sf_dir), ["user_id"], "event_id")


@query(
    "reconcile_connect",
    _WALK + "select user_id, click_id, purchase_id from walk where click_id is not null",
)
def reconcile_connect(spark, sf_dir):
    """Clicks and purchases of a user matched one to one as they arrive."""
    return _waiting(spark, sf_dir)["matches"].select(
        F.col("l_user_id").alias("user_id"),
        F.col("l_event_id").alias("click_id"),
        F.col("r_event_id").alias("purchase_id"),
    )


@query(
    "reconcile_unmatched",
    _WALK + """select user_id, waiting as event_id, waiting_click as is_click from walk
               where waiting is not null
                 and n = (select max(n) from e where e.user_id = walk.user_id)""",
)
def reconcile_unmatched(spark, sf_dir):
    out = _waiting(spark, sf_dir)
    sides = [
        out[side].select("user_id", "event_id", F.lit(side == "left").alias("is_click"))
        for side in ("left", "right")
    ]
    return sides[0].unionByName(sides[1])


@query(
    "broadcast_control",
    """select event_id, switch from (
         select event_id, event_type, last_value(
             case when event_type = 'signup' then case when user_id % 2 = 1 then 'true' else 'false' end end
             ignore nulls) over (order by event_id rows unbounded preceding) as switch
         from events) where event_type <> 'signup'""",
)
def broadcast_control(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "event_type", "user_id")
    control = e.where("event_type = 'signup'")
    main = e.where("event_type <> 'signup'").select("event_id")
    value = F.when(F.col("user_id") % 2 == 1, "true").otherwise("false")
    return joins.enrich_latest(main, control, "event_id", value, "switch")


def _is(kind):
    return F.col("event_type") == kind


def _match(spark, sf_dir, stages, within=None, key=("user_id",)):
    e = events(spark, sf_dir).select("user_id", "event_type", "ts", "event_id")
    return match_pattern(e, list(key), "ts", "event_id", stages, within)


def _ids(df, *names):
    return df.select("user_id", *[F.col(f"{n}.event_id").alias(f"{n}_id") for n in names])


@query("cep_single", "select user_id, event_id as start_id from events where event_type = 'error' and value > 50")
def cep_single(spark, sf_dir):
    stage = Stage("start", _is("error") & (F.col("value") > 50))
    e = events(spark, sf_dir).select("user_id", "event_type", "value", "ts", "event_id")
    found = match_pattern(e, ["user_id"], "ts", "event_id", [stage])
    return _ids(found["matches"], "start")


@query("cep_or", "select user_id, event_id as start_id from events where event_type in ('error', 'signup')")
def cep_or(spark, sf_dir):
    stages = [Stage("start", _is("error") | _is("signup"))]
    return _ids(_match(spark, sf_dir, stages)["matches"], "start")


_NEXT = """select user_id, event_id as start_id, next_id as then_id from (
    select *, lead(event_id) over p as next_id, lead(event_type) over p as next_type,
           lead(ts) over p as next_ts
    from events window p as ({partition} order by ts, event_id))
    where event_type = 'error' and next_type = 'error'"""


@query("cep_next", _NEXT.format(partition="partition by user_id"))
def cep_next(spark, sf_dir):
    stages = [Stage("start", _is("error")), Stage("then", _is("error"), NEXT)]
    return _ids(_match(spark, sf_dir, stages)["matches"], "start", "then")


@query(
    "cep_within",
    _NEXT.format(partition="partition by user_id") + " and next_ts < ts + interval 6 hours",
)
def cep_within(spark, sf_dir):
    stages = [Stage("start", _is("error")), Stage("then", _is("error"), NEXT)]
    return _ids(_match(spark, sf_dir, stages, "6 hours")["matches"], "start", "then")


@query(
    "cep_unkeyed",
    "select start_id, then_id from (" + _NEXT.format(partition="") + ")",
)
def cep_unkeyed(spark, sf_dir):
    stages = [Stage("start", _is("error")), Stage("then", _is("error"), NEXT)]
    found = _match(spark, sf_dir, stages, key=())["matches"]
    return found.select(
        F.col("start.event_id").alias("start_id"), F.col("then.event_id").alias("then_id")
    )


_FOLLOWED = """
    select a.user_id, a.event_id as start_id, a.ts as start_ts, min_by(b.event_id, b.event_id) as then_id,
           min_by(b.ts, b.event_id) as then_ts
    from (select * from events where event_type = 'click') a
    left join (select * from events where event_type = 'purchase') b
      on a.user_id = b.user_id and b.event_id > a.event_id
    group by a.user_id, a.event_id, a.ts"""


def _clicks_then_purchases(spark, sf_dir):
    stages = [Stage("start", _is("click")), Stage("then", _is("purchase"))]
    return _match(spark, sf_dir, stages, "6 hours")


@query(
    "cep_followed_by",
    f"select user_id, start_id, then_id from ({_FOLLOWED}) where then_ts < start_ts + interval 6 hours",
)
def cep_followed_by(spark, sf_dir):
    return _ids(_clicks_then_purchases(spark, sf_dir)["matches"], "start", "then")


@query(
    "cep_timeouts",
    f"""select user_id, start_id, start_ts + interval 6 hours as timeout_ts from ({_FOLLOWED})
        where then_ts is null or then_ts >= start_ts + interval 6 hours""",
)
def cep_timeouts(spark, sf_dir):
    late = _clicks_then_purchases(spark, sf_dir)["timeouts"]
    return late.select("user_id", F.col("start.event_id").alias("start_id"), "timeout_ts")


@query(
    "cep_followed_by_any",
    f"""select a.user_id, a.event_id as start_id, b.event_id as then_id from {_A} a join {_B} b
        on a.user_id = b.user_id and b.event_id > a.event_id and b.ts < a.ts + interval 2 days""",
)
def cep_followed_by_any(spark, sf_dir):
    stages = [Stage("start", _is("click")), Stage("then", _is("purchase"), FOLLOWED_BY_ANY)]
    return _ids(_match(spark, sf_dir, stages, "2 days")["matches"], "start", "then")


@query(
    "cep_three_stages",
    f"""select f.user_id, start_id, then_id, l.event_id as last_id
        from ({_FOLLOWED}) f join (
          select *, lag(event_id) over (partition by user_id order by ts, event_id) as before
          from events) l
        on f.user_id = l.user_id and l.before = f.then_id and l.event_type = 'error'
        where l.ts < start_ts + interval 2 days""",
)
def cep_three_stages(spark, sf_dir):
    stages = [
        Stage("start", _is("click")),
        Stage("then", _is("purchase")),
        Stage("last", _is("error"), NEXT),
    ]
    return _ids(_match(spark, sf_dir, stages, "2 days")["matches"], "start", "then", "last")


@query(
    "cep_times",
    """select user_id, event_id as first_id, n, case n when 1 then event_id when 2 then second
              else third end as last_id
       from (select *, lead(event_id, 1) over p as second, lead(ts, 1) over p as second_ts,
                    lead(event_id, 2) over p as third, lead(ts, 2) over p as third_ts
             from events where event_type = 'error'
             window p as (partition by user_id order by ts, event_id))
       cross join (select unnest([1, 2, 3]) as n)
       where n = 1 or (n = 2 and second_ts < ts + interval 2 days)
          or (n = 3 and third_ts < ts + interval 2 days)""",
)
def cep_times(spark, sf_dir):
    stages = [Stage("start", _is("error"), times=(1, 3))]
    found = _match(spark, sf_dir, stages, "2 days")["matches"]
    return found.select(
        "user_id",
        F.col("start")[0]["event_id"].alias("first_id"),
        F.size("start").alias("n"),
        F.element_at("start", -1)["event_id"].alias("last_id"),
    )
