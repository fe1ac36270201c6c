"""Ingest, projection, routing, union, grouped and running aggregation, views."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.functions import text
from rivulet.operators import aggregates as agg
from rivulet.operators import changelog, ranking
from rivulet.operators import ordered as o
from rivulet.operators import transforms as t
from rivulet.plans.registry import events, query, table, with_k
from rivulet.session import run_folder
from rivulet.sinks import files as file_sinks
from rivulet.sinks import stores
from rivulet.sources import files as file_sources

WORDS = """
    select unnest(case when text <> '' and rtrim(text, ' ') = '' then []
                       else string_split(rtrim(text, ' '), ' ') end) as word
    from documents
"""


@query("word_count", f"select word, count(*) as cnt from ({WORDS}) group by word")
def word_count(spark, sf_dir):
    words = t.explode_tokens(table(spark, sf_dir, "documents"), "text")
    return words.groupBy("word").agg(F.count("*").alias("cnt"))


@query(
    "flatmap_tokens",
    f"select word, length(word) as n_chars, count(*) as cnt from ({WORDS}) where word <> '' group by all",
)
def flatmap_tokens(spark, sf_dir):
    words = t.explode_tokens(table(spark, sf_dir, "documents"), "text").where("word <> ''")
    return words.groupBy("word", F.length("word").cast("long").alias("n_chars")).agg(F.count("*").alias("cnt"))


@query(
    "typed_ingest",
    "select event_id as id, epoch_us(ts) // 1000000 as ts, user_id::int as vc, event_type from events",
)
def typed_ingest(spark, sf_dir):
    line = F.concat_ws(
        ",",
        "event_id",
        F.unix_seconds(F.col("ts").cast("timestamp")),
        "user_id",
        "event_type",
    )
    lines = events(spark, sf_dir).select(line.alias("value"))
    return file_sources.parse_delimited(lines, "id long, ts long, vc int, event_type string")


@query(
    "delimited_table",
    "select event_type as kind, user_id as who, event_id as id from events where event_type = 'view'",
)
def delimited_table(spark, sf_dir):
    folder = run_folder(spark, "delimited")
    source = events(spark, sf_dir).where("event_type = 'view'")
    file_sinks.write_delimited(source.select("event_type", "user_id", "event_id"), folder, "|")
    return file_sources.delimited_table(
        spark, folder, "kind string, who long, id long", separator="|"
    )


@query(
    "text_file_lines",
    "select event_type, count(*) as lines, sum(user_id)::bigint as users from events group by event_type",
)
def text_file_lines(spark, sf_dir):
    folder = run_folder(spark, "lines")
    events(spark, sf_dir).select(F.concat_ws(" ", "event_type", "user_id")).write.text(folder)
    lines = file_sources.text_lines(spark, folder)
    parsed = lines.select(
        text.token(F.col("value"), 0).alias("event_type"),
        text.token(F.col("value"), 1).cast("long").alias("user_id"),
    )
    return parsed.groupBy("event_type").agg(
        F.count("*").alias("lines"), F.sum("user_id").alias("users")
    )


@query(
    "access_log_ingest",
    """select '10.0.0.' || (user_id % 250) as ip, user_id::varchar as user_id,
              date_trunc('second', ts) as event_time, 'GET' as method, '/' || event_type as url
       from events""",
)
def access_log_ingest(spark, sf_dir):
    e = events(spark, sf_dir)
    when = F.date_format("ts", "dd/MM/yyyy:HH:mm:ss")
    ip = F.concat(F.lit("10.0.0."), F.col("user_id") % 250)
    parts = [ip, "user_id", when, F.lit("+0000"), F.lit("GET"), F.concat(F.lit("/"), "event_type")]
    line = F.concat_ws(" ", parts[0], F.lit("-"), *parts[1:])
    # Tokens: ip, a dash, user, time, zone, method, url.
    parsed = file_sources.parse_access_log(e.select(line.alias("value")), user_token=2)
    return parsed.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query("filter_even", "select event_id, user_id from events where event_id % 2 = 0")
def filter_even(spark, sf_dir):
    return events(spark, sf_dir).where(F.col("event_id") % 2 == 0).select("event_id", "user_id")


@query("project_rename", "select user_id as id, ts as t, event_id as x from events where user_id = 1")
def project_rename(spark, sf_dir):
    return events(spark, sf_dir).where("user_id = 1").select(
        F.col("user_id").alias("id"), F.col("ts").alias("t"), F.col("event_id").alias("x")
    )


@query("filter_map", "select event_id, 'pv' as kind, 1 as one from events where event_type = 'view'")
def filter_map(spark, sf_dir):
    return t.filter_map(
        events(spark, sf_dir),
        F.col("event_type") == "view",
        F.col("event_id"),
        F.lit("pv").alias("kind"),
        F.lit(1).alias("one"),
    )


@query("map_with_setup", "select event_id, user_id + 1000 as shifted from events")
def map_with_setup(spark, sf_dir):
    # The resource stands for a connection or model opened once per task.
    return t.map_with_setup(
        events(spark, sf_dir).select("event_id", "user_id"),
        lambda: 1000,
        lambda shift, b: b.assign(shifted=b["user_id"] + shift)[["event_id", "shifted"]],
        "event_id long, shifted long",
    )


def _tagged(spark, sf_dir):
    v = F.col("value")
    rules = [(v < 50, ["normal", "low"]), (v < 80, ["warn", "low"]), (F.lit(True), ["alarm"])]
    return t.tag(events(spark, sf_dir).select("event_id", "value"), rules)


@query(
    "split_tags",
    """select tag, count(*) as cnt from (
         select unnest(case when value < 50 then ['normal', 'low'] when value < 80
                then ['warn', 'low'] else ['alarm'] end) as tag from events) group by tag""",
)
def split_tags(spark, sf_dir):
    tagged = _tagged(spark, sf_dir).select(F.explode("tags").alias("tag"))
    return tagged.groupBy("tag").agg(F.count("*").alias("cnt"))


@query("select_tag", "select event_id, value from events where value < 80")
def select_tag(spark, sf_dir):
    return t.select_tag(_tagged(spark, sf_dir), "low").select("event_id", "value")


def _routed(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "user_id", "value")
    message = F.concat(F.lit("event "), "event_id", F.lit(" above 50"))
    return t.side_output(e, F.col("value") > 50, message)


@query("side_output_main", "select event_id, user_id, value from events where not value > 50")
def side_output_main(spark, sf_dir):
    return _routed(spark, sf_dir)["main"]


@query("side_output_high", "select 'event ' || event_id || ' above 50' as message from events where value > 50")
def side_output_high(spark, sf_dir):
    return _routed(spark, sf_dir)["side"]


@query("rebalance", "select user_id, count(*) as cnt from events group by user_id")
def rebalance(spark, sf_dir):
    spread = t.rebalance(events(spark, sf_dir).select("user_id"))
    return spread.groupBy("user_id").agg(F.count("*").alias("cnt"))


@query("partition_by_key", "select event_type, user_id, event_id from events")
def partition_by_key(spark, sf_dir):
    e = events(spark, sf_dir).select("event_type", "user_id", "event_id")
    return t.partition_by(e, ["event_type", "user_id"])


@query(
    "union_all",
    """select user_id from events where event_type = 'click' union all
       select user_id from events where event_type = 'view' union all
       select o_custkey from orders""",
)
def union_all(spark, sf_dir):
    e = events(spark, sf_dir)
    users = [e.where(F.col("event_type") == x).select("user_id") for x in ("click", "view")]
    buyers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"))
    return t.union(*users, buyers)


@query("sql_union_all", "select c_nationkey as k from customer union all select s_nationkey from supplier")
def sql_union_all(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    return spark.sql(
        "select c_nationkey as k from {c} union all select s_nationkey from {s}",
        c=customer,
        s=supplier,
    )


@query(
    "connect_map",
    """select 'order ' || o_orderkey as item, o_custkey as ref from orders union all
       select 'line ' || l_orderkey || '/' || l_linenumber, l_suppkey from lineitem""",
)
def connect_map(spark, sf_dir):
    line = F.concat(F.lit("line "), "l_orderkey", F.lit("/"), "l_linenumber")
    return t.connect(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "lineitem"),
        [F.concat(F.lit("order "), "o_orderkey").alias("item"), F.col("o_custkey").alias("ref")],
        [line.alias("item"), F.col("l_suppkey").alias("ref")],
    )


@query(
    "not_in_subquery",
    "select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem)",
)
def not_in_subquery(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return t.not_in(orders, "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    "right_join",
    """select l.l_linenumber, l.l_suppkey, o.o_orderkey
       from lineitem l right join orders o on l.l_orderkey = o.o_orderkey""",
)
def right_join(spark, sf_dir):
    from rivulet.operators.joins import right_join as join

    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return join(lines, orders, lines.l_orderkey == orders.o_orderkey).drop("l_orderkey")


@query("group_sum", "select o_custkey, sum(o_orderkey)::bigint as total from orders group by o_custkey")
def group_sum(spark, sf_dir):
    return agg.group_sum(table(spark, sf_dir, "orders"), ["o_custkey"], F.col("o_orderkey"))


@query("grouped_count", "select event_type as id, count(user_id) as cnt from events group by event_type")
def grouped_count(spark, sf_dir):
    e = events(spark, sf_dir).select(F.col("event_type").alias("id"), "user_id")
    return e.groupBy("id").agg(F.count("user_id").alias("cnt"))


_ORDER = "(partition by user_id order by event_id rows unbounded preceding)"


@query(
    "running_sum",
    f"select event_id, user_id, sum(event_id) over {_ORDER}::bigint as total from events",
)
def running_sum(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "user_id")
    return agg.running_agg(e, ["user_id"], "event_id", {"total": o.running_sum(F.col("event_id"))})


@query(
    "running_max_min",
    f"""select event_id, user_id, first_value(ts) over {_ORDER} as ts,
               max(value) over {_ORDER} as max_value, min(value) over {_ORDER} as min_value
        from events""",
)
def running_max_min(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "user_id", "ts", "value")
    v = F.col("value")
    values = {"max_value": o.running_max(v), "min_value": o.running_min(v)}
    return agg.running_agg(e, ["user_id"], "event_id", values, carry_first=["ts"]).drop("value")


@query(
    "reduce_running",
    f"""select event_id, user_id, ts, sum(k) over {_ORDER}::bigint as k from
        (select *, regexp_extract(props, '[0-9]+')::int as k from events)""",
)
def reduce_running(spark, sf_dir):
    e = with_k(events(spark, sf_dir)).select("event_id", "user_id", "ts", F.col("k").alias("_k"))
    return agg.running_agg(e, ["user_id"], "event_id", {"k": o.running_sum(F.col("_k"))}).drop("_k")


@query(
    "running_count",
    """select event_id, event_type, count(*) over
         (partition by event_type order by event_id rows unbounded preceding) as cnt from events""",
)
def running_count(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "event_type")
    return agg.running_agg(e, ["event_type"], "event_id", {"cnt": o.running_count()})


@query(
    "running_distinct",
    """select event_id, event_type, sum(fresh) over
         (partition by event_type order by event_id rows unbounded preceding)::bigint as distinct_count
       from (select *, (row_number() over (partition by event_type, user_id order by event_id) = 1)::int
               as fresh from events)""",
)
def running_distinct(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "event_type", "user_id")
    return agg.running_distinct(e, ["event_type"], "user_id", "event_id").drop("user_id")


@query(
    "custom_accumulator",
    """select user_id, count(*) as n, min(event_id) as first_id, max(event_id) as last_id
       from events group by user_id""",
)
def custom_accumulator(spark, sf_dir):
    def add(groups):
        ids = groups["event_id"]
        return ids.agg(n="size", low="min", high="max")

    def merge(groups):
        return groups.agg({"n": "sum", "low": "min", "high": "max"})

    return agg.accumulate(
        events(spark, sf_dir).select("user_id", "event_id"),
        ["user_id"],
        add,
        merge,
        "n long, low long, high long",
        {"n": F.col("n"), "first_id": F.col("low"), "last_id": F.col("high")},
    )


# Ids above 2^53 beside nulls: what floating point would change or merge.
_WIDE = "case when user_id % 7 = 0 then null else user_id + 1000000000000000000 end"


@query(
    "accumulator_null_keys",
    f"""select {_WIDE} as id, count(*) as n, min(event_id + 1000000000000000000) as first_id
        from events group by 1""",
)
def accumulator_null_keys(spark, sf_dir):
    wide = events(spark, sf_dir).select(
        F.expr(_WIDE).alias("id"), (F.col("event_id") + 10**18).alias("event_id")
    )
    return agg.accumulate(
        wide,
        ["id"],
        lambda groups: groups["event_id"].agg(n="size", low="min"),
        lambda groups: groups.agg({"n": "sum", "low": "min"}),
        "n long, low long",
        {"n": F.col("n"), "first_id": F.col("low")},
    )


@query("map_setup_long_values", f"select event_id, {_WIDE} + 1 as shifted from events")
def map_setup_long_values(spark, sf_dir):
    return t.map_with_setup(
        events(spark, sf_dir).select("event_id", F.expr(_WIDE).alias("id")),
        lambda: 1,
        lambda shift, b: b.assign(shifted=b["id"] + shift)[["event_id", "shifted"]],
        "event_id long, shifted long",
    )


@query(
    "running_sum_double",
    """select event_id, sum(value::decimal(18, 2)) over (partition by user_id order by event_id)::double
       as total from events""",
)
def running_sum_double(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("_v", F.col("value").cast("decimal(18,2)"))
    total = {"total": o.running_sum(F.col("_v"))}
    out = agg.running_agg(e, ["user_id"], "event_id", total)
    return out.select("event_id", F.col("total").cast("double").alias("total"))


@query(
    "running_text_order",
    """select event_id, count(*) over (partition by event_type order by props, event_id) as n,
              max(user_id) over (partition by event_type order by props, event_id) as top
       from events""",
)
def running_text_order(spark, sf_dir):
    values = {"n": o.running_count(), "top": o.running_max(F.col("user_id"))}
    # So few rows a chunk that every type is a hot key.
    out = o.running(
        events(spark, sf_dir), ["event_type"], ["props", "event_id"], values, rows_per_chunk=500
    )
    return out.select("event_id", "n", "top")


@query(
    "running_ties",
    """select event_id, count(*) over (order by day, event_id) as n,
              min(value) over (order by day, event_id) as low
       from (select *, epoch_us(ts) // 864000000000 as day from events)""",
)
def running_ties(spark, sf_dir):
    ties = events(spark, sf_dir).withColumn("_day", F.expr("unix_micros(cast(ts as timestamp)) div 864000000000"))
    values = {"n": o.running_count(), "low": o.running_min(F.col("value"))}
    out = o.running(ties, [], ["_day", "event_id"], values, rows_per_chunk=300)
    return out.select("event_id", "n", "low")


@query(
    "keyed_upsert_rows",
    "select user_id::varchar as key, arg_max(value, event_id)::varchar as value from events group by user_id",
)
def keyed_upsert_rows(spark, sf_dir):
    """What a keyed store holds after all rows."""
    last = stores.last_per_key(events(spark, sf_dir), "user_id", "value", "event_id")
    return last.select(F.col("user_id").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query(
    "json_documents",
    """select '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}'
       as document from events""",
)
def json_documents(spark, sf_dir):
    """The documents an index gets."""
    return stores.documents(events(spark, sf_dir).select("event_id", "user_id", "event_type"))


@query(
    "scalar_functions",
    """select event_id, string_split(event_type, 'i')[1] as head,
              event_type || '_' || user_id as label,
              epoch_us(ts) // 1000000 * 1000 as ms, epoch_us(ts) // 86400000000 as day,
              date_trunc('day', ts) + interval 1 day as midnight,
              user_id % 2 = 0 and value > 50 as picked,
              list_reduce(list_prepend(0::bigint, list_transform(string_split(user_id::varchar, ''),
                lambda z: ascii(z)::bigint)), lambda h, v: (h * 61 + v) & 1073741823) as bit
       from events""",
)
def scalar_functions(spark, sf_dir):
    from rivulet.functions import time

    ts = F.col("ts")
    seconds = F.unix_seconds(ts.cast("timestamp"))
    return events(spark, sf_dir).select(
        "event_id",
        text.token(F.col("event_type"), 0, "i").alias("head"),
        F.concat_ws("_", "event_type", "user_id").alias("label"),
        time.to_millis(seconds).alias("ms"),
        time.day_number(ts).cast("long").alias("day"),
        time.next_midnight(ts.cast("timestamp")).cast("timestamp_ntz").alias("midnight"),
        ((F.col("user_id") % 2 == 0) & (F.col("value") > 50)).alias("picked"),
        text.bitmap_offset(F.col("user_id")).alias("bit"),
    )


@query("sql_view", "select user_id, event_id, ts from events where event_type = 'signup'")
def sql_view(spark, sf_dir):
    events(spark, sf_dir).createOrReplaceTempView("rivulet_events")
    return spark.sql("select user_id, event_id, ts from rivulet_events where event_type = 'signup'")


@query(
    "retract_changelog",
    """select event_type, event_id, unnest([false, true]) as is_add, unnest([n - 1, n]) as cnt
       from (select event_type, event_id, row_number() over
               (partition by event_type order by event_id) as n from events) where n > 1
       union all
       select event_type, min(event_id), true, 1 from events group by event_type""",
)
def retract_changelog(spark, sf_dir):
    e = events(spark, sf_dir).select("event_type", "event_id")
    return changelog.retract_counts(e, ["event_type"], "event_id", "event_type")


@query(
    "lag_previous",
    """select event_id, user_id, value, lag(value) over (partition by user_id order by event_id)
         as last_value from events""",
)
def lag_previous(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "user_id", "value")
    return ranking.previous_value(e, ["user_id"], "event_id", "value", "last_value")


@query(
    "over_range_count",
    """select user_id, event_id, count(user_id) over
         (partition by user_id order by date_trunc('day', ts)) as cnt from events""",
)
def over_range_count(spark, sf_dir):
    # Whole days as time, so that rows of equal time occur.
    e = events(spark, sf_dir).select("user_id", "event_id", F.to_date("ts").alias("rt"))
    return ranking.over_range_count(e, ["user_id"], "rt", "user_id", "cnt").drop("rt")
