"""Plans of all batch queries: what may meet in one task, what is read."""

import os
import re

import pytest

import __spark_entry__ as entry
from rivulet.plans import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


def plan_lines(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def indent(line):
    return len(re.match(r"[\s:|+-]*", line).group())


@pytest.mark.parametrize("name", BATCH)
def test_one_task_gets_summaries_only(spark, name):
    lines = plan_lines(entry.queries()[name](spark, SF_DIR))
    assert not any("CartesianProduct" in x or "BroadcastNestedLoopJoin" in x for x in lines)
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = next(x for x in lines[i + 1 :] if "Aggregate" in x or "Scan" in x)
            keys = re.search(r"keys?=\[([^\]]*)\]", child)
            # Either a global aggregate's partials, or one row per chunk.
            assert keys and (keys.group(1) == "" or "_chunk" in keys.group(1)), line


@pytest.mark.parametrize(
    "name,columns",
    [
        ("running_sum", {"event_id", "user_id"}),
        ("tumbling_count", {"user_id", "ts"}),
        ("hot_items_topn", {"ts", "event_type", "props"}),
        ("cep_followed_by", {"event_id", "ts", "user_id", "event_type"}),
        ("order_timeout", {"o_orderkey", "o_orderdate", "l_orderkey", "l_shipdate"}),
    ],
)
def test_reads_only_needed_columns(spark, name, columns):
    text = "\n".join(plan_lines(entry.queries()[name](spark, SF_DIR)))
    read = {c.split("#")[0] for s in re.findall(r"FileScan parquet \[([^\]]*)\]", text) for c in s.split(",")}
    assert read == columns


def test_filters_reach_the_scan(spark):
    for name in ("hot_items_topn", "page_views_hourly", "window_join"):
        df = entry.queries()[name](spark, SF_DIR)
        assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type" in df._jdf.queryExecution().toString()


def test_hot_keys_give_the_same_rows(spark):
    """The whole query set's keyed scans with every common key treated as hot."""
    from rivulet.session import ROWS_PER_CHUNK

    names = [
        "running_max_min", "running_distinct", "count_window_sliding", "retract_changelog",
        "over_range_count", "match_occurrences", "reconcile_connect", "cep_within",
        "cep_followed_by", "cep_three_stages", "cep_times", "login_fail_process",
        "rising_level_alarm", "session_gap", "lateness_firings",
    ]
    for name in names:
        query = entry.queries()[name]
        plain = query(spark, SF_DIR)
        order = plain.columns
        expected = sorted(map(repr, plain.collect()))
        spark.conf.set(ROWS_PER_CHUNK, "25")
        try:
            split = query(spark, SF_DIR).select(*order)
            got = sorted(map(repr, split.collect()))
        finally:
            spark.conf.unset(ROWS_PER_CHUNK)
        assert got == expected, name
