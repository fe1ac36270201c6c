"""Exact replay of event-time progress over a table with an arrival order.

A watermark that follows every row stands, before row ``i``, at the largest event time
among the rows that arrived earlier, less the disorder bound. That prefix maximum needs no
key, so it is computed per chunk of the arrival order and carried across chunks; no task
sees the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.time import epoch_micros, micros
from rivulet.operators import ordered as o

ON_TIME, REFIRE, LATE = "on_time", "refire", "late"


def with_watermark_before(
    df: DataFrame,
    rt: str,
    seq: str,
    bound: str = "0 seconds",
    name: str = "wm_before",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Add the watermark (epoch microseconds) each row finds on arrival; null for the first."""
    latest = o.running_max(epoch_micros(F.col(rt)), before=True)
    out = o.running(df, [], [seq], {name: latest}, rows_per_chunk=rows_per_chunk)
    return out.withColumn(name, F.col(name) - F.lit(micros(bound)))


def classify(
    df: DataFrame,
    rt: str,
    seq: str,
    size: str,
    bound: str = "0 seconds",
    lateness: str = "0 seconds",
    slide: str | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """One row per input row and window with its ``status``.

    ``on_time``: the window had not fired yet. ``refire``: it had, but was kept for
    ``lateness`` longer. ``late``: it was gone. A window's last instant is one
    millisecond before its end.
    """
    marked = with_watermark_before(df, rt, seq, bound, rows_per_chunk=rows_per_chunk)
    return with_status(marked, rt, size, lateness, slide)


def with_status(
    marked: DataFrame, rt: str, size: str, lateness: str = "0 seconds", slide: str | None = None
) -> DataFrame:
    """:func:`classify` for rows that have ``wm_before``, which is taken out."""
    columns = [c for c in marked.columns if c != "wm_before"]
    spread = marked.withColumn("_w", F.window(rt, size, slide))
    closing = epoch_micros(F.col("_w.end")) - 1000
    wm = F.col("wm_before")
    status = (
        F.when(wm.isNull() | (closing > wm), ON_TIME)
        .when(wm < closing + F.lit(micros(lateness)), REFIRE)
        .otherwise(LATE)
    )
    return spread.select(
        *columns,
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        status.alias("status"),
    )


def split_late(
    df: DataFrame,
    rt: str,
    seq: str,
    size: str,
    bound: str = "0 seconds",
    lateness: str = "0 seconds",
    rows_per_chunk: int | None = None,
) -> dict[str, DataFrame]:
    """Rows a tumbling window accepts (``main``) and those that arrive after it is gone
    (``late``)."""
    tagged = classify(df, rt, seq, size, bound, lateness, rows_per_chunk=rows_per_chunk)
    late = F.col("status") == LATE
    return {
        "main": tagged.where(~late).select(*df.columns),
        "late": tagged.where(late).select(*df.columns),
    }


def firings(
    df: DataFrame,
    keys: Sequence[str],
    rt: str,
    seq: str,
    size: str,
    bound: str = "0 seconds",
    lateness: str = "0 seconds",
    slide: str | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Every result a window with allowed lateness gives: the count when it first fires,
    and again for each late row it still accepts (``seq`` of that row, else null)."""
    accepted = classify(df, rt, seq, size, bound, lateness, slide, rows_per_chunk).where(
        F.col("status") != LATE
    )
    group = [*keys, "window_start", "window_end"]
    first = accepted.where(F.col("status") == ON_TIME).groupBy(*group).agg(
        F.lit(None).cast("long").alias(seq), F.count("*").alias("cnt")
    )
    # Rows on time precede the late ones of their window, so a late row sees all of them.
    refires = accepted.where(F.col("status") == REFIRE)
    coarse = o.layout(df, keys, [seq], rows_per_chunk)
    plan = o.refine(coarse, refires, group, [seq], rows_per_chunk)
    late = o.running(refires, group, [seq], {"_late": o.running_count()}, plan=plan)
    on_time = first.select(*[F.col(g).alias(f"_k_{g}") for g in group], F.col("cnt").alias("_on"))
    match = F.lit(True)
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_k_{g}"))
    again = late.join(on_time, match, "left").select(
        *group,
        F.col(seq).cast("long").alias(seq),
        (F.coalesce(F.col("_on"), F.lit(0)) + F.col("_late")).alias("cnt"),
    )
    return first.select(*group, seq, "cnt", F.lit(ON_TIME).alias("firing")).unionByName(
        again.withColumn("firing", F.lit(REFIRE))
    )
