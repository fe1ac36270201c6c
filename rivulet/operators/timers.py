"""Event-time timers anchored at the first row of a group (batch).

A row opens a timer when none is pending; later rows of the key join it until the
watermark has reached its deadline, and the next row opens another. So every row has one
possible successor: the first row that finds a watermark at or beyond its deadline. As the
watermark only grows along a key's rows, successors are found by sorted search, and the
rows that open a timer are those reached from the first one. They are marked by pointer
doubling: with pointers that skip 1, 2, 4, ... openers a chain of n takes log n steps, each
over all rows at once.

The groups of ordinary keys lie whole in a task. The rows of a hot key are cut into chunks.
In a chunk a chain ends at a row whose successor lies in a later chunk; its pointer leads to
the end of the chain that its successor starts there. These pointers are a table, doubled by
joins, whose marked rows are what is pending at the start of each chunk.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.time import interval, micros
from rivulet.operators import ordered as o
from rivulet.operators.batches import changes, map_frames, whole_groups
from rivulet.operators.eventtime import with_watermark_before
from rivulet.session import run_folder

NONE_PENDING = -(2**62)


def anchored(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    rt: str,
    wm: str,
    delay: str,
    plan: o.Layout,
) -> DataFrame:
    """Add ``anchor`` (the ``seq`` of the row that opened the row's timer) and ``deadline``
    (when that timer is due, epoch microseconds).

    ``wm`` is the watermark each row finds, as added by ``with_watermark_before``. A timer
    set for the past is due when the watermark next moves.
    """
    found = F.coalesce(F.col(wm), F.lit(NONE_PENDING))
    due = F.unix_micros(F.col(rt).cast("timestamp")) + F.lit(micros(delay))
    rows = df.withColumn("_wm", found).withColumn("_due", F.greatest(due, found + 1))
    if not plan.chunked:
        opened = rows.withColumn("_due_in", F.lit(NONE_PENDING)).withColumn(
            "_anchor_in", F.lit(None).cast("long")
        )
        return _walk(opened, keys, seq).drop("_wm", "_due", "_due_in", "_anchor_in")

    # Read twice below.
    rows = plan.tag(_kept(rows, "timer-rows"))
    entries = _entries(rows.where(F.col(o.CHUNK).isNotNull()), keys, seq, plan.rows_per_chunk)
    match = F.col(o.CHUNK) == F.col("_key_chunk")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    opened = rows.join(entries, match, "left").select(
        *rows.columns,
        F.coalesce("_due_in", F.lit(NONE_PENDING)).alias("_due_in"),
        "_anchor_in",
    )
    walked = _walk(opened, [*keys, o.CHUNK], seq)
    return walked.drop("_wm", "_due", "_due_in", "_anchor_in", o.CHUNK)


def _after(group: np.ndarray, found: np.ndarray, due: np.ndarray) -> np.ndarray:
    """The first row of the group that finds the watermark at ``due``; n where there is none.

    Groups are numbered in order and ``found`` grows inside a group.
    """
    n = len(group)
    values = np.unique(np.concatenate([found, due]))
    width = len(values) + 1
    line = group * width + np.searchsorted(values, found)
    after = np.searchsorted(line, group * width + np.searchsorted(values, due))
    return np.where(after < np.searchsorted(group, group, side="right"), after, n)


def _reached(starts: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Rows on the chains from ``starts``, by doubling pointers."""
    n = len(after)
    pointer, marked = np.append(after, n), np.zeros(n + 1, bool)
    marked[starts] = True
    while (pointer[:n] < n).any():
        marked[pointer[np.flatnonzero(marked[:n])]] = True
        pointer = pointer[pointer]
    return marked[:n]


def _ends(after: np.ndarray) -> np.ndarray:
    """The last row of the chain from each row, by doubling pointers."""
    n = len(after)
    pointer = np.where(after < n, after, np.arange(n))
    while True:
        further = pointer[pointer]
        if (further == pointer).all():
            return pointer
        pointer = further


def _long(rows: pd.DataFrame, column: str) -> np.ndarray:
    return rows[column].to_numpy(np.int64)


def _walk(rows: DataFrame, group: Sequence[str], seq: str) -> DataFrame:
    """Add anchor and deadline to rows whose groups, or chunks of groups, are small enough."""
    group = list(group)
    longs = [T.StructField("anchor", T.LongType()), T.StructField("deadline", T.LongType())]
    schema = T.StructType([*rows.schema.fields, *longs])

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches, group):
            new = changes(part, group)
            number = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            found, due, due_in = (_long(part, c) for c in ("_wm", "_due", "_due_in"))
            # The first row that finds the timer pending at the start gone.
            starts = _after(number, found, due_in)[first]
            opens = _reached(starts[starts < len(part)], _after(number, found, due))
            opener = np.maximum.accumulate(np.where(opens, np.arange(len(part)), -1))
            own = opener >= first[number]
            anchor = part["_anchor_in"].astype("Int64").where(~own, part[seq].take(opener).to_numpy())
            yield part.assign(anchor=anchor, deadline=np.where(own, due[opener], due_in))

    # Partitioned and sorted on the same columns, so each task sees whole groups in order.
    parts = rows.repartition(*group).sortWithinPartitions(*group, seq)
    return map_frames(parts, task, schema)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: its lineage ends there."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _entries(rows: DataFrame, keys: Sequence[str], seq: str, limit: int) -> DataFrame:
    """The timer pending at the start of every chunk of the hot keys."""
    keys = list(keys)
    narrow = rows.select(*keys, o.CHUNK, seq, "_wm", "_due")
    schema = T.StructType([*narrow.schema.fields, T.StructField("_end", T.LongType())])
    group = [*keys, o.CHUNK]

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches, group):
            number = np.cumsum(changes(part, group)) - 1
            found, due, seqs = (_long(part, c) for c in ("_wm", "_due", seq))
            yield part.assign(_end=seqs[_ends(_after(number, found, due))])

    parts = narrow.repartition(*group).sortWithinPartitions(*group, seq)
    steps = _kept(map_frames(parts, task, schema), "timer-chunks").withColumnRenamed(seq, "_seq")

    def same(left: DataFrame, right: DataFrame, column: str, other: str) -> Column:
        match = left[column] == right[other]
        for k in keys:
            match = match & left[k].eqNullSafe(right[f"_to_{k}"])
        return match

    def pointed(table: DataFrame, **columns: str) -> DataFrame:
        return table.select(
            *[F.col(k).alias(f"_to_{k}") for k in keys], *[F.col(c).alias(n) for n, c in columns.items()]
        )

    # Rows that end their chunk's chain look for the first row that finds their deadline,
    # among all rows of the key by the watermark they find.
    chain_end = F.col("_seq") == F.col("_end")
    asks = steps.where(chain_end).select(
        *keys, F.col("_due").alias("_at"), F.lit(0).alias("_kind"), "_seq", F.lit(None).cast("long").alias("_to")
    )
    told = steps.select(*keys, F.col("_wm").alias("_at"), F.lit(1).alias("_kind"), "_seq", F.col("_end").alias("_to"))
    step = {"_next": o.last_seen(F.when(F.col("_kind") == 1, F.col("_to")), before=True)}
    found = o.running(
        asks.unionByName(told), keys, ["_at", "_kind", "_seq"], step, reverse=True, rows_per_chunk=limit
    )
    pointers = _kept(
        found.where("_kind = 0 and _next is not null").select(*keys, "_seq", "_next"), "timer-pointers"
    )

    # What the first row of each key leads to is reached; pointers double until none is left.
    starts = steps.groupBy(*keys).agg(F.min_by("_end", "_seq").alias("_seq"))
    reached = _kept(starts, "timer-reached")
    while not pointers.isEmpty():
        hop = pointed(pointers, _from="_seq", _hop="_next")
        further = reached.join(hop, same(reached, hop, "_seq", "_from")).select(
            *[reached[k] for k in keys], F.col("_hop").alias("_seq")
        )
        reached = _kept(reached.unionByName(further).distinct(), "timer-reached")
        pointers = _kept(
            pointers.join(hop, same(pointers, hop, "_next", "_from")).select(
                *[pointers[k] for k in keys], pointers["_seq"], F.col("_hop").alias("_next")
            ),
            "timer-pointers",
        )

    # Of each chunk at most one chain end is reached; a chunk takes the latest before it.
    mark = pointed(reached, _marked="_seq")
    ends = steps.where(chain_end)
    pending = ends.join(mark, same(ends, mark, "_seq", "_marked")).select(
        *[ends[k] for k in keys], ends[o.CHUNK], F.struct(ends["_due"].alias("due"), ends["_seq"].alias("seq")).alias("_p")
    )
    chunks = steps.select(*keys, o.CHUNK).distinct().withColumn("_p", F.lit(None).cast("struct<due:bigint,seq:bigint>"))
    # One row per chunk of a key here.
    one = chunks.unionByName(pending).groupBy(*keys, o.CHUNK).agg(F.max("_p").alias("_p"))
    earlier = Window.partitionBy(*keys).orderBy(o.CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    entry = one.withColumn("_in", F.last("_p", ignorenulls=True).over(earlier))
    return entry.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col(o.CHUNK).alias("_key_chunk"),
        F.col("_in.due").alias("_due_in"),
        F.col("_in.seq").alias("_anchor_in"),
    )


def repeated_failures(
    df: DataFrame,
    key: str,
    rt: str,
    seq: str,
    success: Column,
    window: str,
    least: int = 2,
    bound: str = "0 seconds",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Keys with ``least`` or more failures before a success or within ``window`` of the
    first, in arrival order.

    The first failure sets a timer; a success ends the count, a timer too. Gives per
    alarm the number of ``failures``, the ``first_seq`` and what ended it: ``closed_by`` is
    ``success`` or ``timer``.
    """
    plan = o.layout(df, [key], [seq], rows_per_chunk)
    marked = with_watermark_before(df, rt, seq, bound, rows_per_chunk=rows_per_chunk)
    marked = marked.select(key, rt, seq, "wm_before", success.alias("_ok"))
    segments = o.running(
        marked,
        [key],
        [seq],
        {"_segment": o.running_count(F.when(F.col("_ok"), 1), before=True)},
        plan=plan,
    )
    fails = _until(segments, key, seq, F.col("_ok"), plan).where(~F.col("_ok")).drop("_ok")
    fine = o.refine(plan, fails, [key, "_segment"], [seq], rows_per_chunk)
    timed = anchored(fails, [key, "_segment"], seq, rt, "wm_before", window, fine)
    groups = timed.groupBy(key, "_segment", "anchor").agg(
        F.count("*").alias("failures"),
        F.max("deadline").alias("_deadline"),
        F.max("_end_wm").alias("_end_wm"),
    )
    return groups.where(F.col("failures") >= least).select(
        key,
        F.col("anchor").alias("first_seq"),
        "failures",
        F.when(_ended_first(), "success").otherwise("timer").alias("closed_by"),
    )


def _until(df: DataFrame, key: str, seq: str, ends: Column, plan: o.Layout) -> DataFrame:
    """Add ``_end_wm``: the watermark found by the next row that ``ends`` a segment."""
    found = F.when(ends, F.coalesce(F.col("wm_before"), F.lit(NONE_PENDING)))
    step = {"_end_wm": o.last_seen(found, before=True)}
    return o.running(df, [key], [seq], step, reverse=True, plan=plan)


def _ended_first() -> Column:
    """The segment ended while the group's timer was pending.

    The watermark only grows: a timer after which another one was opened was due then, and
    so before the segment's end. This can hold for a segment's last group only.
    """
    return F.coalesce(F.col("_end_wm") < F.col("_deadline"), F.lit(False))


def rising_alarms(
    df: DataFrame,
    key: str,
    rt: str,
    seq: str,
    value: str,
    hold: str,
    bound: str = "0 seconds",
    floor: float = -1,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Keys whose ``value`` kept rising for ``hold``, in arrival order.

    The first rising row sets a timer, a row that does not rise cancels it; when it is due
    the alarm is raised and the next rising row starts over. Gives the row that set it
    (``first_seq``) and ``alarm_ts``. A key's first row compares with ``floor``.
    """
    plan = o.layout(df, [key], [seq], rows_per_chunk)
    marked = with_watermark_before(df, rt, seq, bound, rows_per_chunk=rows_per_chunk)
    marked = marked.select(key, rt, seq, value, "wm_before")
    stepped = o.running(marked, [key], [seq], {"_last": o.previous(F.col(value))}, plan=plan)
    rising = F.coalesce(F.col(value) > F.coalesce(F.col("_last"), F.lit(floor)), F.lit(False))
    segments = o.running(
        stepped.withColumn("_rising", rising),
        [key],
        [seq],
        {"_segment": o.running_count(F.when(~F.col("_rising"), 1))},
        plan=plan,
    )
    rises = _until(segments, key, seq, ~F.col("_rising"), plan).where("_rising")
    rises = rises.select(key, rt, seq, "wm_before", "_segment", "_end_wm")
    fine = o.refine(plan, rises, [key, "_segment"], [seq], rows_per_chunk)
    timed = anchored(rises, [key, "_segment"], seq, rt, "wm_before", hold, fine)
    groups = timed.groupBy(key, "_segment", "anchor").agg(
        F.max("deadline").alias("_deadline"),
        F.max("_end_wm").alias("_end_wm"),
        F.max(F.when(F.col(seq) == F.col("anchor"), F.col(rt))).alias("_start"),
    )
    return groups.where(~_ended_first()).select(
        key, F.col("anchor").alias("first_seq"), (F.col("_start") + interval(hold)).alias("alarm_ts")
    )
