"""Time, session and count windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.time import epoch_micros, floor_div, interval, micros
from rivulet.operators import ordered as o
from rivulet.operators.batches import map_group_frames


def tumbling(
    df: DataFrame, keys: Sequence[str], rt: str, size: str, aggs: Sequence[Column]
) -> DataFrame:
    """Aggregates per key and epoch-aligned window ``[start, end)``. Batch and stream."""
    return _flatten(df.groupBy(*keys, F.window(rt, size).alias("w")).agg(*aggs), keys, aggs)


def sliding(
    df: DataFrame, keys: Sequence[str], rt: str, size: str, slide: str, aggs: Sequence[Column]
) -> DataFrame:
    """Aggregates per key and sliding window. Each row is copied ``size / slide`` times;
    use :func:`sliding_from_panes` for counts and sums over long windows."""
    grouped = df.groupBy(*keys, F.window(rt, size, slide).alias("w"))
    return _flatten(grouped.agg(*aggs), keys, aggs)


def _flatten(grouped: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    rest = [c for c in grouped.columns if c not in (*keys, "w")]
    return grouped.select(
        *keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest
    )


def sliding_from_panes(
    df: DataFrame,
    keys: Sequence[str],
    rt: str,
    size: str,
    slide: str,
    sums: dict[str, Column],
) -> DataFrame:
    """Sliding sums of whole numbers (``sums``: name -> value), without copying rows.

    Rows are added up per slide-wide pane. A pane raises a key's sums at the first window
    it belongs to and lowers them after the last; between two such changes the sums stay
    the same. So a running sum over two changes per pane gives all windows, whatever
    ``size / slide`` is. Changes are split into blocks of time, which bounds what one task
    orders; a pane whose windows reach into the next block is opened there again.

    Equal to :func:`sliding` when the slide divides the size.
    """
    size_us, slide_us = micros(size), micros(slide)
    if size_us % slide_us:
        raise ValueError("the slide must divide the window size")
    for field in df.select(*[v.alias(n) for n, v in sums.items()]).schema.fields:
        if isinstance(field.dataType, T.FractionalType) and not isinstance(
            field.dataType, T.DecimalType
        ):
            # Adding and taking away again is exact for whole numbers and decimals only.
            raise ValueError(f"{field.name}: use sliding for floating-point sums")
    panes = size_us // slide_us
    span = 16 * panes

    # A window is named by its end, in slides since the epoch.
    first = (floor_div(epoch_micros(F.col(rt)), slide_us) + 1).alias("_first")
    # Beside each sum how many values it has: a window without any is null, not 0.
    held = {n: f"_held_{n}" for n in sums}
    counted = df.where(F.col(rt).isNotNull()).groupBy(*keys, first).agg(
        F.count("*").alias("_rows"),
        *[F.coalesce(F.sum(v), F.lit(0)).alias(n) for n, v in sums.items()],
        *[F.count(v).alias(held[n]) for n, v in sums.items()],
    )
    start, after = F.col("_first"), F.col("_first") + panes
    block, next_block = floor_div(start, span), floor_div(after, span)

    def change(at: Column, where: Column, sign: int) -> Column:
        return F.struct(at.alias("at"), where.alias("block"), F.lit(sign).alias("sign"))

    opened, closed = change(start, block, 1), change(after, next_block, -1)
    reopened = change(next_block * span, next_block, 1)
    changes = F.when(block == next_block, F.array(opened, closed)).otherwise(
        F.array(opened, reopened, closed)
    )
    values = ["_rows", *sums, *held.values()]
    steps = counted.select(*keys, *values, F.explode(changes).alias("_c")).select(
        *keys,
        F.col("_c.block").alias("_block"),
        F.col("_c.at").alias("_at"),
        *[(F.col(v) * F.col("_c.sign")).alias(v) for v in values],
    )
    # At most three changes per pane of the block and of one window before it.
    window = Window.partitionBy(*keys, "_block").orderBy("_at")
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    levels = steps.select(
        *keys,
        "_at",
        F.coalesce(F.lead("_at").over(window), (F.col("_block") + 1) * span).alias("_until"),
        *[F.sum(v).over(so_far).alias(v) for v in values],
    )
    # Of several changes at once only the last has a stretch of windows after it.
    ends = F.explode(F.sequence(F.col("_at"), F.col("_until") - 1)).alias("_end")
    spread = levels.where((F.col("_until") > F.col("_at")) & (F.col("_rows") > 0))
    kind = df.schema[rt].dataType
    known = [F.when(F.col(h) > 0, F.col(n)).alias(n) for n, h in held.items()]
    return spread.select(*keys, ends, *known).select(
        *keys,
        F.timestamp_micros(F.col("_end") * slide_us - size_us).cast(kind).alias("window_start"),
        F.timestamp_micros(F.col("_end") * slide_us).cast(kind).alias("window_end"),
        *sums,
    )


def session(
    df: DataFrame,
    keys: Sequence[str],
    rt: str,
    gap: str,
    aggs: Sequence[Column],
    seq: str | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Aggregates per key and session, rows at most ``gap`` apart. Batch and stream.

    A session window orders all rows of a key in one task. With ``seq``, a unique row
    number, batch frames that have hot keys are computed by :func:`session_split`.
    """
    if seq is not None and not df.isStreaming:
        plan = o.layout(df, keys, [rt, seq], rows_per_chunk)
        if plan.chunked:
            return session_split(df, keys, rt, seq, gap, aggs, plan=plan)
    grouped = df.groupBy(*keys, F.session_window(rt, gap).alias("w"))
    return _flatten(grouped.agg(*aggs), keys, aggs)


def session_split(
    df: DataFrame,
    keys: Sequence[str],
    rt: str,
    seq: str,
    gap: str,
    aggs: Sequence[Column],
    rows_per_chunk: int | None = None,
    plan: o.Layout | None = None,
) -> DataFrame:
    """:func:`session` for batch frames whose hot keys must be split over tasks.

    Rows without a time belong to no session, as there.
    """
    df = df.where(F.col(rt).isNotNull())
    plan = plan or o.layout(df, keys, [rt, seq], rows_per_chunk)
    stepped = o.running(df, keys, [rt, seq], {"_prev": o.previous(F.col(rt))}, plan=plan)
    opens = F.col("_prev").isNull() | (F.col(rt) > F.col("_prev") + interval(gap))
    numbered = o.running(
        stepped.withColumn("_opens", opens),
        keys,
        [rt, seq],
        {"_session": o.running_count(F.when(F.col("_opens"), 1))},
        plan=plan,
    )
    bounds = [
        F.min(rt).alias("window_start"),
        (F.max(rt) + interval(gap)).alias("window_end"),
    ]
    return numbered.groupBy(*keys, "_session").agg(*bounds, *aggs).drop("_session")


def count_tumbling(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    size: int,
    aggs: Sequence[Column],
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Aggregates over every ``size`` rows of a key in arrival order; full panes only."""
    numbered = o.running(df, keys, [seq], {"_rn": o.running_count()}, rows_per_chunk=rows_per_chunk)
    pane = (F.floor((F.col("_rn") - 1) / size) + 1).alias("pane")
    grouped = numbered.groupBy(*keys, pane).agg(F.count("*").alias("_n"), *aggs)
    return grouped.where(F.col("_n") == size).drop("_n")


def count_sliding(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    size: int,
    slide: int,
    values: dict[str, Column | o.Running],
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """After every ``slide`` rows of a key, ``values`` over its last ``size`` rows at most.

    Running sums and counts (``ordered.running_sum``, ``running_count``) are differences: a
    firing's row meets the one row that stands ``size`` rows before it, by key and row number,
    so hot keys spread and no row is copied. Other aggregates (columns) are taken over a frame
    of rows; hot keys are cut into blocks by row number, and each block also gets the last
    ``size - 1`` rows of the one before. Neither depends on ``size / slide``.
    """
    plan = o.layout(df, keys, [seq], rows_per_chunk)
    if all(isinstance(v, o.Running) for v in values.values()):
        return _count_sliding_sums(df, keys, seq, size, slide, values, plan)
    numbered = o.running(df, keys, [seq], {"_rn": o.running_count()}, plan=plan)
    group = list(keys)
    own = F.lit(True)
    if plan.chunked:
        block = max(plan.rows_per_chunk, size)
        at = F.floor((F.col("_rn") - 1) / block)
        rows = numbered.withColumn("_block", at).withColumn("_own", F.lit(True))
        tail = rows.where((F.col("_rn") - 1) % block > block - size)
        numbered = rows.unionByName(tail.withColumn("_block", at + 1).withColumn("_own", F.lit(False)))
        group, own = [*keys, "_block"], F.col("_own")
    frame = Window.partitionBy(*group).orderBy("_rn").rowsBetween(1 - size, 0)
    out = numbered.select("*", *[v.over(frame).alias(n) for n, v in values.items()])
    return out.where(own & (F.col("_rn") % slide == 0)).select(
        *keys, (F.col("_rn") / slide).cast("long").alias("firing"), *values
    )


def _count_sliding_sums(df, keys, seq, size, slide, values, plan) -> DataFrame:
    if any(v.kind not in ("sum", "count") or v.before for v in values.values()):
        raise ValueError("only running sums and counts are differences")
    known = {f"_n_{n}": o.running_count(v.value) for n, v in values.items() if v.kind == "sum"}
    rows = o.running(df, keys, [seq], {"_rn": o.running_count(), **values, **known}, plan=plan)
    ends = rows.where(F.col("_rn") % slide == 0).select(*keys, "_rn", *values, *known)
    starts = rows.where((F.col("_rn") + size) % slide == 0).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        (F.col("_rn") + size).alias("_end"),
        *[F.col(n).alias(f"_less_{n}") for n in (*values, *known)],
    )
    match = F.col("_rn") == F.col("_end")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))

    def since(n: str) -> Column:
        return F.col(n) - F.coalesce(f"_less_{n}", F.lit(0))

    # A window without any value has no sum.
    total = {
        n: F.when(since(f"_n_{n}") > 0, since(n)) if v.kind == "sum" else since(n) for n, v in values.items()
    }
    return ends.join(starts, match, "left").select(
        *keys,
        (F.col("_rn") / slide).cast("long").alias("firing"),
        *[c.alias(n) for n, c in total.items()],
    )


def rows_at_rank(
    df: DataFrame,
    keys: Sequence[str],
    rt: str,
    size: str,
    order: Sequence[str],
    rank: Column,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Of each key and tumbling window the row whose place in ``order``, from 1, is ``rank``,
    an expression over ``cnt``, the window's rows: an exact median, say. ``order`` is unique.

    Places are running counts, which cut a hot window into chunks; no window is held whole.
    Added: ``window_start``, ``window_end``, ``cnt``.
    """
    stamped = df.withColumn("_w", F.window(rt, size)).select(
        *df.columns, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")
    )
    group = [*keys, "window_start", "window_end"]
    plan = o.layout(stamped, group, order, rows_per_chunk)
    placed = o.running(stamped, group, order, {"_place": o.running_count()}, plan=plan)
    sizes = stamped.groupBy(*group).agg(F.count("*").alias("cnt")).select(
        *[F.col(g).alias(f"_k_{g}") for g in group], "cnt"
    )
    match = F.col("_place") == rank
    for g in group:
        match = match & F.col(g).eqNullSafe(F.col(f"_k_{g}"))
    return placed.join(sizes, match).select(*df.columns, "window_start", "window_end", "cnt")


def process_window(
    df: DataFrame,
    keys: Sequence[str],
    rt: str,
    size: str,
    fn: Callable,
    schema: str,
) -> DataFrame:
    """Apply ``fn(key, batches)`` to the rows of each key and window.

    The key tuple ends with the window's start and end. ``batches`` is an iterator of
    pandas frames, so a large window is read piece by piece; ``fn`` yields frames. Whole
    numbers have pandas' nullable types. Prefer built-in aggregates, which combine before
    the shuffle; this is for functions they cannot express.
    """
    stamped = df.withColumn("_w", F.window(rt, size)).select(
        *df.columns, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")
    )
    return map_group_frames(stamped, [*keys, "window_start", "window_end"], fn, schema)


def processing_time_windows(
    stream: DataFrame, keys: Sequence[str], size: str, aggs: Sequence[Column], delay: str = "0 seconds"
) -> DataFrame:
    """Tumbling windows over the time rows are read (streams; not reproducible)."""
    stamped = stream.withColumn("_read_at", F.current_timestamp()).withWatermark("_read_at", delay)
    return tumbling(stamped, keys, "_read_at", size, aggs)


def distinct_per_window(
    df: DataFrame, keys: Sequence[str], rt: str, size: str, value: str, name: str = "uv"
) -> DataFrame:
    """Exact distinct ``value``s per window; duplicates fold on the map side.

    Works on streams too: duplicates are dropped per window before counting.
    """
    columns = [F.col(k) for k in keys]
    stamped = df.select(*columns, F.window(rt, size).alias("w"), F.col(value).alias("_v"))
    once = stamped.dropDuplicates([*keys, "w", "_v"])
    return _flatten(once.groupBy(*keys, "w").agg(F.count("_v").alias(name)), keys, [])


def running_in_window(
    df: DataFrame,
    keys: Sequence[str],
    rt: str,
    seq: str,
    size: str,
    values: dict[str, o.Running],
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """The value so far inside the row's window, one output per row: what a trigger that
    fires on every element shows."""
    stamped = df.withColumn("window_end", F.window(rt, size)["end"])
    coarse = o.layout(df, keys, [seq], rows_per_chunk)
    group = [*keys, "window_end"]
    plan = o.refine(coarse, stamped, group, [seq], rows_per_chunk)
    return o.running(stamped, group, [seq], values, plan=plan)
