"""Running values over the rows of a key in a stated order, safe for hot keys.

A plain ``Window.partitionBy(key).orderBy(...)`` gives one task all rows of a key.
That is right for ordinary keys and wrong for a key that holds a third of the table.
``Layout`` finds such keys with one mergeable heavy-hitter sketch and cuts only their
rows into chunks along the order. A running value is then

    value inside the chunk  combined with  what the earlier chunks left behind,

where the second part is a small table: one pre-aggregated row per hot key and chunk.
Without hot keys the plan is the plain window: one shuffle, no join.

The sketch only decides the layout: results are the same whichever keys it reports. That
is why running sums take whole numbers and decimals only. An order must be unique within
a key; rows with equal order columns have no defined order in either plan.

A key below about 0.007 % of the rows, or beyond the first MAX_HOT_KEYS hot ones, may stay in
one task, and beyond 2 * 10^10 rows of a key its chunks grow; windows spill, so such tasks
are slow, not wrong.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.session import rows_per_chunk as default_rows_per_chunk

CHUNK = "_chunk"

# The sketch tracks this many items; it finds every key above a share of about
# 3.5 / SKETCH_ITEMS of the rows.
SKETCH_ITEMS = 50_000
MAX_HOT_KEYS = 5_000
MIN_CHUNKS, MAX_CHUNKS = 32, 10_000
# As many cuts are compared in one expression.
DIRECT_CUTS = 256


# A chunk is cut at one of this many sampled rows.
SAMPLE_PER_CHUNK = 20


def _halved(before: Callable[[int], Column], cuts: int, first: int = 0) -> Column:
    """How many of the cuts are not after the position, by halving: ``before(i)`` says
    whether the position is before cut i."""
    if not cuts:
        return F.lit(first)
    half = cuts // 2
    return F.when(before(first + half), _halved(before, half, first)).otherwise(
        _halved(before, cuts - half - 1, first + half + 1)
    )


@dataclass(frozen=True)
class Layout:
    """How the rows of each key are spread over tasks.

    Rows of the ``hot`` keys (all rows without keys) are cut at ``splits``: rows of the
    order columns, as text, evenly spaced in a sample. Spark compares whole rows, so any
    type that sorts will do, nulls come first and rows that share a time are spread.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    hot: tuple[int, ...] = ()
    splits: tuple[tuple[str | None, ...], ...] = ()
    rows_per_chunk: int = 1

    @property
    def chunked(self) -> bool:
        return bool(self.splits)

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the chunk number: it grows with the order and is null for ordinary keys."""
        kinds = [df.schema[c].dataType for c in self.order]
        cut = lambda i: F.struct(
            *[F.lit(v).cast(t) for v, t in zip(self.splits[i], kinds, strict=True)]
        )
        position, last = F.struct(*self.order), len(self.splits)
        if last <= DIRECT_CUTS:
            number = _halved(lambda i: position < cut(i), last)
        else:
            # As one expression they would be more than Spark can compile and the driver can
            # hold, so a group of cuts is found first; the cuts in it come as a row of a small
            # table. No lambda functions: with them Spark mixes up the sides of later joins.
            width = math.isqrt(last) + 1
            ends = [*range(width - 1, last - 1, width), last - 1]
            one = T.StructType([T.StructField(c, t) for c, t in zip(self.order, kinds, strict=True)])
            text = T.StructType([T.StructField(c, T.StringType()) for c in self.order])
            groups = [(g, list(self.splits[i : i + width])) for g, i in enumerate(range(0, last, width))]
            schema = T.StructType([T.StructField("_in", T.IntegerType()), T.StructField("_cuts", T.ArrayType(text))])
            table = df.sparkSession.createDataFrame(groups, schema)
            table = table.select("_in", F.col("_cuts").cast(T.ArrayType(one)).alias("_cuts"))
            df = df.withColumn("_group", _halved(lambda i: position < cut(ends[i]), len(ends)))
            # At most MAX_CHUNKS cuts in all.
            df = df.join(F.broadcast(table), F.col("_group") == F.col("_in"), "left")
            at = lambda i: F.get("_cuts", F.lit(i))
            inside = _halved(lambda i: F.coalesce(position < at(i), F.lit(True)), width)
            number = F.when(F.col("_group") == len(ends), last).otherwise(F.col("_group") * width + inside)
        number = number.cast("long")
        if self.keys:
            number = F.when(F.xxhash64(*self.keys).isin(list(self.hot)), number)
        return df.withColumn(CHUNK, number).drop("_group", "_in", "_cuts")


def layout(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_chunk: int | None = None,
) -> Layout:
    """Measure ``df`` and lay it out: one scan of the key columns, no shuffle.

    Only if there are hot keys their order column is read too, for its quantiles.
    With no keys the whole table is one group, so it is always chunked.
    """
    if df.isStreaming:
        raise ValueError("running values need a batch frame; see rivulet.streaming.processors")
    limit = rows_per_chunk or default_rows_per_chunk(df.sparkSession)
    plain = Layout(tuple(keys), tuple(order), rows_per_chunk=limit)
    hot: list[int] = []
    if keys:
        sketch = F.expr(f"approx_top_k(_h, {MAX_HOT_KEYS}, {SKETCH_ITEMS})").alias("top")
        top = df.select(F.xxhash64(*keys).alias("_h")).agg(sketch).first()["top"] or []
        sizes = {r["item"]: r["count"] for r in top if r["count"] > limit}
        if not sizes:
            return plain
        hot, rows = list(sizes), sum(sizes.values())
        measured = df.where(F.xxhash64(*keys).isin(hot))
    else:
        rows, measured = df.count(), df
    chunks = min(max(-(-rows // limit), MIN_CHUNKS), MAX_CHUNKS)
    wanted = SAMPLE_PER_CHUNK * chunks
    sampled = measured.select(*order)
    if rows > wanted:
        sampled = sampled.sample(False, min(1.0, 1.2 * wanted / rows), seed=1)
    # Bounded: about SAMPLE_PER_CHUNK rows per chunk, at most MAX_CHUNKS chunks. Only the
    # cuts among them come to the driver.
    ranked = sampled.distinct().select(
        *order,
        F.row_number().over(Window.orderBy(*order)).alias("_rank"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("_all"),
    )
    step = F.greatest(F.lit(1), F.floor(F.col("_all") / chunks))
    chosen = ranked.where((F.col("_rank") > step) & ((F.col("_rank") - 1) % step == 0))
    text = [F.col(c).cast("string").alias(f"_cut{i}") for i, c in enumerate(order)]
    splits = tuple(tuple(r)[1:] for r in sorted(chosen.select("_rank", *text).collect()))
    return Layout(tuple(keys), tuple(order), tuple(hot), splits, limit)


def refine(
    coarse: Layout,
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_chunk: int | None = None,
) -> Layout:
    """The layout of groups that lie inside the groups of ``coarse``.

    Where no coarse group is hot no finer one is, so ``df`` is measured only if needed.
    """
    if not coarse.chunked:
        return Layout(tuple(keys), tuple(order), rows_per_chunk=coarse.rows_per_chunk)
    return layout(df, keys, order, rows_per_chunk)


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` over ``value``; ``before`` leaves out the row itself."""

    kind: str
    value: Column | None = None
    before: bool = False


def running_sum(value: Column, before: bool = False) -> Running:
    return Running("sum", value, before)


def running_count(value: Column | None = None, before: bool = False) -> Running:
    """Count of rows, or of non-null values; without ``value`` it is the row number."""
    return Running("count", F.lit(1) if value is None else value, before)


def running_max(value: Column, before: bool = False) -> Running:
    return Running("max", value, before)


def running_min(value: Column, before: bool = False) -> Running:
    return Running("min", value, before)


def first_value(value: Column) -> Running:
    """The value of the key's first row, null or not."""
    return Running("first", F.struct(value.alias("v")))


def last_seen(value: Column, before: bool = False) -> Running:
    """The latest non-null value."""
    return Running("last", value, before)


def previous(value: Column) -> Running:
    """The value of the row just before, null or not."""
    return Running("previous", F.struct(value.alias("v")), True)


def _local(run: Running, window) -> Column:
    frame = window.rowsBetween(Window.unboundedPreceding, -1 if run.before else 0)
    v = run.value
    if run.kind == "sum":
        return F.sum(v).over(frame)
    if run.kind == "count":
        return F.count(v).over(frame)
    if run.kind == "max":
        return F.max(v).over(frame)
    if run.kind == "min":
        return F.min(v).over(frame)
    if run.kind == "first":
        return F.first(v).over(frame)
    if run.kind == "previous":
        return F.lag(v).over(window)
    return F.last(v, ignorenulls=True).over(frame)


def partial(run: Running, position: Column, reverse: bool = False) -> Column:
    """What a chunk of rows leaves behind for the rows after it."""
    v = run.value
    early, late = (F.max_by, F.min_by) if reverse else (F.min_by, F.max_by)
    if run.kind == "sum":
        return F.sum(v)
    if run.kind == "count":
        return F.count(v)
    if run.kind == "max":
        return F.max(v)
    if run.kind == "min":
        return F.min(v)
    if run.kind == "first":
        return early(v, position)
    return late(v, F.when(v.isNotNull(), position))


def _prefix(run: Running, part: str, earlier) -> Column:
    if run.kind in ("sum", "count"):
        return F.sum(part).over(earlier)
    if run.kind == "max":
        return F.max(part).over(earlier)
    if run.kind == "min":
        return F.min(part).over(earlier)
    if run.kind == "first":
        return F.first(part, ignorenulls=True).over(earlier)
    return F.last(part, ignorenulls=True).over(earlier)


def combine(run: Running, carry: Column, local: Column) -> Column:
    """A value inside a chunk with what earlier chunks left behind."""
    if run.kind == "sum":
        return F.coalesce(carry + local, local, carry)
    if run.kind == "count":
        return F.coalesce(carry, F.lit(0)) + local
    if run.kind == "max":
        return F.greatest(carry, local)
    if run.kind == "min":
        return F.least(carry, local)
    if run.kind == "first":
        return F.coalesce(carry, local)
    return F.coalesce(local, carry)


def _finish(run: Running, value: Column) -> Column:
    return value["v"] if run.kind in ("first", "previous") else value


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, Running],
    reverse: bool = False,
    plan: Layout | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Add running ``values`` per key along ``order`` (backwards with ``reverse``).

    ``order`` must be total within a key for the result to be deterministic. A
    ``plan`` measured earlier on the same rows can be reused. Batch frames only.
    """
    for name, run in values.items():
        if run.kind == "sum":
            kind = df.select(run.value.alias(name)).schema[name].dataType
            if isinstance(kind, (T.DoubleType, T.FloatType)):
                # Its rounding depends on where chunks end, so two plans would differ.
                raise ValueError(f"{name}: cast floating-point values to a decimal to sum them")
    plan = plan or layout(df, keys, order, rows_per_chunk)
    direction = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    if not plan.chunked:
        window = Window.partitionBy(*keys).orderBy(*direction)
        return df.select(
            "*", *[_finish(r, _local(r, window)).alias(n) for n, r in values.items()]
        )

    tagged = plan.tag(df)
    window = Window.partitionBy(*keys, CHUNK).orderBy(*direction)
    local = tagged.select(
        "*", *[_local(r, window).alias(f"_local_{n}") for n, r in values.items()]
    )

    # What each chunk of a hot key leaves behind, combined on the map side.
    position = F.struct(*order)
    parts = (
        tagged.where(F.col(CHUNK).isNotNull())
        .groupBy(*keys, CHUNK)
        .agg(*[partial(r, position, reverse).alias(f"_part_{n}") for n, r in values.items()])
    )
    toward = F.col(CHUNK).desc() if reverse else F.col(CHUNK).asc()
    # One row per chunk here, at most MAX_CHUNKS per key.
    earlier = (
        Window.partitionBy(*keys).orderBy(toward).rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = parts.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col(CHUNK).alias("_key_chunk"),
        *[_prefix(r, f"_part_{n}", earlier).alias(f"_carry_{n}") for n, r in values.items()],
    )
    match = F.col(CHUNK) == F.col("_key_chunk")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    joined = local.join(carry, match, "left")
    return joined.select(
        *df.columns,
        *[
            _finish(r, combine(r, F.col(f"_carry_{n}"), F.col(f"_local_{n}"))).alias(n)
            for n, r in values.items()
        ],
    )


def beside(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    before: str,
    after: str,
    plan: Layout | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Add ``before`` and ``after``: the value of the rows next to each one, null at the key's
    ends. Both directions share one shuffle; ``order`` must be total within a key."""
    plan = plan or layout(df, keys, order, rows_per_chunk)
    # Wrapped, so that a null value is told from no row.
    held = F.struct(value.alias("v"))
    if not plan.chunked:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.select(
            "*", F.lag(held).over(window)["v"].alias(before), F.lead(held).over(window)["v"].alias(after)
        )

    tagged = plan.tag(df)
    window = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    local = tagged.select(
        "*", F.lag(held).over(window).alias("_before"), F.lead(held).over(window).alias("_after")
    )
    # The ends of each chunk of a hot key, for the chunks next to it.
    position = F.struct(*order)
    ends = (
        tagged.where(F.col(CHUNK).isNotNull())
        .groupBy(*keys, CHUNK)
        .agg(F.min_by(held, position).alias("_first"), F.max_by(held, position).alias("_last"))
    )
    # One row per chunk here, at most MAX_CHUNKS per key.
    along = Window.partitionBy(*keys).orderBy(CHUNK)
    carry = ends.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col(CHUNK).alias("_key_chunk"),
        F.lag("_last").over(along).alias("_carry_before"),
        F.lead("_first").over(along).alias("_carry_after"),
    )
    match = F.col(CHUNK) == F.col("_key_chunk")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return local.join(carry, match, "left").select(
        *df.columns,
        F.coalesce("_before", "_carry_before")["v"].alias(before),
        F.coalesce("_after", "_carry_after")["v"].alias(after),
    )


def following(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    size: int,
    name: str,
    plan: Layout | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Add ``name``: the array of ``value`` over the row and the ``size - 1`` rows after it.

    Rows of hot keys are cut into blocks by row number; each block also receives the
    first ``size - 1`` rows of the next one, so every array is whole.
    """
    plan = plan or layout(df, keys, order, rows_per_chunk)
    valued = df.withColumn("_value", value)
    if not plan.chunked:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(0, size - 1)
        return valued.withColumn(name, F.collect_list("_value").over(window)).drop("_value")
    block = max(plan.rows_per_chunk, size)
    numbered = running(valued, keys, order, {"_rn": running_count()}, plan=plan)
    own = F.floor((F.col("_rn") - 1) / block)
    halo = (F.col("_rn") > block) & ((F.col("_rn") - 1) % block < size - 1)
    spread = numbered.select(
        "*",
        own.alias("_own"),
        F.explode(F.when(halo, F.array(own, own - 1)).otherwise(F.array(own))).alias("_block"),
    )
    window = Window.partitionBy(*keys, "_block").orderBy("_rn").rowsBetween(0, size - 1)
    return (
        spread.withColumn(name, F.collect_list("_value").over(window))
        .where(F.col("_own") == F.col("_block"))
        .drop("_value", "_rn", "_own", "_block")
    )
