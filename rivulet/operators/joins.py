"""Window, interval and one-to-one joins; enrichment with the latest control value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.time import epoch_micros, floor_div, interval, micros
from rivulet.operators import ordered as o


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def _equal(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(f"l_{k}") == F.col(f"r_{k}"))
    return condition


def window_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], rt: str, size: str
) -> DataFrame:
    """Inner join of rows with equal ``keys`` in the same tumbling window.

    Output columns are prefixed ``l_`` and ``r_``, and the window bounds are added. The window
    is an equality key, so a hot key spreads over its windows.
    """
    a = _prefixed(left.withColumn("w", F.window(rt, size)), "l_")
    b = _prefixed(right.withColumn("w", F.window(rt, size)), "r_")
    joined = a.join(b, _equal([*keys, "w"]))
    return joined.select(
        F.col("l_w.start").alias("window_start"),
        F.col("l_w.end").alias("window_end"),
        *[c for c in joined.columns if c not in ("l_w", "r_w")],
    )


def _within(lower: str, upper: str) -> Column:
    return F.col("r__t").between(
        F.col("l__t") + interval(lower), F.col("l__t") + interval(upper)
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    lower: str,
    upper: str,
    condition: Column | None = None,
) -> DataFrame:
    """Pairs with equal ``keys`` and right time in ``[left + lower, left + upper]``, both
    ends included. Output columns are prefixed ``l_`` and ``r_``; ``condition`` uses them.

    Batch: both sides get a time bucket as wide as the interval and join on (key,
    bucket), so no task holds a whole hot key and only neighbours meet. Streams: the range
    goes into the join condition, and the watermarks on both sides bound the state.
    """
    a = _prefixed(left.withColumn("_t", F.col(left_time)), "l_")
    b = _prefixed(right.withColumn("_t", F.col(right_time)), "r_")
    extra = condition if condition is not None else F.lit(True)
    keep = [c for c in (*a.columns, *b.columns) if c not in ("l__t", "r__t")]
    if left.isStreaming or right.isStreaming:
        return a.join(b, _equal(keys) & _within(lower, upper) & extra).select(*keep)
    width = max(1, micros(upper) - micros(lower))

    reach = floor_div(epoch_micros(F.col("l__t")) + F.lit(micros(lower)), width)
    b = b.withColumn("r__bucket", floor_div(epoch_micros(F.col("r__t")), width))
    # An interval touches the bucket it starts in and the next.
    a = a.withColumn("l__bucket", F.explode(F.array(reach, reach + 1)))
    return a.join(b, _equal([*keys, "_bucket"]) & _within(lower, upper) & extra).select(*keep)


def right_join(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    """All right rows, with their left partners where there are any (batch)."""
    return left.join(right, condition, "right")


def match_occurrences(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_seq: str,
    right_seq: str,
    how: str = "inner",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Pair the k-th row of a key on the left with the k-th on the right.

    ``how="full"`` also keeps rows without a partner. Joining on (key, k) spreads hot keys.
    """
    a = o.running(left, keys, [left_seq], {"_k": o.running_count()}, rows_per_chunk=rows_per_chunk)
    b = o.running(right, keys, [right_seq], {"_k": o.running_count()}, rows_per_chunk=rows_per_chunk)
    return (
        _prefixed(a, "l_")
        .join(_prefixed(b, "r_"), _equal([*keys, "_k"]), how)
        .drop("l__k", "r__k")
    )


def match_waiting(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    seq: str,
    rows_per_chunk: int | None = None,
) -> dict[str, DataFrame]:
    """One-to-one matching as two inputs arrive in the common order ``seq``.

    A row whose key has a waiting row on the other side pairs with it and both are
    done; otherwise it waits, replacing a row of its own side that waited. Gives
    ``matches`` (columns prefixed ``l_``, ``r_``), and the rows left waiting at the end as
    ``left`` and ``right``.

    At most one side of a key waits at a time. In runs of equal side, only the first row
    of a run can match, and only the last row of the run before can be waiting for it. A run
    of two rows or more always leaves one waiting; a run of one does unless it matched.
    So whether a run's first row matches depends on the distance to the last longer
    run, odd or even: three running values instead of a sequential pass.
    """
    both = (
        _prefixed(left, "l_")
        .select(*[F.col(f"l_{k}").alias(k) for k in keys], F.col(f"l_{seq}").alias("_seq"),
                F.lit("l").alias("_side"), F.struct(*[f"l_{c}" for c in left.columns]).alias("_l"))
        .unionByName(
            _prefixed(right, "r_").select(
                *[F.col(f"r_{k}").alias(k) for k in keys], F.col(f"r_{seq}").alias("_seq"),
                F.lit("r").alias("_side"),
                F.struct(*[f"r_{c}" for c in right.columns]).alias("_r")),
            allowMissingColumns=True,
        )
    )
    plan = o.layout(both, keys, ["_seq"], rows_per_chunk)
    sided = o.running(both, keys, ["_seq"], {"_before": o.previous(F.col("_side"))}, plan=plan)
    opens = ~F.col("_side").eqNullSafe(F.col("_before"))
    runs = o.running(
        sided.withColumn("_opens", opens),
        keys,
        ["_seq"],
        {"_run": o.running_count(F.when(F.col("_opens"), 1))},
        plan=plan,
    )
    row = F.struct("_l", "_r")
    summary = runs.groupBy(*keys, "_run").agg(
        F.count("*").alias("_n"),
        F.min("_seq").alias("_seq"),
        F.min_by(row, "_seq").alias("_head"),
        F.max_by(row, "_seq").alias("_tail"),
    )
    long_run = F.when(F.col("_n") > 1, F.col("_run"))
    # Distance to the last longer run before this one; before the first run nothing waits.
    stepped = o.running(
        summary,
        keys,
        ["_run"],
        {"_long": o.last_seen(long_run, before=True), "_waiting_row": o.previous(F.col("_tail"))},
        plan=o.refine(plan, summary, keys, ["_run"], rows_per_chunk),
    )
    since = F.col("_run") - F.coalesce(F.col("_long"), F.lit(0))
    odd = since % 2 == 1
    waiting = F.when(F.col("_long").isNotNull(), odd).otherwise(~odd)
    state = stepped.withColumn("_matches", waiting)

    def side(name: str, *places: str) -> Column:
        return F.coalesce(*[F.col(f"{p}.{name}") for p in places])

    matches = state.where("_matches").select(
        side("_l", "_head", "_waiting_row").alias("l"),
        side("_r", "_head", "_waiting_row").alias("r"),
    )
    # A row still waits at the end if the key's last run leaves one.
    last = state.groupBy(*keys).agg(
        F.max_by(F.struct("_n", "_matches", "_tail"), "_run").alias("_end")
    )
    open_ = last.where((F.col("_end._n") > 1) | ~F.col("_end._matches"))

    def strip(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
        field = F.col(f"_end._tail.{name}")
        return df.where(field.isNotNull()).select(
            *[field[f"{name[1:]}_{c}"].alias(c) for c in columns]
        )

    return {
        "matches": matches.select("l.*", "r.*"),
        "left": strip(open_, "_l", left.columns),
        "right": strip(open_, "_r", right.columns),
    }


def enrich_latest(
    main: DataFrame,
    control: DataFrame,
    seq: str,
    value: Column,
    name: str,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Add to each main row the control value that arrived last before it (null before the
    first). ``seq`` orders both inputs together."""
    rows = main.withColumn("_is_main", F.lit(True))
    switches = control.select(F.col(seq), value.alias("_control"), F.lit(False).alias("_is_main"))
    both = rows.unionByName(switches, allowMissingColumns=True)
    # A struct, so that a null control value also replaces the one before it.
    wrapped = F.when(~F.col("_is_main"), F.struct(F.col("_control").alias("v")))
    out = o.running(both, [], [seq], {"_latest": o.last_seen(wrapped)}, rows_per_chunk=rows_per_chunk)
    return out.where("_is_main").select(*main.columns, F.col("_latest.v").alias(name))
