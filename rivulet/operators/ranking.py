"""Top-N per window, over windows, previous value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.text import report
from rivulet.operators import ordered as o


def top_n(
    df: DataFrame,
    group: Sequence[str],
    count: str,
    ties: Sequence[str],
    n: int,
    name: str = "rank",
) -> DataFrame:
    """The ``n`` rows with the largest ``count`` per group, ties by ascending ``ties``.

    Spark limits each group to ``n`` rows per task before the shuffle, so a group of any
    size sends few rows.
    """
    window = Window.partitionBy(*group).orderBy(F.desc(count), *[F.asc(t) for t in ties])
    best = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
    return best.withColumn(name, F.col(name).cast("long"))


def top_n_report(
    df: DataFrame,
    group: str,
    count: str,
    ties: Sequence[str],
    n: int,
    header: Column,
    entry: Column,
) -> DataFrame:
    """One text block per group with its ``n`` largest rows."""
    ranked = top_n(df, [group], count, ties, n)
    rows = F.sort_array(F.collect_list(F.struct("rank", entry.alias("e"))))
    grouped = ranked.groupBy(group).agg(rows.alias("_rows"))
    texts = F.transform("_rows", lambda r: r["e"])
    return grouped.select(group, report(header, texts).alias("report"))


def top_n_stream(
    counts: DataFrame, key: str, count: str, n: int, window: str = "w", salts: int = 64
) -> DataFrame:
    """Top-N per window on a stream: ``counts`` has ``window``, ``key`` and ``count``.

    Chained aggregations in append mode: the keys of a window are first ranked in
    ``salts`` parts, of which only the ``n`` best reach the final ranking.
    """

    def best(row):
        return F.slice(F.sort_array(F.collect_list(row)), 1, n)

    row = F.struct((-F.col(count)).alias("neg"), F.col(key).alias("k"))
    salt = F.pmod(F.xxhash64(key), F.lit(salts)).alias("_salt")
    parts = counts.groupBy(window, salt).agg(best(row).alias("_part"))
    rows = parts.select(window, F.explode("_part").alias("_row"))
    ranked = rows.groupBy(window).agg(best(F.col("_row")).alias("_best"))
    return ranked.select(
        F.col(f"{window}.end").alias("window_end"), F.posexplode("_best").alias("_pos", "_row")
    ).select(
        "window_end",
        F.col("_row.k").alias(key),
        (-F.col("_row.neg")).alias(count),
        (F.col("_pos") + 1).cast("long").alias("rank"),
    )


def over_range_count(
    df: DataFrame,
    keys: Sequence[str],
    rt: str,
    column: str,
    name: str,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """``count(column) over (partition by keys order by rt)`` with the default frame: rows
    of equal time see each other."""
    plan = o.layout(df, keys, [rt], rows_per_chunk)
    if not plan.chunked:
        window = Window.partitionBy(*keys).orderBy(rt)
        return df.withColumn(name, F.count(column).over(window))
    # Counting per time step first leaves one row per key and time; in those the
    # frame is by rows.
    steps = df.groupBy(*keys, rt).agg(F.count(column).alias("_n"))
    totals = o.running(steps, keys, [rt], {name: o.running_sum(F.col("_n"))}, plan=plan).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col(rt).alias("_k_rt"), name
    )
    match = F.col(rt).eqNullSafe(F.col("_k_rt"))
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(totals, match).select(*df.columns, name)


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    column: str,
    name: str,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """The value of ``column`` in the key's previous row."""
    return o.running(
        df, keys, [seq], {name: o.previous(F.col(column))}, rows_per_chunk=rows_per_chunk
    )
