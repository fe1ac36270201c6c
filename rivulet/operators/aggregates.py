"""Aggregation without time windows: grouped, running, distinct and custom."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pandas.core.groupby import DataFrameGroupBy as GroupBy
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.text import bitmap_offset
from rivulet.operators import ordered as o
from rivulet.operators.batches import map_frames


def group_sum(df: DataFrame, keys: Sequence[str], value: Column, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def running_agg(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    values: dict[str, o.Running],
    carry_first: Sequence[str] = (),
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """One output row per input row with the values so far, in arrival order.

    ``carry_first`` columns keep the value of the key's first row, as a rolling
    aggregate that updates one field of its accumulated row does.
    """
    extra = {f"_first_{c}": o.first_value(F.col(c)) for c in carry_first}
    out = o.running(df, keys, [seq], {**values, **extra}, rows_per_chunk=rows_per_chunk)
    for c in carry_first:
        out = out.withColumn(c, F.col(f"_first_{c}"))
    return out.drop(*extra)


def running_distinct(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    seq: str,
    name: str = "distinct_count",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Per row, how many different ``value``s its key has shown so far (``seq`` unique).

    The first position of each (key, value) comes from a map-side combined ``min``; its
    markers are put among the rows and counted, so no row waits for a set to fill.
    """
    plan = o.layout(df, keys, [seq], rows_per_chunk)
    marks = df.groupBy(*keys, value).agg(F.min(seq).alias(seq))
    marks = marks.where(F.col(value).isNotNull()).withColumn("_mark", F.lit(0))
    rows = df.withColumn("_mark", F.lit(1))
    both = rows.unionByName(marks, allowMissingColumns=True)
    counted = o.running(
        both,
        keys,
        [seq, "_mark"],
        {name: o.running_count(F.when(F.col("_mark") == 0, 1))},
        plan=plan,
    )
    return counted.where(F.col("_mark") == 1).drop("_mark")


def approx_distinct(
    df: DataFrame, groups: Sequence, value: Column, error: float = 0.01, name: str = "uv"
) -> DataFrame:
    """Approximate distinct count per group from a mergeable sketch of fixed size."""
    return df.groupBy(*groups).agg(F.approx_count_distinct(value, error).alias(name))


def bloom_distinct(
    df: DataFrame,
    groups: Sequence,
    value: Column,
    seq: str,
    bits: int = 1 << 20,
    hashes: int = 3,
    name: str = "uv",
) -> DataFrame:
    """Distinct count per group by a Bloom filter: a value counts when, on its first arrival,
    one of its ``hashes`` bits was not set yet.

    Such a value is the first, by ``seq``, to set one of its bits. So the filter is a table of
    its set bits with the value that set each, combined before the shuffle, at most ``bits``
    rows a group; no task goes through a group's rows in order. A value whose bits others
    had set is missed; none is counted twice.
    """
    first = df.groupBy(*groups, value.alias("_value")).agg(F.min(seq).alias("_first"))
    first = first.where(F.col("_value").isNotNull())
    names = [c for c in first.columns if c not in ("_value", "_first")]
    text = F.col("_value").cast("string")
    places = [
        F.conv(F.substring(F.md5(F.concat(F.lit(f"{i}:"), text)), 1, 12), 16, 10).cast("long") % bits
        for i in range(hashes)
    ]
    setting = first.select(*names, "_value", "_first", F.explode(F.array_distinct(F.array(*places))).alias("_bit"))
    setter = F.min_by("_value", F.struct("_first", "_value")).alias("_value")
    bit = setting.groupBy(*names, "_bit").agg(setter)
    return bit.groupBy(*names).agg(F.countDistinct("_value").alias(name))


def bitmap_distinct(df: DataFrame, groups: Sequence, value: Column, name: str = "uv") -> DataFrame:
    """Distinct count of one-hash bitmap positions per group.

    Two values with the same position count once, as in a bitmap of 2^30 bits. Equal
    values are folded first, so each is hashed once.
    """
    once = df.groupBy(*groups, value.alias("_value")).agg(F.lit(1).alias("_one")).drop("_one")
    names = [c for c in once.columns if c != "_value"]
    return once.groupBy(*names).agg(F.countDistinct(bitmap_offset(F.col("_value"))).alias(name))


def accumulate(
    df: DataFrame,
    keys: Sequence[str],
    add: Callable[[GroupBy], pd.DataFrame],
    merge: Callable[[GroupBy], pd.DataFrame],
    state: str,
    result: dict[str, Column],
) -> DataFrame:
    """A custom accumulator: ``add`` rows into states, ``merge`` states, read ``result``.

    ``state`` is the accumulator's schema. ``add`` gets a batch of rows grouped by key
    and ``merge`` a batch of states grouped by key; both return one state row per key
    (``groups.agg(n=("x", "size"))``), so pandas works on all keys at once. Rows are folded
    where they are read: a hot key reaches the shuffle as a few states per task. Batches
    have pandas' nullable whole numbers, so that long keys and values stay exact.
    """
    keys = list(keys)
    schema = T.StructType([*df.select(*keys).schema.fields, *T.StructType.fromDDL(state).fields])

    def fold(step: Callable, rows: pd.DataFrame) -> pd.DataFrame:
        # Keys keep their order of appearance.
        return step(rows.groupby(keys, dropna=False, sort=False)).reset_index()[schema.names]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if batch.empty:
                continue
            fresh = fold(add, batch)
            held = fresh if held is None else fold(merge, pd.concat([held, fresh]))
            if len(held) > 100_000:
                # Many keys: hand the states on, the last step takes several per key.
                yield held
                held = None
        if held is not None:
            yield held

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # States come sorted by key, so only the last key of a batch may go on.
        held = None
        for batch in batches:
            if batch.empty:
                continue
            merged = fold(merge, batch if held is None else pd.concat([held, batch]))
            yield merged.iloc[:-1]
            held = merged.iloc[-1:]
        if held is not None:
            yield held

    states = map_frames(df, partial, schema)
    sorted_states = states.repartition(*keys).sortWithinPartitions(*keys)
    merged = map_frames(sorted_states, final, schema)
    return merged.select(*keys, *[c.alias(n) for n, c in result.items()])
