"""Changelogs: an updated result as withdrawals and additions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators import ordered as o


def retract_counts(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    column: str,
    name: str = "cnt",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """``count(column)`` per key as a changelog in arrival order.

    Each row that changes the count withdraws the old value (``is_add`` false) and adds
    the new one; the first row of a key only adds.
    """
    counted = o.running(
        df,
        keys,
        [seq],
        {"_now": o.running_count(F.col(column)), "_row": o.running_count()},
        rows_per_chunk=rows_per_chunk,
    )
    before = F.col("_now") - F.col(column).isNotNull().cast("long")
    entries = F.array(
        F.struct(F.lit(False).alias("is_add"), before.alias(name)),
        F.struct(F.lit(True).alias("is_add"), F.col("_now").alias(name)),
    )
    changed = counted.where((F.col("_row") == 1) | F.col(column).isNotNull())
    exploded = changed.select(*keys, seq, "_row", F.explode(entries).alias("_e"))
    return exploded.where(F.col("_e.is_add") | (F.col("_row") > 1)).select(
        *keys, seq, F.col("_e.is_add").alias("is_add"), F.col(f"_e.{name}").alias(name)
    )


def replay_changelog(changes: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    """The table a changelog amounts to: additions less withdrawals."""
    sign = F.when(F.col("is_add"), F.lit(1)).otherwise(F.lit(-1))
    return (
        changes.groupBy(*keys, name)
        .agg(F.sum(sign).alias("_net"))
        .where(F.col("_net") > 0)
        .drop("_net")
    )
