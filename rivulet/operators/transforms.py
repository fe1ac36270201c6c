"""Projection, filtering, row expansion, routing, union."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import tokens
from rivulet.operators.batches import map_frames


def explode_tokens(
    df: DataFrame, line: str = "value", separator: str = " ", name: str = "word"
) -> DataFrame:
    """One row per token of ``line``."""
    return df.select(F.explode(tokens(F.col(line), separator)).alias(name))


def filter_map(df: DataFrame, condition: Column, *columns: Column) -> DataFrame:
    """Keep matching rows and project them in one pass."""
    return df.where(condition).select(*columns)


def map_with_setup(
    df: DataFrame,
    setup: Callable[[], object],
    apply: Callable[[object, pd.DataFrame], pd.DataFrame],
    schema: str,
    teardown: Callable[[object], None] | None = None,
) -> DataFrame:
    """Map batches of rows with a resource opened once per task and closed at its end.

    Batches have pandas' nullable whole numbers, so that longs beside nulls stay exact.
    """

    def task(batches: Iterable[pd.DataFrame]):
        resource = setup()
        try:
            for batch in batches:
                yield apply(resource, batch)
        finally:
            if teardown is not None:
                teardown(resource)

    return map_frames(df, task, schema)


def tag(df: DataFrame, rules: Sequence[tuple[Column, Sequence[str]]], name: str = "tags"):
    """Label each row with the tags of the first rule whose condition holds."""
    tags = F.expr("cast(array() as array<string>)")
    for condition, labels in reversed(rules):
        tags = F.when(condition, F.array(*[F.lit(x) for x in labels])).otherwise(tags)
    return df.withColumn(name, tags)


def select_tag(df: DataFrame, label: str, name: str = "tags") -> DataFrame:
    """The rows that carry ``label``."""
    return df.where(F.array_contains(name, label))


def side_output(
    df: DataFrame, condition: Column, side: Column, name: str = "message"
) -> dict[str, DataFrame]:
    """Rows where ``condition`` holds go to ``side`` as one text column, the rest to ``main``.

    A null condition keeps the row in ``main``.
    """
    hit = F.coalesce(condition, F.lit(False))
    return {"main": df.where(~hit), "side": df.where(hit).select(side.alias(name))}


def union(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept."""
    return reduce(DataFrame.unionByName, others, first)


def connect(
    left: DataFrame,
    right: DataFrame,
    left_columns: Sequence[Column],
    right_columns: Sequence[Column],
) -> DataFrame:
    """Map two differently typed frames to one row type and put them together."""
    return left.select(*left_columns).unionByName(right.select(*right_columns))


def rebalance(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread rows evenly, whatever their keys: over the session's shuffle partitions."""
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(count)


def partition_by(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Bring rows of equal keys together. Only needed when something outside Spark SQL
    relies on it: grouping and windows partition by themselves, after combining."""
    columns = [F.col(k) for k in keys]
    return df.repartition(partitions, *columns) if partitions else df.repartition(*columns)


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Rows whose value is ``NOT IN`` the other frame's column, with SQL's null rule.

    A null in the list leaves no row, a null value is never "not in" a non-empty list, and
    an empty list keeps all. Written as an anti join on equality plus two facts about
    the list, so it shuffles on the key instead of needing a broadcast of the list.
    """
    values = other.select(F.col(other_column).alias("_value")).distinct()
    left = df.join(values, F.col(column) == F.col("_value"), "left_anti")
    size = other.select(F.count("*")).scalar()
    nulls = other.select(F.count(F.when(F.col(other_column).isNull(), 1))).scalar()
    return left.where((size == 0) | ((nulls == 0) & F.col(column).isNotNull()))
