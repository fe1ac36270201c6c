"""The registered queries and, where SQL can state them, their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` together with SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table; ``event_id`` is the arrival order, ``ts`` the event time."""
    return table(spark, sf_dir, "events")


def with_k(df: DataFrame) -> DataFrame:
    """Add ``k``, the number inside the JSON properties."""
    return df.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ``create`` and their shipped lines as ``pay`` events, in one schema."""
    creates = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.lit("create").alias("event_type"),
        F.col("o_orderdate").alias("rt"),
        (F.col("o_orderkey") * 100).alias("seq"),
    )
    pays = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.lit("pay").alias("event_type"),
        F.col("l_shipdate").alias("rt"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("seq"),
    )
    return creates.unionByName(pays)
