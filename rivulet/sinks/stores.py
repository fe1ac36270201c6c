"""Sinks to stores: topics, keyed stores, document indexes, databases.

A client is made inside the task by the function given (``connect``), so nothing of it
crosses the network. Task retries and replayed micro-batches may write a row again: keyed
upserts and documents with an id end the same, plain appends may repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def to_console(df: DataFrame, label: str = "", rows: int = 20):
    """Print rows under a label: a batch frame at once, a stream per micro-batch."""
    if not df.isStreaming:
        print(label)
        df.show(rows, truncate=False)
        return None

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"{label} {batch_id}")
        batch.show(rows, truncate=False)

    return df.writeStream.foreachBatch(show)


def to_topic(df: DataFrame, servers: str, topic: str, value: str = "value"):
    """A writer that sends ``value`` as text to a topic. Needs Spark's Kafka connector."""
    text = df.select(F.col(value).cast("string").alias("value"))
    writer = text.writeStream if df.isStreaming else text.write
    return writer.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)


def last_per_key(df: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """One row per key: the value written last. Combined before the shuffle."""
    return df.groupBy(key).agg(F.max_by(value, seq).alias(value), F.max(seq).alias(seq))


def upsert_keyed(
    df: DataFrame,
    key: str,
    value: str,
    seq: str,
    connect: Callable[[], Callable[[str, str], None]],
) -> None:
    """Put the last value of every key into a keyed store.

    ``connect()`` gives a function ``put(key, value)`` and is called once per task.
    """

    def write(rows: Iterable[Row]) -> None:
        put = connect()
        for row in rows:
            put(str(row[0]), str(row[1]))

    last_per_key(df, key, value, seq).select(key, value).foreachPartition(write)


def documents(df: DataFrame) -> DataFrame:
    """Each row as a JSON document."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("document"))


def index_documents(
    df: DataFrame,
    connect: Callable[[], Callable[[list[str]], None]],
    max_actions: int = 1,
) -> None:
    """Send each row as a JSON document; ``connect()`` gives ``bulk(documents)``, called
    with at most ``max_actions`` documents at a time."""
    def write(rows: Iterable[Row]) -> None:
        bulk, held = connect(), []
        for row in rows:
            held.append(row[0])
            if len(held) >= max_actions:
                bulk(held)
                held = []
        if held:
            bulk(held)

    documents(df).foreachPartition(write)


def append_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    """Insert rows into a database table, in batches over one connection per task."""
    df.write.jdbc(url, table, mode="append", properties=properties)


def jdbc_sink(url: str, table: str, **properties: str) -> Callable[[DataFrame, int], None]:
    """The same for the micro-batches of a stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_jdbc(batch, url, table, **properties)

    return write


def keyed_sink(
    key: str, value: str, seq: str, connect: Callable[[], Callable[[str, str], None]]
) -> Callable[[DataFrame, int], None]:
    """Keyed upserts for the micro-batches of a stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_keyed(batch, key, value, seq, connect)

    return write
