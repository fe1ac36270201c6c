"""Stream sources: sockets, message topics, tables and generators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines read from a socket."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def topic_options(servers: str, topic: str, group: str, starting: str = "latest") -> dict[str, str]:
    """Reader options of a message topic."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": starting,
    }


def topic_lines(spark: SparkSession, servers: str, topic: str, group: str) -> DataFrame:
    """A topic's values as text. Needs Spark's Kafka connector on the class path."""
    options = topic_options(servers, topic, group)
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


BYTES_PER_TRIGGER = 8 << 30


def table_stream(
    spark: SparkSession, path: str, schema, files_per_trigger: int | None = None
) -> DataFrame:
    """A parquet table, a folder or one file, as a stream of its files.

    A micro-batch takes ``files_per_trigger`` files, or else about ``BYTES_PER_TRIGGER``, so that a
    backlog is many bounded batches; a single larger file is one.
    """
    # Spark takes a plain path for a folder; a pattern that matches only it may be a file.
    path = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", str(BYTES_PER_TRIGGER))
    return reader.parquet(path)


def _draw(number: Column, salt: str, options: int) -> Column:
    """A repeatable draw from ``0 .. options - 1`` for each row number."""
    return F.pmod(F.xxhash64(number, F.lit(salt)), F.lit(options))


def _pick(number: Column, salt: str, names: list[str]) -> Column:
    choices = F.array(*[F.lit(n) for n in names])
    return F.element_at(choices, (_draw(number, salt, len(names)) + 1).cast("int"))


def numbers(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """An endless stream of ``(timestamp, value)``."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def sensor_rows(rows: DataFrame, number: str = "value", time: str = "timestamp") -> DataFrame:
    """Sensor readings made from numbered rows (:func:`numbers`, or any numbered batch)."""
    n = F.col(number)
    # Sensor names and the range of readings.
    sensors, low, high = ["sensor_0", "sensor_1", "sensor_2"], 40, 48
    return rows.select(
        _pick(n, "sensor", sensors).alias("id"),
        F.unix_millis(F.col(time).cast("timestamp")).alias("ts"),
        (_draw(n, "level", high - low + 1) + low).cast("int").alias("vc"),
    )


def marketing_rows(rows: DataFrame, number: str = "value", time: str = "timestamp") -> DataFrame:
    """App marketing events made from numbered rows."""
    n = F.col(number)
    # Behaviours and channels.
    behaviors = ["DOWNLOAD", "INSTALL", "UPDATE", "UNINSTALL"]
    channels = ["XIAOMI", "HUAWEI", "OPPO", "VIVO"]
    return rows.select(
        F.abs(F.xxhash64(n, F.lit("user"))).alias("user_id"),
        _pick(n, "behavior", behaviors).alias("behavior"),
        _pick(n, "channel", channels).alias("channel"),
        F.unix_millis(F.col(time).cast("timestamp")).alias("ts"),
    )
