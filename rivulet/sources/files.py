"""File sources: text lines, delimited tables, typed lines, access logs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.text import tokens


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in column ``value``."""
    return spark.read.text(path)


def text_line_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The lines of a directory's files as a stream, a few files per micro-batch."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def read_format(spark: SparkSession, fmt: str, path: str, schema: str | None = None, **options):
    """Any format Spark knows (parquet, orc, json, ...)."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def from_elements(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    """A small in-memory collection as a frame."""
    return spark.createDataFrame(list(rows), schema)


def delimited_table(
    spark: SparkSession,
    path: str,
    schema: str,
    separator: str = ",",
    name: str | None = None,
) -> DataFrame:
    """A delimited file as a table, registered as a view under ``name`` if given.

    A line that does not fit the schema fails the query. Empty text fields are empty
    strings, not nulls.
    """
    df = spark.read.schema(schema).option("sep", separator).option("mode", "FAILFAST").csv(path)
    df = _empty_text(df)
    if name:
        df.createOrReplaceTempView(name)
    return df


def delimited_stream(
    spark: SparkSession, path: str, schema: str, separator: str = ",", files_per_trigger: int = 1
) -> DataFrame:
    """A directory of delimited files as a stream."""
    reader = spark.readStream.schema(schema).option("sep", separator).option("mode", "FAILFAST")
    return _empty_text(reader.option("maxFilesPerTrigger", files_per_trigger).csv(path))


def with_quarantine(
    spark: SparkSession, path: str, schema: str, separator: str = ","
) -> dict[str, DataFrame]:
    """Rows that fit the schema, and the lines that do not as ``bad``."""
    options = {"sep": separator, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = text_lines(spark, path).select(
        F.from_csv("value", f"{schema}, _bad string", options).alias("row")
    )
    rows = parsed.where("row._bad is null").select("row.*").drop("_bad")
    bad = parsed.where("row._bad is not null").select(F.col("row._bad").alias("value"))
    return {"rows": _empty_text(rows), "bad": bad}


def _empty_text(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.coalesce(F.col(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def parse_delimited(lines: DataFrame, schema: str, separator: str = ",") -> DataFrame:
    """Split each line and cast its parts; a part that does not parse fails the query.

    Works on batch and streaming lines.
    """
    fields = T.StructType.fromDDL(schema).fields
    parts = F.split("value", f"\\Q{separator}\\E")
    columns = [
        parts.getItem(i).cast(f.dataType).alias(f.name) for i, f in enumerate(fields)
    ]
    return lines.select(*columns)


def parse_access_log(lines: DataFrame, user_token: int = 1) -> DataFrame:
    """Space-separated access-log lines: ip, user, time, method and url of each.

    The time is read as ``dd/MM/yyyy:HH:mm:ss`` with seconds as seconds.
    """
    # Token positions of ip, time, method, url.
    ip, when, method, url = 0, 3, 5, 6
    part = tokens(F.col("value"))
    return lines.select(
        part.getItem(ip).alias("ip"),
        part.getItem(user_token).alias("user_id"),
        F.to_timestamp(part.getItem(when), "dd/MM/yyyy:HH:mm:ss").alias("event_time"),
        part.getItem(method).alias("method"),
        part.getItem(url).alias("url"),
    )
