"""Delimited file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_delimited(df: DataFrame, path: str, separator: str = ",", mode: str = "errorifexists"):
    """Write rows as delimited text. Columns go by position."""
    df.write.mode(mode).option("sep", separator).option("emptyValue", "").csv(path)


def insert_into(df: DataFrame, table: str) -> None:
    """Append rows to a table by column position, whatever their names."""
    df.write.insertInto(table)
