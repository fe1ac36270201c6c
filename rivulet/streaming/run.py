"""Starting streams and reading what they gave."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators.joins import enrich_latest
from rivulet.session import run_folder, stream_options


def start(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    interval: str | None = None,
):
    """Start a stream whose micro-batches go to ``sink(batch, batch_id)``."""
    options = stream_options(checkpoint, interval)
    return (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", options["checkpointLocation"])
        .trigger(**options["trigger"])
        .foreachBatch(sink)
        .start()
    )


def parquet_log(folder: str) -> Callable[[DataFrame, int], None]:
    """A sink that keeps each micro-batch under its number; a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return write


def collect_stream(
    spark: SparkSession, df: DataFrame, name: str, output_mode: str = "append"
) -> DataFrame:
    """Run a stream over the data available now; gives its output with a ``batch`` column."""
    folder = run_folder(spark, name)
    # So that there is something to read when no micro-batch ran.
    spark.createDataFrame([], df.schema).write.parquet(f"{folder}/out/batch=-1")
    query = start(df, parquet_log(f"{folder}/out"), f"{folder}/checkpoint", output_mode)
    query.awaitTermination()
    schema = T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).option("basePath", f"{folder}/out").parquet(f"{folder}/out")


def latest(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last version of each key in the log of a stream in update mode."""
    values = [c for c in log.columns if c not in (*keys, "batch")]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_last"))
    return newest.select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])


def fan_out(
    routes: dict[str, Callable[[DataFrame, int], None]], column: str = "route"
) -> Callable[[DataFrame, int], None]:
    """A sink that sends each micro-batch's rows to the writer of their route."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, sink in routes.items():
                sink(batch.where(F.col(column) == name).drop(column), batch_id)
        finally:
            batch.unpersist()

    return write


def with_latest_control(
    read_control: Callable[[], DataFrame],
    seq: str,
    column: str,
    name: str,
    sink: Callable[[DataFrame, int], None],
) -> Callable[[DataFrame, int], None]:
    """A sink that adds the newest value of a control table, read anew per micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = read_control().agg(F.max_by(F.col(column), F.col(seq)).alias(name))
        value = newest.first()[name]
        kind = newest.schema[name].dataType
        sink(batch.withColumn(name, F.lit(value).cast(kind)), batch_id)

    return write


def with_control_by_arrival(
    folder: str,
    seq: str,
    is_control: Column,
    value: Column,
    name: str,
    sink: Callable[[DataFrame, int], None],
    spark: SparkSession,
) -> Callable[[DataFrame, int], None]:
    """A sink for one stream of control and other rows, in arrival order ``seq``: adds to
    every other row the control value last seen before it, null before the first.

    Inside a micro-batch that is :func:`enrich_latest`. Its last control value is kept in
    ``folder`` under its number, one row at most, for the batches after it; a repeated
    batch replaces its own and reads earlier ones only.
    """
    path = f"{folder}/last-control"
    started = []

    def last_before(batch_id: int, schema) -> DataFrame:
        kept = spark.read.schema(schema).option("basePath", path).parquet(path)
        return kept.where(F.col("batch") < batch_id).orderBy(F.desc("batch")).limit(1)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            control = batch.where(is_control).select(
                F.col(seq), F.struct(value.alias("v")).alias("_value")
            )
            last = control.agg(F.max_by("_value", seq).alias("_last")).where("_last is not null")
            schema = T.StructType([*last.schema.fields, T.StructField("batch", T.LongType())])
            if not started:
                # So that there is something to read before the first control row.
                spark.createDataFrame([], last.schema).write.mode("overwrite").parquet(f"{path}/batch=-1")
                started.append(True)
            earlier = last_before(batch_id, schema).first()
            kind = last.schema["_last"].dataType["v"].dataType
            carried = F.lit(earlier["_last"]["v"] if earlier else None).cast(kind)
            main = batch.where(~F.coalesce(is_control, F.lit(False)))
            found = enrich_latest(main, control, seq, F.col("_value"), "_found")
            sink(
                found.withColumn(
                    name, F.when(F.col("_found").isNull(), carried).otherwise(F.col("_found.v"))
                ).drop("_found"),
                batch_id,
            )
            last.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write
