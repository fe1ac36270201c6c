"""Batches of rows as pandas frames in which whole numbers stay whole beside nulls.

Spark's own pandas batches turn a column of longs that has a null into floating-point
numbers, which changes values above 2^53 and merges keys. Here such columns have pandas'
nullable types.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

NULLABLE = {
    pa.int8(): pd.Int8Dtype(),
    pa.int16(): pd.Int16Dtype(),
    pa.int32(): pd.Int32Dtype(),
    pa.int64(): pd.Int64Dtype(),
    pa.bool_(): pd.BooleanDtype(),
}


def frame(batch: pa.RecordBatch) -> pd.DataFrame:
    """The batch with nullable whole numbers, and timestamps in UTC without zone."""
    out = batch.to_pandas(types_mapper=NULLABLE.get)
    for field in batch.schema:
        if pa.types.is_timestamp(field.type) and field.type.tz:
            out[field.name] = out[field.name].dt.tz_convert("UTC").dt.tz_localize(None)
    return out


def rows(out: pd.DataFrame, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_pandas(out[schema.names], schema, preserve_index=False)
    yield from table.combine_chunks().to_batches()


def map_frames(
    df: DataFrame,
    task: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: str | T.StructType,
) -> DataFrame:
    """``mapInPandas`` with nullable whole numbers."""
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for result in task(map(frame, batches)):
            yield from rows(result, arrow)

    return df.mapInArrow(run, out)


def changes(rows: pd.DataFrame, group: Sequence[str]) -> np.ndarray:
    """Whether each row's group differs from that of the row before; nulls equal nulls."""
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for g in group:
        codes = pd.factorize(rows[g], use_na_sentinel=False)[0]
        new[1:] |= codes[1:] != codes[:-1]
    return new


def whole_groups(batches: Iterator[pd.DataFrame], group: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Rows sorted by ``group`` as frames that each hold whole groups."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        before = [held[-1].iloc[-1:]] if held else []
        new = changes(pd.concat([*before, batch], ignore_index=True), group)[len(before) :]
        cuts = np.flatnonzero(new if held else np.append(False, new[1:]))
        if len(cuts):
            yield pd.concat([*held, batch.iloc[: cuts[-1]]], ignore_index=True)
            held = [batch.iloc[cuts[-1] :]]
        else:
            held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def map_group_frames(
    df: DataFrame,
    keys: list[str],
    fn: Callable[[tuple, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: str | T.StructType,
) -> DataFrame:
    """The iterator form of ``applyInPandas`` with nullable whole numbers."""
    out = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(out)

    def run(
        key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]
    ) -> Iterator[pa.RecordBatch]:
        values = (k.as_py() for k in key)
        plain = tuple(v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v for v in values)
        for result in fn(plain, map(frame, batches)):
            yield from rows(result, arrow)

    # Spark reads the form from the annotations, which must be types here, not text.
    run.__annotations__ = {
        "key": tuple[pa.Scalar, ...],
        "batches": Iterator[pa.RecordBatch],
        "return": Iterator[pa.RecordBatch],
    }
    return df.groupBy(*keys).applyInArrow(run, out)
