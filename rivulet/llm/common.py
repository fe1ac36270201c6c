"""What the training-data operators share: words, hashes, shared files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import configure, run_folder

# White space everywhere in this subpackage: space, tab, line feed, vertical tab, form
# feed, carriage return.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of text that a Python task works on at once.
BLOCK = 1 << 20


def session(spark: SparkSession) -> SparkSession:
    """The session with batches small enough that long texts stay within memory."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: its lineage ends there."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def working(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns, which no column of the frame has."""
    taken, mark = {c.lower() for c in df.columns}, "_"
    while any(f"{mark}{n}" in taken for n in names):
        mark += "_"
    return [f"{mark}{n}" for n in names]


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """Whether a document is kept back from learning: crc32(id as text) mod 5 is 0.

    A null id counts as kept back.
    """
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(True))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column without nulls and each text's offsets in them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    if data is None or first == last:
        return np.zeros(0, np.uint8), offsets - first
    return np.frombuffer(data, np.uint8)[first:last], offsets - first


def blocks(
    batches: Iterator[pa.RecordBatch], column: str, size: int = 4 * BLOCK
) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``size`` bytes of text each.

    A longer text is a run of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    space = np.zeros(256, bool)
    space[list(SPACE_BYTES)] = True
    letters = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    letters[65:91] = letters[97:123]  # A-Z count as a-z
    powers = np.full(1 << 16, 0x9E3779B97F4A7C15, np.uint64)
    powers[0] = 1
    return space, letters, np.cumprod(powers, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: each bit of the result depends on all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _hash_piece(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words in a piece; ``breaks``: where texts begin."""
    space, letters, powers = _tables()
    inside = ~space[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[breaks] = inside[breaks]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    word = np.cumsum(begins, dtype=np.int32) - 1
    word[: starts[0]] = 0
    place = np.arange(len(data), dtype=np.int64) - starts[word]
    value = letters[data]
    value *= powers[np.clip(place, 0, len(powers) - 1)]
    value[~inside] = 0
    hashes = np.add.reduceat(value, starts)
    size = np.add.reduceat(inside.astype(np.int64), starts)
    for i in np.flatnonzero(size >= len(powers)):
        raw = data[starts[i] : starts[i] + size[i]].tobytes().lower()
        hashes[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "big")
    return mix(hashes + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (A-Z lower-cased), and where each text's words end.

    Texts lie one after another in ``data``. The second result has one entry more than
    there are texts: text i has the words from entry i to entry i + 1. Works in pieces
    cut at white space, so that a long text needs little more than its words' hashes.
    """
    space = _tables()[0]
    hashes, starts, at, n = [], [], 0, len(data)
    while at < n:
        end = min(at + BLOCK, n)
        while end < n and not space[data[end]]:  # a word stays in one piece
            ahead = np.flatnonzero(space[data[end : end + BLOCK]])
            end = end + int(ahead[0]) if len(ahead) else min(end + BLOCK, n)
        lo, hi = np.searchsorted(offsets, [at, end])
        breaks = np.unique(offsets[lo:hi] - at)
        h, s = _hash_piece(data[at:end], breaks[breaks < end - at])
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)
