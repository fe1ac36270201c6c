"""Exact dedup by an extendible-hash index on shared files, with DataFrame functions only.

Texts are equal when they are identical after each run of white space is replaced by one
space; null counts as empty. An index entry is one distinct text: equal bytes are found
by grouping on the bytes themselves, combined before the shuffle, so that a text with a
third of all rows is one row per task. The directory starts with one bucket and doubles
while a bucket holds more entries than it may; an overfull bucket splits by the next bit
of the hash, up to ``MAX_DEPTH`` bits, beyond which its entries are chained on. A bucket
is a range of hashes; the task that owns the range writes its part of the index, chaining
texts with equal hashes.

The row with the smallest id stays. Rows with equal id and text are one document and stay
or go together. Rows without an id go when any row with an id has their text; a text that
only they have keeps all of them. Other columns are left out. An empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import SPACE, text_of, written

MAX_DEPTH = 14
CAPACITY = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}+", " ")


def fingerprint(norm: Column) -> Column:
    return F.xxhash64(norm)


def prefix(h: Column, bits: int) -> Column:
    """The first bits of a hash, so that prefixes in order are ranges of hashes."""
    return F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("long")


def directory(counts: dict[int, int], capacity: int) -> tuple[int, list[int], list[int]]:
    """Global depth, the bucket each prefix of that depth points to, and local depths.

    ``counts`` has the entries per prefix of MAX_DEPTH bits, at most 2 ** MAX_DEPTH.
    """
    levels = [dict(counts)]
    for _ in range(MAX_DEPTH):
        above: dict[int, int] = {}
        for p, n in levels[0].items():
            above[p >> 1] = above.get(p >> 1, 0) + n
        levels.insert(0, above)
    buckets, depth = [(0, 0)], 0  # (prefix, local depth) in the order of the hashes
    while depth < MAX_DEPTH and any(levels[d].get(p, 0) > capacity for p, d in buckets):
        depth += 1
        split = []
        for p, d in buckets:
            full = levels[d].get(p, 0) > capacity
            split += [(2 * p, d + 1), (2 * p + 1, d + 1)] if full else [(p, d)]
        buckets = split
    pointers = [i for i, (_, d) in enumerate(buckets) for _ in range(1 << (depth - d))]
    return depth, pointers, [d for _, d in buckets]


def build_index(
    rows: DataFrame, capacity: int = CAPACITY, hashed=fingerprint, digest: Column | None = None
) -> DataFrame:
    """The index of (doc_id, norm): one entry per distinct text, in shared files.

    An entry has bucket, h, digest, chain (its place among the entries of its hash),
    twins (entries with its hash and digest), keep_id, group_size.
    """
    digest = F.sha2("norm", 256) if digest is None else digest
    entries = written(
        rows.groupBy(hashed(F.col("norm")).alias("h"), "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("h", digest.alias("digest"), "keep_id", "group_size"),
        "exact-entries",
    )
    counted = entries.groupBy(prefix(F.col("h"), MAX_DEPTH).alias("p")).count().collect()
    total = sum(r["count"] for r in counted)
    depth, pointers, _ = directory(
        {r["p"]: r["count"] for r in counted}, max(capacity, total >> (MAX_DEPTH - 1))
    )
    points_to = F.split(F.lit(",".join(map(str, pointers))), ",").cast("array<int>")
    bucket = F.element_at(points_to, (prefix(F.col("h"), depth) + 1).cast("int"))
    owned = entries.withColumn("bucket", bucket).repartitionByRange("bucket", "h")
    chain = Window.partitionBy("bucket", "h").orderBy("digest", "keep_id")
    twins = Window.partitionBy("bucket", "h", "digest")
    return written(
        owned.withColumn("chain", F.row_number().over(chain)).withColumn(
            "twins", F.count("*").over(twins)
        ),
        "exact-index",
    )


def dedup(
    docs: DataFrame,
    capacity: int = CAPACITY,
    hashed=fingerprint,
    digest: Column | None = None,
) -> DataFrame:
    """For each row: doc_id, keep_id, group_size, kept, text_sha256, bucket.

    Rows find their entry by hash and digest. Should two texts share both, their rows
    are looked up by the text itself.
    """
    rows = docs.select("doc_id", normalised(text_of()).alias("norm"))
    index = build_index(rows, capacity, hashed, digest)
    keys = ["h", "digest"]
    digest = F.sha2("norm", 256) if digest is None else digest
    looked = rows.select(
        "doc_id",
        "norm",
        hashed(F.col("norm")).alias("h"),
        digest.alias("digest"),
        F.sha2("norm", 256).alias("text_sha256"),
    )
    found = ["doc_id", "keep_id", "group_size", "bucket", "text_sha256"]
    single = index.where("twins = 1").drop("chain", "twins")
    out = looked.drop("norm").join(single, keys).select(*found)
    if not index.where("twins > 1").isEmpty():
        twins = index.where("twins > 1").select(*keys, "bucket").distinct()
        same = looked.join(twins, keys)
        groups = same.groupBy("h", "norm").agg(
            F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        )
        out = out.unionByName(same.join(groups, ["h", "norm"]).select(*found))
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        "bucket",
    )
