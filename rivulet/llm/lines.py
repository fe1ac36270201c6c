"""Line dedup: lines that many documents hold stay in the first of them only.

Lines are split at line feeds. A line's key is the line without white space at its ends
and with A-Z lower-cased; two 64-bit hashes stand for it. Keys of at least ``min_chars``
code points in at least ``threshold`` documents lose their lines in all but the document
with the smallest id; within that one, repeated lines stay. Positions, not lines, are
shuffled back to the documents.

A null text is one empty line. A row without id neither counts nor loses lines. Rows of
one id are one document when counting; each is cut for itself. Other columns, whatever
their names, stay as they are. An empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import SPACE_BYTES, text_of, working, written


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; the quick way where all is ASCII."""
    ascii_only = F.octet_length(text) == F.length(text)
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(ascii_only, F.lower(text)).otherwise(slow)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACE_BYTES.decode())))


def dropped_lines(docs: DataFrame, threshold: int = 2, min_chars: int = 10) -> DataFrame:
    """Per document (doc_id, body: a hash of its text) the sorted positions that go."""
    lines = docs.where("doc_id is not null").select(
        "doc_id",
        F.xxhash64(text_of()).alias("body"),
        F.posexplode(F.split(text_of(), "\n", -1)).alias("pos", "line"),
    )
    keyed = lines.select("doc_id", "body", "pos", line_key(F.col("line")).alias("key"))
    hashed = keyed.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("other"), "key").alias("h2"),
        "doc_id",
        "body",
        "pos",
    )
    if threshold == 2:
        many = F.min("doc_id") < F.max("doc_id")
    else:
        many = F.count_distinct("doc_id") >= threshold
    # Written, so that the join sees two plain shuffles and can split a common line.
    common = written(
        hashed.groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("first_id"), many.alias("many"))
        .where("many")
        .drop("many"),
        "lines-common",
    )
    return (
        hashed.join(common, ["h1", "h2"])
        .where("doc_id <> first_id")
        .groupBy("doc_id", "body")
        .agg(F.sort_array(F.collect_set("pos")).alias("drops"))
    )


def _without(lines: Column, drops: Column) -> Column:
    """The lines between dropped positions, run by run."""
    cuts = F.concat(F.array(F.lit(-1)), drops, F.array(F.size(lines)))
    run = lambda c, i: F.slice(
        lines, F.get(c, i - 1) + 2, F.get(c, i) - F.get(c, i - 1) - 1
    )
    runs = F.transform(
        F.array(cuts),
        lambda c: F.flatten(F.transform(F.sequence(F.lit(1), F.size(c) - 1), lambda i: run(c, i))),
    )
    return F.get(runs, 0)


def line_dedup(docs: DataFrame, threshold: int = 2, min_chars: int = 10) -> DataFrame:
    """The rows with ``text`` cut, and n_lines (before), n_dropped added."""
    drop_id, body, gone, lines = working(docs, "doc_id", "body", "drops", "lines")
    drops = dropped_lines(docs, threshold, min_chars).select(
        F.col("doc_id").alias(drop_id), F.col("body").alias(body), F.col("drops").alias(gone)
    )
    on = [F.col("doc_id") == F.col(drop_id), F.xxhash64(text_of()) == F.col(body)]
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    joined = docs.select(*names).join(drops, on, "left").drop(drop_id, body)
    split = joined.withColumn(lines, F.split(text_of(), "\n", -1))
    kept = F.get(
        F.transform(F.array(lines), lambda ls: F.array_join(_without(ls, F.col(gone)), "\n")), 0
    )
    return split.select(
        *[
            F.when(F.col(gone).isNull(), text_of()).otherwise(kept).alias("text")
            if c == "text"
            else F.col(c)
            for c in names
        ],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
    )
