"""Mixing sources to target weights by capped water-filling.

A source's size is its number of words. All targets together are ``share`` times all
sizes, dealt out by weight; a source stops at ``max_epochs`` times its size, and what it
leaves is dealt out again by weight until no source is above. That level is found at
once: with sources in the order of cap to weight, it is what remains for the uncapped
ones over their weight, at the first source that keeps below its cap.

A target of r times the source's size takes each document floor(r) times and a seeded
part of them once more: documents are dealt into ``SLOTS`` slots by a hash of seed and
id, and the first slots whose words come nearest to the fraction are taken. So a rerun
takes the same documents, and counting needs one row per source and slot.

Sources are ordered by code point, null last; null is a source of its own. Null and empty
texts have size 0. Rows of one id share a slot. Other columns stay as they are. An empty
table gives no rows; sources without words have target 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import WORD, text_of, working, written

SLOTS = 1 << 16
BROADCAST_BYTES = 16 << 20
SALTS = 64


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def slot(seed: str) -> Column:
    """Slot of a document: four hex digits of a keyed digest, the same in any engine."""
    keyed = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(keyed), 1, 4), 16, 10).cast("int")


def targets(
    sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: float
) -> DataFrame:
    """(source, source_size) with weight, cap and target: one row per source."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    n = F.row_number().over(by_name) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (n % len(weights) + 1).cast("int")
    )
    weighed = sizes.select(
        "source",
        "source_size",
        weight.alias("weight"),
        (F.col("source_size") * max_epochs).cast("double").alias("cap"),
    )
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything) * share
    left = budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(after)
    leveled = weighed.select(
        "*", F.when(level * F.col("weight") <= F.col("cap"), level).alias("level")
    )
    water = F.max("level").over(everything)  # later sources only show lower ones
    held = F.coalesce(water * F.col("weight"), F.col("cap"))
    return leveled.select(
        "source", "source_size", "weight", "cap", F.least("cap", held).alias("target")
    )


def plan(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """Per source: size, target, whole repetitions and the last slot taken once more."""
    slots = docs.groupBy("source", slot(seed).alias("slot")).agg(F.sum(word_count()).alias("words"))
    # The words of a slot, then of a source: the second sum reads at most SLOTS rows a source.
    aim = targets(
        slots.groupBy("source").agg(F.sum("words").alias("source_size")),
        weights,
        share,
        max_epochs,
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aim = aim.withColumn("whole", F.floor(rate).cast("int")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )
    keyed = aim.select(F.col("source").alias("_source"), "rest")
    so_far = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    reached = (
        slots.join(keyed, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("middle", F.coalesce(F.sum("words").over(so_far), F.lit(0)) + F.col("words") / 2)
        .where("middle <= rest and rest > 0")
        .groupBy(F.col("source").alias("_source"))
        .agg(F.max("slot").alias("last_slot"))
    )
    return aim.join(reached, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("last_slot", F.lit(-1)).alias("last_slot")
    )


def mix(
    docs: DataFrame, seed: str = "mix", broadcast_bytes: int = BROADCAST_BYTES, **settings
) -> DataFrame:
    """The rows with source_size, target and copies (how often the mix takes them).

    The plan has a row per source. Up to ``broadcast_bytes`` it goes to the documents, which
    then need no shuffle; a larger one is joined by source and salt, so that a source with
    a third of all documents is many tasks.
    """
    given, to, dealt, whole, last = working(docs, "source", "to", "salt", "whole", "last_slot")
    planned = written(plan(docs, seed=seed, **settings), "mixing-plan").select(
        F.col("source").alias(given),
        "source_size",
        "target",
        F.col("whole").alias(whole),
        F.col("last_slot").alias(last),
    )
    size = planned.agg(F.sum(F.lit(64) + F.coalesce(F.octet_length(given), F.lit(0)))).first()[0]
    names = [c for c in docs.columns if c not in ("source_size", "target", "copies")]
    on = F.col("source").eqNullSafe(F.col(given))
    rows = docs.select(*names)
    if (size or 0) <= broadcast_bytes:
        joined = rows.join(F.broadcast(planned), on, "left")
    else:
        salted = planned.withColumn(to, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
        joined = rows.withColumn(dealt, salt).join(
            salted, on & (F.col(dealt) == F.col(to)), "left"
        )
    copies = F.col(whole) + (slot(seed) <= F.col(last)).cast("int")
    return joined.select(*names, "source_size", "target", copies.alias("copies"))


def repeated(mixed: DataFrame) -> DataFrame:
    """Each row as often as the mix takes it, without the columns ``mix`` added."""
    names = [c for c in mixed.columns if c not in ("source_size", "target", "copies")]
    (copy,) = working(mixed, "copy")
    return mixed.where("copies > 0").select(
        *names, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(copy)
    ).drop(copy)
