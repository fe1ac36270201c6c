"""Event patterns: sequences of conditions over the rows of a key in event-time order.

There is no automaton. Whether a row continues a match depends only on the next row
(``next``) or the next row that meets the following condition (``followed_by``), both
running values looked at backwards. ``followed_by_any`` pairs with every later row,
which is a join bounded by ``within``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.time import interval
from rivulet.operators import ordered as o
from rivulet.operators.joins import interval_join

NEXT, FOLLOWED_BY, FOLLOWED_BY_ANY = "next", "followed_by", "followed_by_any"


@dataclass(frozen=True)
class Stage:
    """A named step: rows meeting ``condition``, related to the step before by
    ``contiguity``, repeated ``times`` (least, most), other rows allowed in between."""

    name: str
    condition: Column
    contiguity: str = FOLLOWED_BY
    times: tuple[int, int] = (1, 1)


def match_pattern(
    df: DataFrame,
    key: Sequence[str],
    time: str,
    seq: str,
    stages: Sequence[Stage],
    within: str | None = None,
    rows_per_chunk: int | None = None,
) -> dict[str, DataFrame]:
    """All matches and, with ``within``, the partial matches that timed out.

    Every row that meets the first condition starts its own match. ``matches`` has one
    column per stage: the row as a struct, or an array of rows for a stage with
    ``times``. All rows of a match lie strictly less than ``within`` apart. ``timeouts`` has
    the stages found in time and ``timeout_ts``, the start plus ``within``. Without
    ``followed_by_any`` there is ``waiting``: the starts (``_first``) neither matched nor broken. An empty ``key``
    takes the whole table as one sequence, still split over tasks. Rows with a null key
    belong to no sequence.
    """
    for k in key:
        df = df.where(F.col(k).isNotNull())
    if within is None and not key and any(s.contiguity == FOLLOWED_BY_ANY for s in stages):
        raise ValueError("followed_by_any over a whole table needs within")
    segments: list[list[Stage]] = []
    for i, stage in enumerate(stages):
        if i == 0 or stage.contiguity == FOLLOWED_BY_ANY:
            segments.append([stage])
        else:
            segments[-1].append(stage)
    for segment in segments:
        if any(s.times != (1, 1) for s in segment[1:-1]):
            raise ValueError("times is supported on the first and the last stage of a chain")
    plan = o.layout(df, key, [time, seq], rows_per_chunk)
    chains = [_chain(df, key, time, seq, segment, within, plan) for segment in segments]
    if len(chains) == 1:
        return {
            "matches": chains[0]["matches"].drop("_first", "_last"),
            "timeouts": chains[0]["timeouts"],
            "waiting": chains[0]["waiting"],
        }
    matches = chains[0]["matches"]
    partial = chains[0]["matches"]
    timeouts = chains[0]["timeouts"]
    for chain in chains[1:]:
        # Every partial match goes on waiting for further partners, so each times out.
        if within is not None:
            timeouts = timeouts.unionByName(
                partial.select(
                    *[c for c in partial.columns if c not in ("_first", "_last")],
                    (F.col(f"_first.{time}") + interval(within)).alias("timeout_ts"),
                ),
                allowMissingColumns=True,
            )
        matches = partial = _pairs(matches, chain["matches"], key, time, seq, within)
    return {"matches": matches.drop("_first", "_last"), "timeouts": timeouts}


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in df.columns])


def _chain(df, key, time, seq, stages, within, plan) -> dict[str, DataFrame]:
    """Matches of stages that each have one possible successor."""
    order = [time, seq]
    rows = df.withColumn("_row", _row(df))
    if all(s.contiguity != NEXT for s in stages[1:]):
        # Rows that meet no condition cannot matter, so they need not be shuffled.
        rows = rows.where(reduce(or_, [s.condition for s in stages]))
    for i, stage in enumerate(stages):
        met = F.coalesce(stage.condition, F.lit(False))
        rows = rows.withColumn(f"_met{i}", met)

    # A stage with repetition sees the matching rows that follow.
    last = len(stages) - 1
    for i in {0, last}:
        least, most = stages[i].times
        if (least, most) == (1, 1):
            continue
        hits = rows.where(f"_met{i}")
        hits = o.following(hits, key, order, F.col("_row"), most, f"_group{i}", plan=plan)
        if i == 0 and last == 0:
            rows = hits
        else:
            others = rows.where(f"not _met{i}")
            rows = others.unionByName(hits, allowMissingColumns=True)

    # From the last stage backwards: what a row of stage i is followed by. All passes share one
    # partitioning and order.
    for i in range(last, 0, -1):
        found = [F.col("_row").alias("row"), F.col(f"_met{i}").alias("met")]
        if i < last:
            found.append(F.col(f"_after{i + 1}").alias("after"))
        if i == last and stages[i].times != (1, 1):
            found.append(F.col(f"_group{i}").alias("group"))
        item = F.struct(*found)
        if stages[i].contiguity == NEXT:
            step = o.previous(item)
        else:
            step = o.last_seen(F.when(F.col(f"_met{i}"), item), before=True)
        rows = o.running(rows, key, order, {f"_after{i}": step}, reverse=True, plan=plan)

    starts = rows.where("_met0")
    if stages[0].times != (1, 1):
        starts = _first_groups(starts, rows, key, stages, seq, last)

    start_time = F.col(f"_first.{time}")

    def in_time(row: Column) -> Column:
        if within is None:
            return row.isNotNull()
        return row.isNotNull() & (row[time] < start_time + interval(within))

    # Walk the chain: each stage's row, if all before it were found in time.
    if stages[0].times == (1, 1):
        starts = starts.withColumn("_first", F.col("_row")).withColumn("_s0", F.col("_row"))
    step = F.col("_after1") if last > 0 else None
    good = F.lit(True)
    if stages[0].times != (1, 1):
        good = in_time(F.element_at("_s0", -1))
    strict_break = F.lit(False)
    ok_columns, stage_columns = [good.alias("_ok0")], [F.col("_s0").alias(stages[0].name)]
    last_row = F.element_at("_s0", -1) if stages[0].times != (1, 1) else F.col("_s0")
    for i in range(1, last + 1):
        row = step["row"]
        reached = in_time(row)
        hit = reached & step["met"]
        strict_break = strict_break | (good & reached & ~step["met"])
        good = good & F.coalesce(hit, F.lit(False))
        ok_columns.append(good.alias(f"_ok{i}"))
        value = step["group"] if i == last and stages[i].times != (1, 1) else row
        stage_columns.append(F.when(good, value).alias(stages[i].name))
        last_row = row
        if i < last:
            step = step["after"]
    walked = starts.select(
        *key,
        *stage_columns,
        *ok_columns,
        F.coalesce(strict_break, F.lit(False)).alias("_broken"),
        "_first",
        last_row.alias("_last"),
    )
    names = [s.name for s in stages]
    found = walked.where(f"_ok{last}")
    if last > 0 and stages[last].times != (1, 1):
        found = _last_groups(found, stages[last], time, within)
    matches = found.select(*key, *names, "_first", "_last")
    timeouts = walked.where(f"not _ok{last} and not _broken").select(
        *key,
        *[
            F.when(F.col(f"_ok{i}"), F.col(n)).alias(n)
            for i, n in enumerate(names)
        ],
        (start_time + interval(within or "0 seconds")).alias("timeout_ts"),
    )
    if within is None:
        timeouts = timeouts.where(F.lit(False))
    waiting = walked.where(f"not _ok{last} and not _broken").select(*key, "_first")
    return {"matches": matches, "timeouts": timeouts, "waiting": waiting}


def _first_groups(starts, rows, key, stages, seq, last):
    """One start per allowed number of repetitions; it goes on after its last row."""
    least, most = stages[0].times
    counts = F.sequence(F.lit(least), F.least(F.lit(most), F.size("_group0")))
    counted = starts.where(F.size("_group0") >= least).withColumn("_times", F.explode(counts))
    grouped = counted.withColumn("_s0", F.slice("_group0", F.lit(1), F.col("_times")))
    grouped = grouped.withColumn("_first", F.col("_row")).drop("_after1")
    if last == 0:
        return grouped
    # The successor belongs to the group's last row; sequence numbers are unique.
    after = rows.where("_met0").select(F.col(seq).alias("_end_seq"), "_after1")
    ends = grouped.withColumn("_end", F.element_at("_s0", -1)[seq])
    return ends.join(after, F.col("_end") == F.col("_end_seq")).drop("_end", "_end_seq")


def _last_groups(found, stage, time, within):
    """One match per allowed number of repetitions of the last stage that stays in time."""
    least, most = stage.times
    group = F.col(stage.name)
    counts = F.sequence(F.lit(least), F.least(F.lit(most), F.size(group)))
    out = (
        found.where(F.size(group) >= least)
        .withColumn("_times", F.explode(counts))
        .withColumn(stage.name, F.slice(group, F.lit(1), F.col("_times")))
        .withColumn("_last", F.element_at(stage.name, -1))
    )
    if within is None:
        return out
    return out.where(F.col(f"_last.{time}") < F.col(f"_first.{time}") + interval(within))


def _pairs(matches, chain, key, time, seq, within) -> DataFrame:
    """Each partial match with every later chain of the next segment."""
    left = matches.select("*", F.col(f"_last.{time}").alias("_time"))
    right = chain.select("*", F.col(f"_first.{time}").alias("_time"))
    later = F.struct(f"r__first.{time}", f"r__first.{seq}") > F.struct(
        f"l__last.{time}", f"l__last.{seq}"
    )
    if within is None:
        prefixed = left.select(*[F.col(c).alias(f"l_{c}") for c in left.columns])
        others = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
        condition = later
        for k in key:
            condition = condition & (F.col(f"l_{k}") == F.col(f"r_{k}"))
        joined = prefixed.join(others, condition)
    else:
        joined = interval_join(left, right, key, "_time", "_time", "0 seconds", within, later)
        joined = joined.where(
            F.col(f"r__last.{time}") < F.col(f"l__first.{time}") + interval(within)
        )
    skip = {*key, "_first", "_last", "_time"}
    return joined.select(
        *[F.col(f"l_{k}").alias(k) for k in key],
        *[F.col(f"l_{c}").alias(c) for c in matches.columns if c not in skip],
        *[F.col(f"r_{c}").alias(c) for c in chain.columns if c not in skip],
        F.col("l__first").alias("_first"),
        F.col("r__last").alias("_last"),
    )
