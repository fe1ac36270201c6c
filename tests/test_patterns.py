"""Pattern matching against a sequential search."""

import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators.patterns import (
    FOLLOWED_BY,
    FOLLOWED_BY_ANY,
    NEXT,
    Stage,
    match_pattern,
)

SCHEMA = "k string, seq long, ts long, e string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("rt", F.timestamp_seconds("ts"))


def rows_of(seed, n=140):
    rng = random.Random(seed)
    return [
        (rng.choice("hhha"), i, i // 2 + rng.randint(-5, 5), rng.choice("abc")) for i in range(n)
    ]


def search(rows, stages, within):
    """Matches and timeouts by following every partial match through its key's rows."""
    matches, timeouts = set(), set()
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[1]))
        for start, first in enumerate(mine):
            if first[3] != stages[0][0]:
                continue
            partials = [(0, (first[1],))]
            for row in mine[start + 1 :]:
                after = []
                for at, seqs in partials:
                    if within is not None and row[2] - first[2] >= within:
                        timeouts.add(seqs)
                        continue
                    want, how = stages[at + 1]
                    hit = row[3] == want
                    if hit:
                        if at + 2 == len(stages):
                            matches.add((*seqs, row[1]))
                        else:
                            after.append((at + 1, (*seqs, row[1])))
                    if how == FOLLOWED_BY_ANY or (how == FOLLOWED_BY and not hit):
                        after.append((at, seqs))
                partials = after
            if within is not None:
                timeouts.update(seqs for _, seqs in partials)
    return matches, timeouts


PATTERNS = [
    [("a", None), ("b", NEXT)],
    [("a", None), ("b", FOLLOWED_BY)],
    [("a", None), ("b", FOLLOWED_BY_ANY)],
    [("a", None), ("b", FOLLOWED_BY), ("c", FOLLOWED_BY)],
    [("a", None), ("b", FOLLOWED_BY), ("a", NEXT)],
    [("a", None), ("b", NEXT), ("c", FOLLOWED_BY_ANY)],
]


@pytest.mark.parametrize("pattern", PATTERNS, ids=lambda p: "-".join(f"{s}{h or ''}" for s, h in p))
@pytest.mark.parametrize("within,limit", [(6, 8), (6, 10_000), (None, 8)])
def test_sequences(spark, pattern, within, limit):
    rows = rows_of(len(pattern) * 7 + limit)
    stages = [
        Stage(f"s{i}", F.col("e") == want, how or FOLLOWED_BY)
        for i, (want, how) in enumerate(pattern)
    ]
    span = f"{within} seconds" if within else None
    out = match_pattern(frame(spark, rows), ["k"], "rt", "seq", stages, span, limit)
    names = [s.name for s in stages]
    matches, timeouts = search(rows, pattern, within)
    got = [tuple(r[n]["seq"] for n in names) for r in out["matches"].collect()]
    assert sorted(got) == sorted(matches)
    if within:
        late = [
            tuple(r[n]["seq"] for n in names if n in r.asDict() and r[n] is not None)
            for r in out["timeouts"].collect()
        ]
        assert sorted(late) == sorted(timeouts)


def test_without_key_stays_split(spark):
    rows = [("x", i, i, e) for i, e in enumerate("abcabbca")]
    stages = [Stage("s0", F.col("e") == "a"), Stage("s1", F.col("e") == "b", NEXT)]
    out = match_pattern(frame(spark, rows), [], "rt", "seq", stages)
    assert sorted(r["s0"]["seq"] for r in out["matches"].collect()) == [0, 3]


@pytest.mark.parametrize("limit", [6, 10_000])
def test_times(spark, limit):
    rows = [("h", i, i, e) for i, e in enumerate("aabcaabacaab")]
    df = frame(spark, rows)
    only = match_pattern(
        df, ["k"], "rt", "seq", [Stage("s0", F.col("e") == "a", times=(1, 3))], None, limit
    )
    hits = [i for i, e in enumerate("aabcaabacaab") if e == "a"]
    expected = [tuple(hits[i : i + n]) for i in range(len(hits)) for n in (1, 2, 3) if i + n <= len(hits)]
    assert sorted(tuple(x["seq"] for x in r["s0"]) for r in only["matches"].collect()) == sorted(expected)

    stages = [Stage("s0", F.col("e") == "a", times=(2, 2)), Stage("s1", F.col("e") == "b", NEXT)]
    then = match_pattern(df, ["k"], "rt", "seq", stages, None, limit)
    got = [(tuple(x["seq"] for x in r["s0"]), r["s1"]["seq"]) for r in then["matches"].collect()]
    text = "aabcaabacaab"
    pairs = [(hits[i], hits[i + 1]) for i in range(len(hits) - 1)]
    assert sorted(got) == sorted(
        (p, p[1] + 1) for p in pairs if p[1] + 1 < len(text) and text[p[1] + 1] == "b"
    )

    stages = [Stage("s0", F.col("e") == "c"), Stage("s1", F.col("e") == "a", times=(1, 2))]
    last = match_pattern(df, ["k"], "rt", "seq", stages, "3 seconds", limit)
    got = [(r["s0"]["seq"], tuple(x["seq"] for x in r["s1"])) for r in last["matches"].collect()]
    assert sorted(got) == [(3, (4,)), (3, (4, 5)), (8, (9,)), (8, (9, 10))]


def test_four_rows_one_to_three_times(spark):
    df = frame(spark, [("s", i, i, "a") for i in range(4)])
    out = match_pattern(df, ["k"], "rt", "seq", [Stage("s0", F.col("e") == "a", times=(1, 3))])
    assert out["matches"].count() == 9


def test_any_pairs_of_four(spark):
    df = frame(spark, [("s", i, i, "a") for i in range(4)])
    stages = [Stage("s0", F.col("e") == "a"), Stage("s1", F.col("e") == "a", FOLLOWED_BY_ANY)]
    assert match_pattern(df, ["k"], "rt", "seq", stages)["matches"].count() == 6
