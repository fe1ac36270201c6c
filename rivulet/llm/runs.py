"""Periodic runs of words, by uniting suffix classes in the order of falling LCP.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) and a length of at least ``max(least, times * q)`` that no neighbouring word
extends keeping that period.

The suffixes of a document are sorted (a word counts as a letter). Classes of suffixes
that share their first words are united like Kruskal's trees: the neighbours of the sorted
order by falling length of their common prefix. A class is the ordered set of its
positions; the smaller one goes into the larger. Where two positions of different classes
become neighbours, at a distance within their common prefix, they seed a run: it starts at
the first of the two if the words before them differ, and ends where the prefix does. The
start of a run and the position one period on always become neighbours: a class member
between them would make a shorter period.

A run of ``times`` periods has a common prefix of ``times - 1`` of them, so classes with a
shorter one than the least run needs are never formed; prefixes of that length that do not
repeat inside their document leave after a few rounds of sorting, which cover all documents
of a block of text at once.

Each document is worked on by itself, in one task. A null or empty text has no words, no
runs and the empty text as what is kept. Rows are treated each, whatever their ids, null
and repeated ones too. Other columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import blocks, buffers, session, text_of

LEAST, TIMES = 6, 4

# Positions that one list of an ordered set holds.
LISTED = 2048

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed string"
)


class Positions:
    """An ordered set of many positions: short sorted lists, themselves in order."""

    def __init__(self, ordered: list[int]):
        self.size = len(ordered)
        self.lists = [ordered[i : i + LISTED // 2] for i in range(0, len(ordered), LISTED // 2)]
        self.heads = [some[0] for some in self.lists]

    def __len__(self) -> int:
        return self.size

    def __iter__(self) -> Iterator[int]:
        for some in self.lists:
            yield from some

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The positions before and after one that is not in the set."""
        i = max(bisect_left(self.heads, x) - 1, 0)
        some = self.lists[i]
        k = bisect_left(some, x)
        if k < len(some):
            return some[k - 1] if k else None, some[k]
        return some[k - 1], self.heads[i + 1] if i + 1 < len(self.heads) else None

    def put(self, x: int) -> None:
        i = max(bisect_left(self.heads, x) - 1, 0)
        some = self.lists[i]
        insort(some, x)
        self.heads[i] = some[0]
        self.size += 1
        if len(some) > LISTED:
            self.lists[i : i + 1] = [some[: LISTED // 2], some[LISTED // 2 :]]
            self.heads.insert(i + 1, some[LISTED // 2])


def sorted_suffixes(words: np.ndarray, of: np.ndarray, shared: int) -> np.ndarray:
    """Positions whose first ``shared`` words (a power of two) come again in their document,
    in the order of their suffixes.

    Every document ends in a word of its own, so no suffix reaches into the next one.
    Prefixes are doubled, and only suffixes that are not alone yet are sorted again.
    """
    n = len(words)
    key = of * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    key = key[order]
    place = np.arange(n)
    new = np.append(True, key[1:] != key[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = place[new][np.cumsum(new) - 1]

    def several(new: np.ndarray) -> np.ndarray:
        return ~(new & np.append(new[1:], True))

    many = several(new)
    live, slots = order[many], place[many]
    wanted = slots
    length = 1
    while len(live):
        key = rank[live] * n + rank[live + length]
        inner = np.argsort(key, kind="stable")
        live, key = live[inner], key[inner]
        order[slots] = live
        new = np.append(True, key[1:] != key[:-1])
        rank[live] = slots[new][np.cumsum(new) - 1]
        many = several(new)
        live, slots = live[many], slots[many]
        length *= 2
        if length <= shared:
            wanted = slots
    return order[wanted]


def common_prefixes(words: list[int], of: np.ndarray, order: np.ndarray, shared: int) -> np.ndarray:
    """For each suffix the length of its common prefix with the one before it in the order,
    or 0 where that is below ``shared`` or they are of different documents.

    Taken by position: the prefix of the next position is at most one word shorter.
    """
    before = np.full(len(words), -1, np.int64)
    before[order[1:]] = np.where(of[order[1:]] == of[order[:-1]], order[:-1], -1)
    places = np.sort(order)
    out = np.zeros(len(words), np.int64)
    same, last = 0, -2
    for x, y in zip(places.tolist(), before[places].tolist(), strict=True):
        # A shorter one may be that of a suffix which has left.
        same = same - 1 if x == last + 1 and same > shared else 0
        last = x
        if y < 0:
            same = 0
            continue
        while words[x + same] == words[y + same]:
            same += 1
        out[x] = same
    found = out[order]
    found[found < shared] = 0
    return found


def seeds(
    words: list[int], order: np.ndarray, same: np.ndarray, least: int, times: int
) -> dict[tuple[int, int], int]:
    """Runs (start, length) and their periods."""
    needed = max(least - max(least // times, 1), times - 1)
    edges = np.flatnonzero(same >= needed)
    edges = edges[np.argsort(-same[edges], kind="stable")]
    # A suffix's class is found by the class of one of its members.
    up = list(range(len(order)))
    sets: dict[int, list[int] | Positions] = {}
    runs: dict[tuple[int, int], int] = {}

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def seed(x: int, y: int, prefix: int) -> None:
        period = y - x
        if period * (times - 1) <= prefix and words[x - 1] != words[y - 1]:
            length = period + prefix
            if length >= least:
                known = runs.get((x, length))
                runs[x, length] = period if known is None else min(known, period)

    places = order.tolist()
    for edge, prefix in zip(edges.tolist(), same[edges].tolist(), strict=True):
        i, j = find(edge - 1), find(edge)
        one = sets.pop(i, None) or [places[i]]
        two = sets.pop(j, None) or [places[j]]
        if len(one) < len(two):
            i, j, one, two = j, i, two, one
        if type(one) is list and len(one) + len(two) > LISTED:
            one = Positions(one)
        # Neighbours of the other class only: those of one class were seeded when it formed.
        if type(one) is list:
            for x in two:
                k = bisect_left(one, x)
                if k:
                    seed(one[k - 1], x, prefix)
                if k < len(one):
                    seed(x, one[k], prefix)
            for x in two:
                insort(one, x)
        else:
            for x in two:
                before, after = one.around(x)
                if before is not None:
                    seed(before, x, prefix)
                if after is not None:
                    seed(x, after, prefix)
            for x in two:
                one.put(x)
        up[j] = i
        sets[i] = one
    return runs


def runs_of(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[tuple]]:
    """The runs (start, length, period) of each list of words, by start and period."""
    known: dict[bytes, int] = {}
    ids = [[known.setdefault(w, len(known)) for w in words] for words in texts]
    flat: list[int] = []
    starts = []
    for n, some in enumerate(ids):
        starts.append(len(flat))
        flat += some
        flat.append(len(known) + n)
    words, begins = np.array(flat, np.int64), np.array(starts, np.int64)
    out: list[list[tuple]] = [[] for _ in texts]
    if len(flat) == len(texts):
        return out
    of = np.repeat(np.arange(len(texts)), np.diff(np.append(begins, len(flat))))
    shared = 1 << (max(least - max(least // times, 1), times - 1).bit_length() - 1)
    order = sorted_suffixes(words, of, shared)
    same = common_prefixes(flat, of, order, shared)
    found = seeds(flat, order, same, least, times)
    for (start, length), period in found.items():
        n = int(of[start])
        out[n].append((start - starts[n], length, period))
    for some in out:
        some.sort(key=lambda r: (r[0], r[2]))
    return out


def _collapsed(words: list[bytes], runs: list[tuple]) -> bytes:
    """The words that no run holds after its first period."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = np.cumsum(gone)[:-1] == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """For each row: doc_id, n_words, its ``runs`` and the ``collapsed`` text, in which
    each run is left with its first period and white space is one space."""
    if least < 2 or times < 2:
        raise ValueError("runs have two words and two periods at least")

    def run(batches):
        for batch in blocks(batches, "text"):
            data, offsets = buffers(batch.column("text"))
            raw, offsets = data.tobytes(), offsets.tolist()
            texts = [raw[a:b].split() for a, b in zip(offsets, offsets[1:], strict=False)]
            found = runs_of(texts, least, times)
            kept = [_collapsed(words, runs) for words, runs in zip(texts, found, strict=True)]
            flat = list(zip(*[r for runs in found for r in runs], strict=True)) or [[], [], []]
            spans = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in flat], fields=list(RUN))
            ends = np.cumsum([0, *[len(runs) for runs in found]], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(words) for words in texts], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), spans),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    session(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, FOUND)


def looped(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where every tenth document, by its id's CRC, repeats itself: from word
    a on, its next p words come again and again until its old number of words is reached.

    Rows without an id and other documents keep their texts.
    """

    def loop(doc_id: int, text: str) -> str:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10:
            return text
        words = text.encode().split()
        n, g = len(words), h // 10
        if not n:
            return text
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return b" ".join([*words[:a], *[words[a + i % p] for i in range(n - a)]]).decode()

    def run(batches):
        for batch in blocks(batches, "text"):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            new = [t if i is None else loop(i, t) for i, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(new, pa.string())], ["doc_id", "text"]
            )

    session(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest exponent, and digests of runs and kept words."""
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a),
    )
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.expr("1000 * best.length div best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
