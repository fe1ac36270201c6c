"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct five-word shingles (A-Z lower-cased; fewer words:
the whole sequence). Two sets link at a Jaccard similarity of 0.8 or more. Documents of
equal sets are one class, which is compared once.

The shingles of all documents have one order, that of a hash, with those at its end that
many documents share (a licence, a quoted passage). Of two similar sets the first ``n -
ceil(0.8 n) + l`` shingles have at least l in common, for any l. Every document first looks up
its prefix with l = 1, and pairs whose positions leave the overlap possible that the similarity
asks for (the shared ones plus all that can follow) give each document its number of
candidates. A document without any is done. The others choose their l by cost: a longer
prefix is that many more shingles to compare, a higher l makes ever fewer of the candidates
meet it, so l grows with the root of their number, to at most three times the prefix. The
chosen prefixes of candidates are compared as short signatures, and a pair is verified only
if it shares as many prefix shingles as the smaller of its two l asks for.

Where a document has too few other shingles (a member of a large group of near copies),
its costly shingles are looked up too, among such documents. Their lists are not paired
in full: their most typical members are verified with all, then what is still in different
components and can be similar, so that a group of thousands costs a few links a member. Likewise a document
is first verified against its best candidate, and other candidates only as long as the
two are in different components. Links inside a component cannot change it.

Costly shingles come from a count over all documents, in parts of about ``PART_TOKENS``
shingles: those that occur more than once in a part, summed. The broadcast list is held
to ``MAX_COSTLY``; whether a shingle is on it changes the work, never the result.

Null and empty texts have no shingles and link with nothing. Rows of a null id have their
class's component, or null if no row of it has an id. Repeated rows are one class. Other
columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import WORD, blocks, buffers, mix, session, text_of, word_hashes, written
from rivulet.llm.components import connected_components

WORDS = 5
# Similarity as a fraction; links need DEN * shared >= NUM * union.
NUM, DEN = 4, 5
PART_TOKENS = 4_000_000
COSTLY = 32
MAX_COSTLY = 1 << 20
FILTER_BITS = 1 << 26
FLUSH = 1_000_000
HALF = 1 << 31

# Of a costly list, this many of its most typical documents lead it.
LEADERS = 3
LISTED = 2
# The text of a shingle weighs about as much as this many entries of a signature.
VERIFY = 3
# Bits of a set's sketch, in 64-bit words.
SKETCH = [f"sketch{i}" for i in range(16)]

POSTING = "token long, size_place long, k long"
SETS = ["doc_id", "h", "h2", "n", "k", "k2", "token", "seen"]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, ends = word_hashes(data, offsets)
    k = np.uint64(0x9FB21C651E98DF25)
    rolled = np.zeros(0, np.uint64)
    if len(words) >= WORDS:
        rolled = words[: len(words) - WORDS + 1].copy()
        for i in range(1, WORDS):
            rolled *= k
            rolled += words[i : len(words) - WORDS + 1 + i]
        rolled = mix(rolled)
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if b - a >= WORDS:
            s = np.sort(rolled[a : b - WORDS + 1])
            first = np.empty(len(s), bool)
            first[0] = True
            np.not_equal(s[1:], s[:-1], out=first[1:])
            out.append(s[first])
        elif b > a:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = h * np.uint64(0xC2B2AE3D27D4EB4F) + w
            out.append(mix(np.array([h])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(s: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set."""
    if not len(s):
        return 0, 0
    one = mix(s + np.uint64(0x632BE59BD9B4E019))
    two = mix(s ^ np.uint64(0xA0761D6478BD642F))
    return int(one.sum(dtype=np.uint64).view(np.int64)), int(two.sum(dtype=np.uint64).view(np.int64))


def prefix_length(n: int) -> int:
    return n - -(-n * NUM // DEN) + 1


def need(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The overlap that two sets of these sizes need: shared >= NUM/(NUM+DEN) * (na + nb)."""
    return -(-NUM * (na + nb) // (NUM + DEN))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in blocks(batches, "text"):
        yield batch, shingle_sets(*buffers(batch.column("text")))


def documents_sets(docs: DataFrame) -> DataFrame:
    """One row per document (doc_id, h, h2, n, k, k2), and rows (token, seen) of repeated
    shingles."""

    def run(batches):
        pool, pooled, known = [], 0, set()

        def counted():
            tokens, seen = np.unique(np.concatenate(pool), return_counts=True)
            many = seen > 1
            tokens, seen = tokens[many].view(np.int64), seen[many].astype(np.int32)
            nulls = pa.nulls(len(tokens), pa.int64())
            return pa.RecordBatch.from_arrays(
                [nulls, nulls, nulls, nulls.cast(pa.int32()), nulls, nulls, pa.array(tokens), pa.array(seen)],
                SETS,
            )

        for batch, sets in _sets(batches):
            keys = [set_key(s) for s in sets]
            nulls = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("h"),
                    batch.column("h2"),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([a for a, _ in keys], pa.int64()),
                    pa.array([b for _, b in keys], pa.int64()),
                    nulls,
                    nulls.cast(pa.int32()),
                ],
                SETS,
            )
            for key, s in zip(keys, sets, strict=True):
                if len(s) and key not in known:
                    known.add(key)
                    pool.append(s)
                    pooled += len(s)
            if pooled >= PART_TOKENS:
                yield counted()
                pool, pooled, known = [], 0, set()
        if pool:
            yield counted()

    return docs.mapInArrow(run, ", ".join(f"{c} {'int' if c in ('n', 'seen') else 'long'}" for c in SETS))


def postings(docs: DataFrame, costly: np.ndarray) -> DataFrame:
    """The looked-up shingles of each document's lengthened prefix.

    ``size_place`` has the set's size in its upper half and in the lower half the place in
    the prefix or, for a costly shingle, minus the number of the document's costly ones.
    """
    sent = docs.sparkSession.sparkContext.broadcast(costly)

    def run(batches):
        dear = sent.value
        for _, sets in _sets(batches):
            tokens, keys, places = [], [], []
            for s in sets:
                n = len(s)
                if not n:
                    continue
                p = prefix_length(n)
                place = np.arange(p)
                if len(dear):
                    at = np.searchsorted(dear, s)
                    at[at == len(dear)] = 0
                    hit = dear[at] == s
                    cheap = s[~hit][:p]
                    late = s[hit][: p - len(cheap)]
                    place[len(cheap) :] = -int(hit.sum())
                    tokens += [cheap, late]
                else:
                    tokens.append(s[:p])
                keys.append(np.full(p, set_key(s)[0]))
                places.append((n << 32) + place + HALF)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).view(np.int64)),
                        pa.array(np.concatenate(places)),
                        pa.array(np.concatenate(keys)),
                    ],
                    ["token", "size_place", "k"],
                )

    return docs.mapInArrow(run, POSTING)


def required(n: int, prefix: int, cheap: int, cost: int) -> int:
    """How many prefix shingles a document asks for: l, of which ``l + VERIFY * n * cost / l``
    is least, as far as its cheap shingles and three times its prefix go."""
    return max(1, min(math.isqrt(VERIFY * n * cost), 2 * prefix, cheap - prefix + 1))


def signatures(texts: DataFrame, costly: np.ndarray) -> DataFrame:
    """The chosen prefixes of (doc_id, text, cost): two bytes of the hash of each shingle.

    A document with costly shingles in its first prefix has all its cheap ones in it.
    """
    sent = texts.sparkSession.sparkContext.broadcast(costly)

    def run(batches):
        dear = sent.value
        for batch, sets in _sets(batches):
            asks, signs = [], []
            for cost, s in zip(batch.column("cost").to_pylist(), sets, strict=True):
                n, p = len(s), prefix_length(len(s))
                if len(dear):
                    at = np.searchsorted(dear, s)
                    at[at == len(dear)] = 0
                    s = s[dear[at] != s]
                asks.append(required(n, p, len(s), cost))
                signs.append(np.sort(s[: p + asks[-1] - 1].astype(np.uint16)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(asks, pa.int32()), pa.array(signs, pa.binary())],
                ["doc_id", "asked", "sign"],
            )

    return texts.mapInArrow(run, "doc_id long, asked int, sign binary")


def in_common(a: np.ndarray, b: np.ndarray) -> int:
    """How many entries two sorted arrays share, repeated ones as often as both have them."""
    # The k-th of equal entries counts as an entry of its own.
    rank = lambda x: (x.astype(np.int64) << 32) + np.arange(len(x)) - np.searchsorted(x, x)
    return len(np.intersect1d(rank(a), rank(b), assume_unique=True))


def matching(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs that share as many prefix shingles as the smaller of their two l asks for.

    Two bytes of a hash may agree by chance, which lets a pair pass and never stops one.
    """

    def run(batches):
        for batch in batches:
            asked = np.minimum(batch.column("asked_a").to_numpy(), batch.column("asked_b").to_numpy())
            rows = zip(asked.tolist(), batch.column("sign_a").to_pylist(), batch.column("sign_b").to_pylist(), strict=True)
            keep = [in_common(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)) >= m for m, x, y in rows]
            yield batch.select(["a", "b", "weight"]).filter(pa.array(keep, pa.bool_()))

    def of(side: str) -> DataFrame:
        return signs.select(
            F.col("doc_id").alias(side), F.col("asked").alias(f"asked_{side}"), F.col("sign").alias(f"sign_{side}")
        )

    both = pairs.select("a", "b", "weight").join(of("a"), "a").join(of("b"), "b")
    return both.mapInArrow(run, "a long, b long, weight double")


class _Pairs:
    """Pairs of one task, combined before they leave it."""

    NAMES = ["a", "b", "na", "nb", "shared", "pa", "pb", "chained"]

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, left: np.ndarray, right: np.ndarray, chained: int) -> None:
        """Rows (k, n, pos) of two documents with a shingle in common."""
        swap = left[:, 0] > right[:, 0]
        a, b = np.where(swap[:, None], right, left), np.where(swap[:, None], left, right)
        one = np.ones(len(a), np.int64)
        self.parts.append(
            np.stack(
                [a[:, 0], b[:, 0], a[:, 1], b[:, 1], one, a[:, 2], b[:, 2], one * chained], axis=1
            )
        )
        self.held += len(a)

    def flush(self) -> pa.RecordBatch | None:
        if not self.held:
            return None
        rows = np.concatenate(self.parts)
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.empty(len(rows), bool)
        new[0] = True
        new[1:] = (rows[1:, :4] != rows[:-1, :4]).any(axis=1)
        at = np.flatnonzero(new)
        columns = [rows[at, i] for i in range(4)] + [np.add.reduceat(rows[:, 4], at)]
        columns += [np.maximum.reduceat(rows[:, i], at) for i in (5, 6, 7)]
        self.parts, self.held = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], self.NAMES)


PAIRS = ", ".join(f"{c} long" for c in _Pairs.NAMES)


def _runs(batches, columns: list[str]) -> Iterator[np.ndarray]:
    """Rows of whole tokens: a token's rows never lie in two results.

    The first columns are the token, size_place and the document; the result has token,
    document, size, place, and the other columns. Equal documents come once.
    """

    def ready(rows: np.ndarray) -> np.ndarray:
        rows = rows[np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1))]
        size, place = rows[:, 1] >> 32, (rows[:, 1] & 0xFFFFFFFF) - HALF
        return np.column_stack([rows[:, 0], rows[:, 2], size, place, rows[:, 3:]])

    rest = np.zeros((0, len(columns)), np.int64)
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy() for c in columns], axis=1)
        if not len(rows):
            continue
        rest = np.concatenate([rest, rows])
        cut = int(np.searchsorted(rest[:, 0], rest[-1, 0], side="left"))
        if cut:
            yield ready(rest[:cut])
            rest = rest[cut:]
    if len(rest):
        yield ready(rest)


def _lists(rows: np.ndarray) -> Iterator[np.ndarray]:
    """The rows of each token."""
    if len(rows):
        cuts = np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1
        yield from (part for part in np.split(rows, cuts) if len(part) > 1)


def _all_pairs(rows: np.ndarray, pairs: _Pairs) -> Iterator[pa.RecordBatch]:
    """Pairs of rows of one token whose sizes fit.

    Rows are sorted by token and size, so that the k-th next rows are compared at once.
    """
    live = np.arange(len(rows) - 1)
    step = 1
    while len(live):
        live = live[live + step < len(rows)]
        near, far = rows[live], rows[live + step]
        fits = (near[:, 0] == far[:, 0]) & (NUM * far[:, 2] <= DEN * near[:, 2])
        live, near, far = live[fits], near[fits], far[fits]
        if len(near):
            pairs.add(near[:, 1:4], far[:, 1:4], 0)
            if pairs.held > FLUSH:
                yield pairs.flush()
        step += 1


def _may_link(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Whether documents of a costly list can be similar without a cheap shingle in common.

    All cheap shingles of such documents were looked up, so what else they share are costly
    ones: no more than the one with fewer of them has.
    """
    fewer = np.minimum(-one[3], -many[:, 3])
    return fewer >= need(one[2], many[:, 2])


def candidates(sorted_postings: DataFrame) -> DataFrame:
    """Pairs of documents that share a cheap shingle, with leaders of costly lists.

    Leaders are the documents with the largest share of costly shingles: the original of a
    group of near copies rather than one of the copies, which differ more from each other.
    A list has leaders for each band of sizes. The postings of costly shingles come too:
    ``chained`` is LISTED, the shingle is in a, the document in b, its size in na, its
    place in pa.
    """

    def run(batches):
        pairs = _Pairs()
        for rows in _runs(batches, ["token", "size_place", "k"]):
            dear = rows[:, 3] < 0
            yield from _all_pairs(rows[~dear], pairs)
            listed = rows[dear]
            if len(listed):
                none = np.zeros(len(listed), np.int64)
                columns = [listed[:, 0], listed[:, 1], listed[:, 2], none, none, listed[:, 3], none]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in [*columns, none + LISTED]], _Pairs.NAMES
                )
            for mine in _lists(listed):
                at = 0
                while at < len(mine):
                    end = int(np.searchsorted(NUM * mine[:, 2], DEN * mine[at, 2], side="right"))
                    band = mine[at:end]
                    share = -band[:, 3] / band[:, 2]
                    for lead in np.lexsort((band[:, 1], -share))[:LEADERS]:
                        others = band[_may_link(band[lead], band)]
                        others = others[others[:, 1] != band[lead, 1]]
                        pairs.add(np.repeat(band[lead : lead + 1, 1:4], len(others), axis=0), others[:, 1:4], 1)
                    at = end
                if pairs.held > FLUSH:
                    yield pairs.flush()
        if (last := pairs.flush()) is not None:
            yield last

    return sorted_postings.mapInArrow(run, PAIRS)


def sketch(s: np.ndarray) -> np.ndarray:
    """A bit for each shingle, by its hash; shingles may share bits."""
    bits = np.zeros(len(SKETCH), np.uint64)
    at = (s & np.uint64(64 * len(SKETCH) - 1)).astype(np.int64)
    np.bitwise_or.at(bits, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    return bits.view(np.int64)


def _sketches(texts: DataFrame) -> DataFrame:
    def run(batches):
        for batch, sets in _sets(batches):
            bits = np.stack([sketch(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c) for c in bits.T]], ["k", *SKETCH]
            )

    return texts.mapInArrow(run, "k long, " + ", ".join(f"{c} long" for c in SKETCH))


def _sketches_fit(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Whether sketches leave room for enough shared shingles.

    A bit that only one of two sets has is at least one shingle the other lacks. Words are
    counted unsigned: bitwise_count takes the absolute value of signed numbers.
    """
    a, b = one[5:].astype(np.uint64), many[:, 5:].astype(np.uint64)
    most = np.minimum(
        one[2] - np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64),
        many[:, 2] - np.bitwise_count(~a & b).sum(axis=1, dtype=np.int64),
    )
    return most >= need(one[2], many[:, 2])


def _across(sorted_lists: DataFrame) -> DataFrame:
    """Pairs of different components that share a costly shingle and may link.

    Of two documents one is not in the list's largest component. Pairs whose sizes, costly
    shingles or sketches rule a link out do not leave the task.
    """

    def run(batches):
        pairs = _Pairs()
        for rows in _runs(batches, ["token", "size_place", "k", "component", *SKETCH]):
            for mine in _lists(rows):
                found, of, sizes = np.unique(mine[:, 4], return_inverse=True, return_counts=True)
                small = of != sizes.argmax()
                for i in np.flatnonzero(small) if len(found) > 1 else ():
                    low = np.searchsorted(DEN * mine[:, 2], NUM * mine[i, 2], side="left")
                    high = np.searchsorted(NUM * mine[:, 2], DEN * mine[i, 2], side="right")
                    place = np.arange(low, high)
                    place = place[(of[place] != of[i]) & ((place > i) | ~small[place])]
                    others = mine[place][_may_link(mine[i], mine[place])]
                    others = others[_sketches_fit(mine[i], others)]
                    if len(others):
                        pairs.add(np.repeat(mine[i : i + 1, 1:4], len(others), axis=0), others[:, 1:4], 1)
                    if pairs.held > FLUSH:
                        yield pairs.flush()
        if (last := pairs.flush()) is not None:
            yield last

    return sorted_lists.mapInArrow(run, PAIRS)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of document ids whose texts are similar enough."""

    def run(batches):
        for batch in batches:
            for part in blocks([batch], "text_a"):
                left = shingle_sets(*buffers(part.column("text_a")))
                right = shingle_sets(*buffers(part.column("text_b")))
                keep = []
                for x, y in zip(left, right, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(DEN * both >= NUM * (len(x) + len(y) - both) and both > 0)
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = pairs.select("a", "b")
    needed = _only_needed(texts, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
    needed = written(needed, "ngram-needed")
    a = needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(run, "a long, b long")


def _only_needed(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of these ids, by a bit table of fixed size, which lets few others pass."""
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    words = (
        ids.select(bit("doc_id").alias("bit"))
        .groupBy(F.shiftright("bit", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits"))
        .toPandas()
    )
    table = np.zeros(FILTER_BITS >> 5, np.uint32)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        bits = sent.value
        for batch in batches:
            at = batch.column("bit").to_numpy()
            keep = (bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1
            yield batch.select(["doc_id", "text"]).filter(pa.array(keep))

    near = docs.where("doc_id is not null").select("doc_id", "text", bit("doc_id").alias("bit"))
    return near.mapInArrow(run, "doc_id long, text string")


def _hashes() -> list[Column]:
    """Two hashes that tell texts apart."""
    return [F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("h2")]


def jaccard_components(docs: DataFrame) -> DataFrame:
    """For each row: doc_id, n_shingles, component_id."""
    return _labelled(docs).select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _labelled(docs: DataFrame) -> DataFrame:
    """For each row: doc_id, h, h2, n, k, k2, and of its class the smallest id (rep) and
    the smallest that links reach (component)."""
    spark = session(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    seen = written(documents_sets(texts.select("*", *_hashes())), "ngram-sets")
    rows = seen.where("k is not null").select("doc_id", "h", "h2", "n", "k", "k2")
    classes = written(
        rows.where("n > 0").groupBy("n", "k", "k2").agg(F.min("doc_id").alias("rep")),
        "ngram-classes",
    )

    counts = seen.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen"))
    dear = counts.where(f"seen >= {COSTLY}").orderBy(F.desc("seen"), "token").limit(MAX_COSTLY)
    costly = np.sort(dear.select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64))

    # Shuffled once and sorted: tokens meet, long lists are read as streams.
    listed = postings(texts, costly).repartition("token").sortWithinPartitions(
        "token", "size_place", "k"
    )
    found = written(candidates(listed), "ngram-candidates")
    known = classes.where("rep is not null").select("k", F.col("n").cast("long").alias("n"), "rep")
    fits = F.col("shared") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1
    enough = DEN_NUM * fits >= NUM * (F.col("na") + F.col("nb"))

    def named(pairs: DataFrame) -> DataFrame:
        """Pairs of set keys as pairs of ids; keys that collide give both their ids."""
        a = known.select(F.col("k").alias("a"), F.col("n").alias("na"), F.col("rep").alias("x"))
        b = known.select(F.col("k").alias("b"), F.col("n").alias("nb"), F.col("rep").alias("y"))
        return pairs.join(a, ["a", "na"]).join(b, ["b", "nb"]).where("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "shared", "na", "nb", "chained"
        )

    grouped = found.where(F.col("chained") < LISTED).groupBy("a", "b", "na", "nb").agg(
        F.sum("shared").alias("shared"),
        F.max("pa").alias("pa"),
        F.max("pb").alias("pb"),
        F.max("chained").alias("chained"),
    )
    near = written(named(grouped.where((F.col("chained") == 1) | enough)), "ngram-near")
    led, loose = near.where("chained = 1"), near.where("chained = 0")
    costs = written(
        loose.select(F.explode(F.array("a", "b")).alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("cost")),
        "ngram-costs",
    )
    lists = None
    ids = near.select(F.explode(F.array("a", "b")).alias("doc_id"))
    if len(costly):
        again = found.where(F.col("chained") == LISTED).select(
            F.col("a").alias("token"), F.col("b").alias("k"), F.col("na").alias("n"), F.col("pa").alias("pos")
        )
        lists = written(
            again.join(known, ["k", "n"])
            .select("token", F.expr(f"shiftleft(n, 32) + pos + {HALF}L").alias("size_place"), F.col("rep").alias("k"))
            .distinct(),
            "ngram-lists",
        )
        ids = ids.unionByName(lists.select(F.col("k").alias("doc_id")))
    held = written(_only_needed(texts, ids.distinct()), "ngram-texts")

    weight = (F.col("shared") / (F.col("na") + F.col("nb"))).alias("weight")
    signs = written(signatures(held.join(costs, "doc_id"), costly), "ngram-signatures")
    kept = matching(loose.select("a", "b", weight), signs)
    pairs = written(
        kept.unionByName(led.select("a", "b", weight)).groupBy("a", "b").agg(F.max("weight").alias("weight")),
        "ngram-pairs",
    )

    # First each document's best candidate, then what is still apart.
    ends = pairs.select(F.col("a").alias("d"), F.col("b").alias("e"), "weight").unionByName(
        pairs.select(F.col("b").alias("d"), F.col("a").alias("e"), "weight")
    )
    best = ends.groupBy("d").agg(F.max_by("e", F.struct("weight", "e")).alias("e"))
    first = best.select(F.least("d", "e").alias("a"), F.greatest("d", "e").alias("b")).distinct()
    first = written(first, "ngram-first")
    links = written(verified(first, held), "ngram-links1")
    joined = written(connected_components(links), "ngram-components1")

    def component(df: DataFrame, column: str, name: str) -> DataFrame:
        label = joined.select(F.col("id").alias(column), F.col("component").alias("_label"))
        return df.join(label, column, "left").withColumn(
            name, F.coalesce("_label", column)
        ).drop("_label")

    apart = component(component(pairs.select("a", "b"), "a", "ca"), "b", "cb").where("ca <> cb")
    second = apart.select("a", "b")
    if lists is not None:
        known = held.join(lists.select(F.col("k").alias("doc_id")).distinct(), "doc_id", "left_semi")
        marked = component(lists, "k", "component").join(_sketches(known), "k")
        across = _across(
            marked.repartition("token").sortWithinPartitions("token", "size_place", "k")
        )
        second = second.unionByName(across.select("a", "b"))
    second = written(second.distinct().join(first, ["a", "b"], "left_anti"), "ngram-second")
    links = links.unionByName(written(verified(second, held), "ngram-links2"))
    reached = connected_components(links).select(F.col("id").alias("rep"), "component")
    labels = classes.join(reached, "rep", "left").select(
        "n", "k", "k2", "rep", F.coalesce("component", "rep").alias("component")
    )
    return rows.join(labels, ["n", "k", "k2"], "left")


DEN_NUM = DEN + NUM


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component stays: that of the smallest id.

    It is a row of the class whose smallest id is the component's; of several such rows
    with that id the one of the smallest text hash stays, of equal ones the first by their
    other columns. So ids that come again with other texts lose none of these. Rows without
    id and texts without words link with nothing and stay.
    """
    found = _labelled(docs).where("n > 0 and doc_id = rep and rep = component")
    stay = found.groupBy("n", "k", "k2").agg(F.min(F.struct("doc_id", "h", "h2")).alias("s")).select("s.*")
    # The given columns travel as one, whatever their names.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
    )
    plain = F.col("doc_id").isNull() | ~F.col("text").rlike(WORD)
    keyed = rows.where(~plain).select("row", "doc_id", *_hashes())
    first = keyed.join(stay, ["doc_id", "h", "h2"], "left_semi")
    sortable = [
        F.col("row").getField(f.name) for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)
    ]
    order = Window.partitionBy("doc_id", "h", "h2").orderBy(*sortable)
    one = first.withColumn("nth", F.row_number().over(order)).where("nth = 1")
    return one.select("row.*").unionByName(rows.where(plain).select("row.*"))
