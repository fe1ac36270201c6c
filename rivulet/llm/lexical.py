"""Ranked lexical search by posting lists blocked by the likeness of their documents.

Terms are the maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z
lower-cased. A document's score for an item is the sum, over the item's different terms, of
a weight that falls with the documents holding the term and an impact that grows with its
occurrences and falls with the document's length. All of it is whole numbers.

Every document becomes a vector of the impacts of the items' terms. Documents are dealt to
shards of bounded size. In a shard each term has a posting list, which is cut into blocks
of documents that are alike: the nearest of some of its documents, by random projections.
A block's summary is the largest impact of each term among its documents. An item
looks through the lists of its terms, the one that can add most first. A block is skipped
only if the item's weights times its summary stay below the score of the k-th document found
so far, and the other lists only if all they can add stays below it. Neither loses a
document, so results are exact, and ties are kept and ordered by id.

A task goes through shard after shard and keeps the best k of each item; the best of all
tasks meet per item. Lists are blocked when an item first asks for them, and forgotten with
their shard.

Items are taken in blocks of about ``ITEM_TERMS`` different terms, as many as there are:
only a block's terms are on the driver and sent to tasks. One item with more terms is a
block by itself; shards have fewer documents then.

A null or empty text has no term: such a document is never found, such an item finds
nothing. Every row of the items has its own list, so a repeated item has its list twice.
Rows of documents are ranked each; among equal scores null ids come last. Other columns are
left out. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import blocks, buffers, session, text_of, written

TOP = 10
# Different terms, and bytes of text, of the items that are served together.
ITEM_TERMS, ITEM_BYTES = 8_192, 4 << 20
# Impacts that a shard's vectors hold, and the documents of a block.
CELLS, BLOCK = 1 << 24, 128
# Bytes of summaries that a shard keeps.
SUMMARIES = 96 << 20
PROJECTIONS = 16
PART = 4 << 20

NO_ID = np.iinfo(np.int64).max

_TERM = bytearray(b" " * 256)
for _b in range(256):
    if _b >= 128 or chr(_b).isalnum():
        _TERM[_b] = ord(chr(_b).lower()) if _b < 128 else _b
TERM_BYTES = bytes(_TERM)


def counted(text: bytes) -> tuple[Counter, int]:
    """The terms of a text with their occurrences, and the number of all of them."""
    found: Counter = Counter()
    n, at = 0, 0
    while at < len(text):
        end = at + PART
        while end < len(text) and TERM_BYTES[text[end]] != 32:
            end += 1
        some = text[at:end].translate(TERM_BYTES).split()
        found.update(some)
        n += len(some)
        at = end
    return found, n


def vectors(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts) of each document with at least one term.

    ``n`` counts all its terms, ``terms`` are places in the given list.
    """
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        place = {t: i for i, t in enumerate(sent.value)}
        for batch in blocks(batches, "text"):
            data, offsets = buffers(batch.column("text"))
            raw, offsets = data.tobytes(), offsets.tolist()
            keep, sizes, ends, which, often = [], [], [0], [], []
            for a, b in zip(offsets, offsets[1:], strict=False):
                found, n = counted(raw[a:b])
                keep.append(n > 0)
                if n:
                    mine = found.keys() & place.keys()
                    which += [place[t] for t in mine]
                    often += [found[t] for t in mine]
                    ends.append(len(which))
                    sizes.append(n)
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").filter(pa.array(keep, pa.bool_())),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(which, pa.int32())),
                    pa.ListArray.from_arrays(at, pa.array(often, pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(n: np.ndarray, counts: np.ndarray, documents: int, total: int) -> np.ndarray:
    """``n``: the terms of each count's document."""
    m = 10 + (90 * n * documents) // total
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


class Shard:
    """Documents as rows of impacts (below 2 ** 24, so exact as 32-bit floats)."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, terms: np.ndarray, values: np.ndarray, width: int):
        self.ids = ids
        self.impacts = np.zeros((len(ids), width), np.float32)
        self.impacts[rows, terms] = values
        self.most = self.impacts.max(axis=0).astype(np.float64)
        order = np.argsort(terms, kind="stable")
        self.posted = rows[order]
        self.ends = np.cumsum(np.bincount(terms, minlength=width))
        signs = np.random.default_rng(7).integers(0, 2, (width, PROJECTIONS)) * 2 - 1
        self.sketch = self.impacts @ signs.astype(np.float32)
        self.sketch /= np.maximum(np.linalg.norm(self.sketch, axis=1, keepdims=True), 1e-9)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.held = 0

    def blocked(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A term's documents in the order of their blocks, the blocks' ends, their summaries."""
        if term in self.lists:
            return self.lists[term]
        docs = self.posted[self.ends[term - 1] if term else 0 : self.ends[term]]
        starts = np.zeros(1, np.int64)
        if len(docs) > BLOCK:
            centres = docs[np.random.default_rng(term).permutation(len(docs))[: -(-len(docs) // BLOCK)]]
            nearest = (self.sketch[docs] @ self.sketch[centres].T).argmax(axis=1)
            order = np.argsort(nearest, kind="stable")
            docs, nearest = docs[order], nearest[order]
            first = np.append(True, nearest[1:] != nearest[:-1])
            begins = np.flatnonzero(first)[np.cumsum(first) - 1]
            # A centre that too many are next to has several blocks.
            starts = np.flatnonzero(first | ((np.arange(len(docs)) - begins) % (2 * BLOCK) == 0))
        summary = np.maximum.reduceat(self.impacts[docs], starts, axis=0)
        if self.held > SUMMARIES:
            self.lists, self.held = {}, 0
        self.held += summary.nbytes
        found = docs, np.append(starts[1:], len(docs)), summary
        self.lists[term] = found
        return found


class Best:
    """The k best documents of an item, equal scores by ascending id."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids = np.zeros(0), np.zeros(0, np.int64)

    @property
    def least(self) -> float:
        """The score that a document must reach to be among them."""
        return self.scores[-1] if len(self.scores) == self.k else 1.0

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = scores >= self.least
        if not some.any():
            return
        scores, ids = np.append(self.scores, scores[some]), np.append(self.ids, ids[some])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def look_up(shard: Shard, terms: np.ndarray, weights: np.ndarray, best: Best, skip: bool = True) -> int:
    """Bring an item's best documents up to date with a shard; gives how many were scored."""
    most = weights * shard.most[terms]
    order = np.argsort(-most, kind="stable")
    rest = np.cumsum(most[order][::-1])[::-1]
    done = np.zeros(len(shard.ids), bool)
    scored = 0
    for i, at in enumerate(order.tolist()):
        # A document not seen yet has no term of the lists before this one.
        if rest[i] < (best.least if skip else 1):
            break
        docs, ends, summary = shard.blocked(int(terms[at]))
        if skip:
            may = summary[:, terms].astype(np.float64) @ weights >= best.least
            sizes = np.diff(ends, prepend=0)
            chosen = docs[np.repeat(may, sizes)]
        else:
            chosen = docs
        chosen = chosen[~done[chosen]]
        # What a block's bound rules out stays ruled out in other lists.
        done[docs] = True
        if len(chosen):
            scored += len(chosen)
            scores = shard.impacts[np.ix_(chosen, terms)].astype(np.float64) @ weights
            best.add(scores, shard.ids[chosen])
    return scored


def _shards(batches: Iterator[pa.RecordBatch], width: int, size: int, documents: int, total: int):
    """Shards of at most ``size`` documents from rows of vectors."""
    held, rows = [], 0

    def made(parts) -> Shard:
        ids = np.concatenate([p[0] for p in parts])
        sizes = np.concatenate([p[1] for p in parts])
        number = np.concatenate([p[2] for p in parts])
        terms = np.concatenate([p[3] for p in parts])
        counts = np.concatenate([p[4] for p in parts])
        of = np.repeat(np.arange(len(ids)), number)
        return Shard(ids, of, terms, impacts(sizes[of], counts, documents, total), width)

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, size - rows)
            terms, counts = part.column("terms"), part.column("counts")
            ids = part.column("doc_id").cast(pa.int64())
            held.append(
                (
                    ids.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False),
                    part.column("n").to_numpy(),
                    np.diff(terms.offsets.to_numpy()),
                    terms.flatten().to_numpy(),
                    counts.flatten().to_numpy(),
                )
            )
            at, rows = at + part.num_rows, rows + part.num_rows
            if rows == size:
                yield made(held)
                held, rows = [], 0
    if rows:
        yield made(held)


def _item_blocks(items: DataFrame) -> Iterator[tuple[list[Row], list[bytes], list[list[int]]]]:
    """Items in blocks: their rows, the different terms, each item's terms as places."""
    rows: list[Row] = []
    place: dict[bytes, int] = {}
    each: list[list[int]] = []
    size = 0
    chosen = items.select("item_id", text_of().alias("text"))
    for row in chosen.toLocalIterator():
        found = sorted(counted(row["text"].encode())[0])
        new = sum(t not in place for t in found)
        if rows and (len(place) + new > ITEM_TERMS or size + len(row["text"]) > ITEM_BYTES):
            yield rows, list(place), each
            rows, place, each, size = [], {}, [], 0
        rows.append(Row(item_id=row["item_id"]))
        each.append([place.setdefault(t, len(place)) for t in found])
        size += len(row["text"])
    if rows:
        yield rows, list(place), each


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """For each item its k best documents: item_id, rank, doc_id, score."""
    spark = session(docs.sparkSession)
    id_type = items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", id_type)])
    out = T.StructType([T.StructField("item_id", id_type), *T.StructType.fromDDL("rank int, doc_id long, score long").fields])
    found = []
    for rows, terms, each in _item_blocks(items):
        if not terms:
            continue
        index = written(vectors(docs, terms), "lexical-vectors")
        held = index.agg(F.count("*").alias("documents"), F.sum("n").alias("total")).first()
        documents, total = held["documents"], held["total"]
        if not documents:
            continue
        counts = index.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        holding = {r["term"]: r["count"] for r in counts}
        weights = np.array([weight(documents, holding.get(i, 0)) for i in range(len(terms))], np.float64)
        asked = [np.array([t for t in some if t in holding], np.int64) for some in each]
        sent = spark.sparkContext.broadcast((weights, asked))
        width, size = len(terms), max(CELLS // len(terms), 16)

        def run(batches, sent=sent, width=width, size=size, documents=documents, total=total):
            weights, asked = sent.value
            best = [Best(k) for _ in asked]
            for shard in _shards(batches, width, size, documents, total):
                for some, mine in zip(asked, best, strict=True):
                    if len(some):
                        look_up(shard, some, weights[some], mine)
            scores = np.concatenate([b.scores for b in best])
            ids = np.concatenate([b.ids for b in best])
            of = np.repeat(np.arange(len(best), dtype=np.int32), [len(b.ids) for b in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(of), pa.array(ids, mask=ids == NO_ID), pa.array(scores.astype(np.int64))],
                ["item", "doc_id", "score"],
            )

        ranked = index.select("doc_id", "n", "terms", "counts").mapInArrow(run, "item int, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        top = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], schema)
        found.append(written(names.join(top, "item").select(*out.names), "lexical-ranked"))
    if not found:
        return spark.createDataFrame([], out)
    return reduce(DataFrame.unionByName, found)
