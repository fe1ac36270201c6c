"""Best-fit packing by a configuration linear program over the length histogram.

Documents become token ids and an end id; only those longer than a sequence are cut.
The pieces' lengths are counted (one row per length). A configuration is a set of
lengths that fits into a sequence; the linear program covers the histogram by as few
configurations as it can. Multiplicative weights solve it: each round prices every
length by how much of it is covered so far, a knapsack dynamic program finds the
configurations of the highest price, and those get a step; rounds go on until all is
covered. The whole numbers of the configurations are then taken, and what the fractions
leave (less than a sequence for each configuration) is filled largest first. Lengths are
counted in units of ``GRAIN`` tokens, which is one: exactly.

The plan depends on at most ``capacity`` counts and has a bounded number of rows. A
piece's place is a lookup by its length and its rank among the pieces of that length;
ranks are counted in parts of a length, so that a common length is no single task.

A null text is empty: it has the end id only. Repeated rows are packed each. Rows with
null ids are packed too. Other columns are left out. An empty table gives no rows.

Ids are those the tokenizer gives. As it never joins characters across white space and
lower-cases, the ids of a word are kept by its bytes, with bounded memory; words not yet
known are given to the tokenizer together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.llm.common import SPACE_BYTES, blocks, buffers, session, text_of, written

CAPACITY = 4096
END_ID = 1
GRAIN = 1
STEP = 0.25
NEAR = 0.005
TINY = 1e-9
FEW_COPIES = 16
KNOWN_WORDS = 300_000
PART = 2 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _plain(self, words: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Words of letters only: each is one unit for the tokenizer, with one end."""
        out: list[bytes] = []
        for i in range(0, len(words), 2000):
            some = words[i : i + 2000]
            encoded = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(encoded[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some):
                raw, at = ids.tobytes(), 0
                for end in (4 * cuts).tolist():
                    out.append(raw[at:end])
                    at = end
            else:
                out += self._plain(some)
        return out

    def _recall(self, words: set[bytes]) -> set[bytes]:
        """Take words over from the older half of what is known; gives the others."""
        missing = words.difference(self.known)
        new = missing.difference(self.older)
        again = missing - new
        self.known.update(zip(again, map(self.older.__getitem__, again), strict=True))
        return new

    def learn(self, words: set[bytes]) -> None:
        """Make all these words known. Words not seen for long are forgotten."""
        if len(self.known) > KNOWN_WORDS:
            self.known, self.older = {}, self.known
        new = self._recall(words)
        # A word's last full stop or comma after a letter is a unit of its own.
        tails = [w for w in new if w[-1] in b".,;:!?" and w[-2:-1].isalpha()]
        cores = new.difference(tails)
        cores.update([w[:-1] for w in tails], [w[-1:] for w in tails])
        cores = list(self._recall(cores))
        texts = [w.decode() for w in cores]
        letters = [i for i, s in enumerate(texts) if s.isalpha()]
        other = [i for i, s in enumerate(texts) if not s.isalpha()]
        for at, encode in ((letters, self._letters), (other, self._plain)):
            ids = encode([texts[i] for i in at])
            self.known.update(zip([cores[i] for i in at], ids, strict=True))
        known = self.known
        known.update([(w, known[w[:-1]] + known[w[-1:]]) for w in tails])

    def encode(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each part; parts are cut at white space."""
        split = []
        for part in parts:
            # Not where a control string or a combining mark could tell cases apart.
            if b"<|" not in part and b"\xcc" not in part and b"\xcd" not in part:
                part = part.lower()
            split.append(part.split())
        words = set().union(*split)
        self.learn(words)
        return [b"".join(map(self.known.__getitem__, s)) for s in split]


@lru_cache(maxsize=1)
def encoder(definition: str) -> Encoder:
    return Encoder(definition)


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in parts of about ``PART`` bytes, cut at white space."""
    at = 0
    while len(text) - at > PART:
        end = at + PART
        while end < len(text) and text[end] not in SPACE_BYTES:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def pieces(docs: DataFrame, definition: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32."""
    sent = docs.sparkSession.sparkContext.broadcast(definition)
    size = 4 * capacity

    def cut(doc_id, chunks: Iterator[bytes], rows: list) -> None:
        rest, n = b"", 0
        for ids in chunks:
            rest += ids
            while len(rest) > size:
                rows.append((doc_id, n, n * capacity, capacity, zlib.crc32(rest[:size])))
                rest, n = rest[size:], n + 1
        if rest:
            rows.append((doc_id, n, n * capacity, len(rest) // 4, zlib.crc32(rest)))

    def run(batches):
        enc, end = encoder(sent.value), np.array([END_ID], "<u4").tobytes()
        for batch in blocks(batches, "text", PART):
            data, offsets = buffers(batch.column("text"))
            raw, offsets = data.tobytes(), offsets.tolist()
            texts = [raw[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
            rows: list[tuple] = []
            if len(texts) == 1 and len(raw) > PART:
                chunks = (enc.encode([part])[0] for part in _parts(raw))
                cut(batch.column("doc_id")[0].as_py(), _then(chunks, end), rows)
            else:
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(texts), strict=True):
                    cut(doc_id, iter((ids + end,)), rows)
            if rows:
                columns = [
                    pa.array(c, t)
                    for c, t in zip(
                        zip(*rows, strict=True),
                        (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()),
                        strict=True,
                    )
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "piece", "start", "length", "ids_crc32"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, PIECES)


def _then(chunks: Iterator[bytes], end: bytes) -> Iterator[bytes]:
    yield from chunks
    yield end


def best_prices(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """For each room the highest total price of sizes, taken any number of times, that fit.

    Sizes are in ascending order.
    """
    best = np.zeros(capacity + 1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right").tolist()
    # The best single size of the first k, and the best prices from the largest room down.
    single = np.concatenate([[0.0], np.maximum.accumulate(prices)]).tolist()
    down = np.zeros(capacity + 1)
    for c in range(1, capacity + 1):
        value = max(best[c - 1], single[fits[c]])
        # Of two or more sizes the smallest takes half the room at most.
        if k := fits[c // 2]:
            value = max(value, (down[capacity - c :].take(sizes[:k]) + prices[:k]).max())
        best[c] = down[capacity - c] = value
    return best


def filling(
    sizes: np.ndarray,
    prices: np.ndarray,
    best: np.ndarray,
    room: int,
    config: dict[int, int],
    usable: np.ndarray | None = None,
) -> dict[int, int]:
    """The configuration filled up with the usable sizes that keep its price highest.

    Of equally good sizes the longest is taken: those differ most between configurations.
    """
    while k := int(np.searchsorted(sizes, room, side="right")):
        value = prices[:k] + best[room - sizes[:k]]
        if usable is not None:
            value[~usable[:k]] = 0.0
        i = k - 1 - int(value[::-1].argmax())
        if value[i] <= TINY:
            break
        # Many copies of a short size at once.
        copies = np.arange(1, room // int(sizes[i]) + 1)
        same = prices[i] * copies + best[room - copies * sizes[i]] >= value[i] * (1 - TINY)
        n = int(copies[same][-1]) if len(copies) > FEW_COPIES else 1
        config[i] = config.get(i, 0) + n
        room -= n * int(sizes[i])
    return config


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> dict[int, int]:
    """Indexes and numbers of the sizes that fit and have the highest total price."""
    best = best_prices(sizes, prices, capacity)
    return filling(sizes, prices, best, capacity, {})


def solve(
    sizes: np.ndarray, demand: np.ndarray, capacity: int
) -> tuple[dict[tuple, float], float]:
    """The linear program: how often each configuration is used, and a lower bound.

    A configuration is a tuple of (index of size, number). Together they cover each size
    exactly as often as demanded, in fractions. A round prices the sizes by how many
    steps of them are covered; the knapsack program gives, for each size that is behind
    the others, the configuration of the highest price that holds it. These are used, the
    best first, until one of their sizes has gained its step: ``STEP`` of its demand, a
    piece at least. Sizes that had their step are replaced by others, at a loss of price
    of ``NEAR`` at most. Covered sizes have no price, so every round brings a size a step
    further and there are at most len(sizes) / ``STEP`` rounds. Any prices give a bound:
    what the demand is worth over what a sequence can be worth.
    """
    used: dict[tuple, float] = {}
    covered, bound = np.zeros(len(sizes)), 0.0
    while True:
        live = np.flatnonzero(covered < 1 - TINY)
        if not len(live):
            return used, bound
        mine, wanted, done = sizes[live], demand[live], covered[live]
        level = np.floor(done / STEP + TINY)
        level -= level.min()
        prices = mine * np.exp(-level)
        best = best_prices(mine, prices, capacity)
        bound = max(bound, float(prices @ wanted) / best[capacity])
        value = prices + best[capacity - mine]
        behind = np.flatnonzero(level == 0)
        # The best first; of equally good ones the longest, which few others can hold.
        behind = behind[np.lexsort((-behind, -value[behind]))]
        most = np.minimum(np.maximum(STEP, 1 / wanted), 1 - done)
        left = most * wanted
        usable = left > TINY * wanted
        for first in behind.tolist():
            if not usable[first]:
                continue
            config = filling(
                mine, prices, best, capacity - int(mine[first]), {first: 1}, usable
            )
            items = np.array(list(config), int)
            numbers = np.array(list(config.values()))
            if prices[items] @ numbers < (1 - NEAR) * value[first]:
                continue  # what it lacks has had its step: next round
            numbers = np.minimum(numbers, wanted[items])
            times = float((left[items] / numbers).min())
            left[items] -= times * numbers
            usable[items] = left[items] > TINY * wanted[items]
            key = tuple(sorted(zip(live[items].tolist(), numbers.tolist(), strict=True)))
            used[key] = used.get(key, 0.0) + times
        covered[live] = done + most - left / wanted


def configurations(
    sizes: np.ndarray, demand: np.ndarray, capacity: int
) -> list[tuple[dict[int, int], int]]:
    """Configurations (numbers by index of size) and how often each is used.

    Together they hold each size exactly as often as demanded.
    """
    used, _ = solve(sizes, demand, capacity)
    return rounded(used, sizes, demand, capacity)[0]


def rounded(
    used: dict[tuple, float], sizes: np.ndarray, demand: np.ndarray, capacity: int
) -> tuple[list[tuple[dict[int, int], int]], int]:
    """Whole numbers of configurations, and how many of the first the program gave.

    What the fractions leave is filled largest first.
    """
    left, plan = demand.copy(), []

    def take(config: dict[int, int], most: float) -> None:
        items = np.array(list(config), int)
        numbers = np.array(list(config.values()))
        times = int(min(most, (left[items] // numbers).min()))
        if times > 0:
            left[items] -= times * numbers
            plan.append((config, times))

    for key, x in sorted(used.items(), key=lambda kv: -kv[1]):
        take(dict(key), np.floor(x + TINY))
    placed = len(plan)
    while left.any():
        config: dict[int, int] = {}
        room = capacity
        open_ = np.flatnonzero(left)
        while at := int(np.searchsorted(sizes[open_], room, side="right")):
            i = int(open_[at - 1])
            n = min(room // int(sizes[i]), int(left[i]))
            config[i] = n
            room -= n * int(sizes[i])
            open_ = open_[: at - 1]
        take(config, np.inf)
    return plan, placed


def placement(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Where the pieces of each length go: rows (length, rank, sequence, offset).

    A row says that pieces of that length from that rank on, up to the next row, go to
    the sequences from that one on, each at that offset.
    """
    rows: list[tuple[int, int, int, int]] = []
    counts = {n: k for n, k in counts.items() if k}
    sequence = counts.pop(capacity, 0)
    if sequence:
        rows.append((capacity, 0, 0, 0))
    lengths = np.array(sorted(counts), int)
    grain = min(GRAIN, capacity) if capacity % GRAIN == 0 else 1
    classes = -(-lengths // grain)
    sizes, of = np.unique(classes, return_inverse=True)
    number = np.array([counts[n] for n in lengths.tolist()], np.int64)
    demand = np.zeros(len(sizes), np.int64)
    np.add.at(demand, of, number)
    # The ranks of a class run through its lengths, the longest first.
    first = np.zeros(len(lengths), np.int64)
    spans: list[tuple[list[int], list[int]]] = []
    for k in range(len(sizes)):
        mine = np.flatnonzero(of == k)[::-1]
        first[mine] = np.cumsum(number[mine]) - number[mine]
        spans.append((first[mine].tolist() + [int(demand[k])], mine.tolist()))
    reached = [0] * len(sizes)
    for config, times in configurations(sizes, demand, capacity // grain):
        slots = []
        for k, a in config.items():
            slots += [(k, reached[k] + j * times) for j in range(a)]
            reached[k] += a * times
        breaks = {0, times}
        for k, at in slots:
            breaks |= {s - at for s in spans[k][0] if 0 < s - at < times}
        stops = sorted(breaks)
        for i in stops[:-1]:
            offset = 0
            for k, at in slots:
                starts, mine = spans[k]
                j = int(np.searchsorted(starts, at + i, side="right")) - 1
                n = mine[j]
                rows.append((int(lengths[n]), at + i - starts[j], sequence + i, offset))
                offset += int(lengths[n])
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, definition: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    spark = session(docs.sparkSession)
    cut = written(pieces(docs, definition, capacity), "packing-pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    parts = min(max(64, sum(counts.values()) >> 18), 1 << 16)
    table = placement(counts, capacity)
    sent = spark.sparkContext.broadcast(table)
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("length", "part").agg(F.count("*").alias("n")).select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start")
    ranked = (
        dealt.withColumn("nth", F.row_number().over(order))
        .join(offsets, ["length", "part"])
        .select(*cut.columns, (F.col("earlier") + F.col("nth") - 1).alias("rank"))
    )

    def place(batches):
        where = sent.value
        key = (where[:, 0] << 48) + where[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = np.searchsorted(key, (length << 48) + rank, side="right") - 1
            sequence = where[row, 2] + rank - where[row, 1]
            columns = batch.columns[:-1] + [pa.array(sequence), pa.array(where[row, 3])]
            yield pa.RecordBatch.from_arrays(
                columns, batch.schema.names[:-1] + ["sequence_id", "offset"]
            )

    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")


def tokenizer_definition(path: str) -> str:
    """The tokenizer file's content; it travels to the executors with the job."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def pack_documents(spark: SparkSession, docs: DataFrame, path: str | None = None) -> DataFrame:
    """``pack`` with the public tokenizer, or the one in ``path``."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return pack(docs, tokenizer_definition(path))
