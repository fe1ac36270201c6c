"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word has two embeddings, looked up by two hashes of its bytes (A-Z lower-cased), so that
two words seldom share both. Words seen in too few of the texts learned from (``MIN_DOCS``,
``MIN_SHARE``) have none (zero). Filters of the widths 1, 2 and 3 run over a text's words; each filter's
maximum over the whole text goes through tanh into a logistic score.

Every text whose label may be learned is learned from. Its words are counted, and then every
text is part of training: stochastic gradient descent with Adagrad in numpy, in Spark tasks
of about ``PART_ROWS`` texts. After each of ``ROUNDS`` slices of its texts the tasks' models
are averaged, weighed by their texts, and all go on from there. Batches are half toxic: the
texts of the rarer kind come up again until all of the other kind have. Few texts are one
task, which goes over them until it has made ``STEPS`` steps. The intercept is then moved to
the share of toxic texts among all such labels.

Scores depend on the text alone. A threshold per language, calibrated on all texts of a part
that training did not see (if that has enough toxic texts), turns a score into a decision: the best F measure that
counts precision double, half-way to the next lower score; 0.5 for languages with few
examples, others and null.

Learned from: labels of documents whose crc32(id) mod 5 is not 0. Several labels of one
id count as their maximum; null labels count not at all. Null and empty texts get the score
of a text without words. With no labels, or of one kind only, every score is the share of
toxic labels (0 without labels). Repeated rows are counted and scored each; equal ones are
trained on once, different texts of one id each. Other columns stay as they
are. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import (
    blocks,
    buffers,
    held_out,
    mix,
    session,
    text_of,
    word_hashes,
    working,
    written,
)
from rivulet.operators import ordered

PART_ROWS, ROUNDS = 8192, 8
# With more labels than these the texts are shuffled to them, and the met rows written.
BROADCAST_LABELS = 1_000_000
BITS, DIM = 17, 8
WIDTHS, FILTERS = (1, 2, 3), 8
MIN_DOCS, MIN_SHARE, MIN_Z = 3, 0.002, 3.0
LEAN = 0.5
STEPS, BATCH, RATE = 1000, 32, 0.3
CHUNK = 1 << 16
FEW = 20

# Where each (width, place) has its filters in a word's products.
SPANS = [(w, j) for w in WIDTHS for j in range(w)]


def word_ids(hashes: np.ndarray) -> np.ndarray:
    """Two embedding rows of each word; the second ones follow the first."""
    mask = np.uint64((1 << BITS) - 1)
    other = mix(hashes ^ np.uint64(0x94D049BB133111EB)) & mask
    return np.stack([hashes & mask, other + np.uint64(1 << BITS)], axis=1).astype(np.int32)


@dataclass
class Model:
    """``embed``: both tables; ``filters``: by (width, place); ``share``: if untrained."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    intercept: float
    share: float | None = None
    thresholds: dict = field(default_factory=dict)


def pooled(model: Model, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The maximum of every filter over each text's words, in chunks of words."""
    n = len(ends) - 1
    out = np.full((n, len(WIDTHS) * FILTERS), -np.inf, np.float32)
    wide = max(WIDTHS) - 1
    for at in range(0, len(ids), CHUNK):
        to = min(at + CHUNK, len(ids))
        reach = min(to + wide, len(ids))
        some = ids[at:reach]
        x = np.concatenate([model.embed[some[:, 0]], model.embed[some[:, 1]]], axis=1)
        products = x @ model.filters  # words x (spans x filters)
        lo, hi = int(np.searchsorted(ends, at, "right")) - 1, int(np.searchsorted(ends, to, "left"))
        starts = np.clip(ends[lo:hi] - at, 0, None)
        text_end = np.repeat(ends[lo + 1 : hi + 1], np.diff(np.append(starts, to - at)))
        conv = np.zeros((to - at, len(WIDTHS) * FILTERS), np.float32)
        for s, (w, j) in enumerate(SPANS):
            to_column = slice(WIDTHS.index(w) * FILTERS, (WIDTHS.index(w) + 1) * FILTERS)
            part = products[j : j + to - at, s * FILTERS : (s + 1) * FILTERS]
            inside = (np.arange(at + j, at + j + len(part)) < text_end[: len(part)])[:, None]
            conv[: len(part), to_column] += part * inside
        filled = np.flatnonzero(np.diff(np.append(starts, to - at)) > 0)
        tops = np.maximum.reduceat(conv, starts[filled], axis=0)
        out[lo + filled] = np.maximum(out[lo + filled], tops)
    out[~np.isfinite(out)] = 0
    return out + model.bias


def scores(model: Model, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if model.share is not None:
        return np.full(len(ends) - 1, model.share)
    z = np.tanh(pooled(model, ids, ends)).astype(float) @ model.weight + model.intercept
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _step(model: Model, squares: dict, texts: list[np.ndarray], y: np.ndarray, seen: np.ndarray):
    """One step of Adagrad. A filter's gradient reaches the words of its best window only."""
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ids = np.concatenate(texts)
    x = np.concatenate([model.embed[ids[:, 0]], model.embed[ids[:, 1]]], axis=1)
    products = x @ model.filters
    n_filters = len(WIDTHS) * FILTERS
    conv = np.zeros((len(ids), n_filters), np.float32)
    text_end = np.repeat(ends[1:], np.diff(ends))
    for s, (w, j) in enumerate(SPANS):
        cols = slice(WIDTHS.index(w) * FILTERS, (WIDTHS.index(w) + 1) * FILTERS)
        inside = (np.arange(j, len(ids)) < text_end[: len(ids) - j])[:, None]
        conv[: len(ids) - j, cols] += products[j:, s * FILTERS : (s + 1) * FILTERS] * inside
    best = np.stack([a + conv[a:b].argmax(axis=0) for a, b in zip(ends, ends[1:], strict=False)])
    top = np.take_along_axis(conv, best, axis=0) + model.bias
    act = np.tanh(top)
    p = 1 / (1 + np.exp(-np.clip(act @ model.weight + model.intercept, -40, 40)))
    err = (p - y) / len(y)
    back = err[:, None] * model.weight * (1 - act**2)  # texts x filters
    d_filters = np.zeros_like(model.filters)
    d_words, d_rows = [], []
    for s, (w, j) in enumerate(SPANS):
        cols = np.arange(WIDTHS.index(w) * FILTERS, (WIDTHS.index(w) + 1) * FILTERS)
        place = best[:, cols] + j
        inside = place < ends[1:, None]
        g = (back[:, cols] * inside).ravel()
        place = np.minimum(place, len(ids) - 1).ravel()
        column = np.tile(s * FILTERS + np.arange(FILTERS), len(texts))
        np.add.at(d_filters.T, column, g[:, None] * x[place])
        d_words.append(g[:, None] * model.filters.T[column])
        d_rows.append(place)
    d_x, rows = np.concatenate(d_words), np.concatenate(d_rows)
    touched, of = np.unique(ids[rows], return_inverse=True)
    of = of.reshape(-1, 2)
    d_embed = np.zeros((len(touched), DIM), np.float32)
    np.add.at(d_embed, of[:, 0], d_x[:, :DIM])
    np.add.at(d_embed, of[:, 1], d_x[:, DIM:])
    d_embed *= seen[touched][:, None]

    def move(name: str, value, grad, at=slice(None)):
        squares[name][at] += grad**2
        value[at] -= RATE * grad / np.sqrt(squares[name][at] + 1e-8)

    move("embed", model.embed, d_embed, touched)
    move("filters", model.filters, d_filters + 1e-5 * model.filters)
    move("bias", model.bias, back.sum(axis=0))
    move("weight", model.weight, act.T @ err + 1e-4 * model.weight)
    squares["intercept"] += float(err.sum()) ** 2
    model.intercept -= RATE * float(err.sum()) / np.sqrt(squares["intercept"] + 1e-8)


def telling(df: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which embeddings are learned: of words in enough texts, more or less often toxic ones.

    The shares of toxic and other texts with the word differ by ``MIN_Z`` standard errors.
    """
    share = df.sum(axis=0) / n.sum()
    error = np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n[0] + 1 / n[1]))
    z = (df[1] / n[1] - df[0] / n[0]) / error
    return (df.sum(axis=0) >= max(MIN_DOCS, MIN_SHARE * n.sum())) & (np.abs(z) >= MIN_Z)


def start(df: np.ndarray, n: np.ndarray, seed: int = 7) -> tuple[np.ndarray, Model, dict]:
    """The embeddings to learn, and the model of them that training starts from.

    ``df``: in how many other and toxic texts an embedding occurs; ``n``: how many texts.
    Row 0 of the model's table stands for all embeddings that are not learned, which are zero.
    """
    rng = np.random.default_rng(seed)
    n_filters = len(WIDTHS) * FILTERS
    learned = np.flatnonzero(telling(df, n))
    embed = np.zeros((len(learned) + 1, DIM), np.float32)
    embed[1:] = rng.normal(0, 0.1, (len(learned), DIM))
    # Words start apart by their log odds, so that rarer ones need fewer steps to tell.
    odds = np.log((df[1] + 0.5) / (n[1] + 1)) - np.log((df[0] + 0.5) / (n[0] + 1))
    embed[1:, 0] += np.clip(odds[learned] / 4, -1, 1) * LEAN
    filters = rng.normal(0, 0.3, (2 * DIM, len(SPANS) * FILTERS)).astype(np.float32)
    bias, weight = np.zeros(n_filters, np.float32), rng.normal(0, 0.3, n_filters)
    squares = {
        "embed": np.full(embed.shape, 1e-4, np.float32),
        "filters": np.full(filters.shape, 1e-2, np.float32),
        "bias": np.full(n_filters, 1e-2, np.float32),
        "weight": np.full(n_filters, 1e-2),
        "intercept": 1e-2,
    }
    return learned, Model(embed, filters, bias, weight, 0.0), squares


def descend(model: Model, squares: dict, texts: list[np.ndarray], y: np.ndarray, least: int, seed: int) -> None:
    """Train on all texts, in batches half of each kind, with ``least`` steps or more."""
    rng = np.random.default_rng(seed)
    texts = [t if len(t) else np.zeros((1, 2), np.int32) for t in texts]
    seen = np.arange(len(model.embed)) > 0
    half = BATCH // 2
    kinds = [k for k in (np.flatnonzero(y == 1), np.flatnonzero(y == 0)) if len(k)]
    steps = max(least, *[-(-len(k) // half) for k in kinds])
    turns = [
        np.concatenate([rng.permutation(k) for _ in range(-(-steps * half // len(k)))]) for k in kinds
    ]
    for i in range(steps):
        pick = np.concatenate([t[i * half : (i + 1) * half] for t in turns])
        _step(model, squares, [texts[j] for j in pick], y[pick].astype(float), seen)


def flat(model: Model, squares: dict) -> np.ndarray:
    """All numbers that training moves, in one row."""
    parts = [model.embed, model.filters, model.bias, model.weight, np.array(model.intercept)]
    return np.concatenate([np.ravel(x).astype(float) for x in [*parts, *map(np.asarray, squares.values())]])


def unflat(row: np.ndarray, model: Model, squares: dict) -> tuple[Model, dict]:
    """The model and squares of a row; those given say the shapes."""
    at = 0

    def take(like):
        nonlocal at
        like = np.asarray(like)
        at += like.size
        return row[at - like.size : at].reshape(like.shape).astype(like.dtype)

    moved = Model(*[take(x) for x in (model.embed, model.filters, model.bias, model.weight)], float(take(model.intercept)))
    more = {name: take(x) for name, x in squares.items()}
    return moved, {**more, "intercept": float(more["intercept"])}


def _counted(known: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts with each embedding and all texts, by whether they stand apart and are toxic."""

    def run(batches):
        df, n = np.zeros((4, 2 << BITS), np.int64), np.zeros(4, np.int64)
        for batch in blocks(batches, "text"):
            hashes, ends = word_hashes(*buffers(batch.column("text")))
            ids = word_ids(hashes).astype(np.int64)
            kind = np.array(batch.column("kind").to_pylist(), np.int64)
            text = np.repeat(np.arange(len(kind)), np.diff(ends))
            once = np.unique(np.concatenate([text, text]) << (BITS + 1) | np.concatenate([ids[:, 0], ids[:, 1]]))
            np.add.at(df, (kind[once >> (BITS + 1)], once & ((2 << BITS) - 1)), 1)
            n += np.bincount(kind, minlength=4)
        at = np.flatnonzero(df.any(axis=0))
        columns = [np.append(at, -1), *[np.append(df[k, at], n[k]) for k in range(4)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "c0", "c1", "c2", "c3"])

    part = known.select("kind", "text").mapInArrow(run, "id long, c0 long, c1 long, c2 long, c3 long")
    # A row per embedding, 2 << BITS of them at most, and one of all texts.
    total = part.groupBy("id").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(4)]).toArrow()
    df, n = np.zeros((4, 2 << BITS), np.int64), np.zeros(4, np.int64)
    at = total.column("id").to_numpy()
    for k in range(4):
        values = total.column(f"c{k}").to_numpy()
        df[k, at[at >= 0]] = values[at >= 0]
        n[k] = values[at < 0].sum()
    return df, n


def shortened(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of more words in a row without embeddings than a window has only so many, and where
    each text's words end: every window's value is still there."""
    blank = ~words.any(axis=1)
    at = np.arange(len(words)) - np.repeat(ends[:-1], np.diff(ends))  # place in its text
    drop = blank & (at >= max(WIDTHS))
    for back in range(1, max(WIDTHS) + 1):
        drop[back:] &= blank[:-back]
    kept = np.concatenate([[0], np.cumsum(~drop)])
    return words[~drop], kept[ends]


def _examples(known: DataFrame, learned: np.ndarray) -> DataFrame:
    """doc_id, lang, kind and ``words``: the rows of a text's words in the model's table."""
    place = np.zeros(2 << BITS, np.int32)
    place[learned] = np.arange(1, len(learned) + 1)
    sent = known.sparkSession.sparkContext.broadcast(place)
    names = ["doc_id", "lang", "kind"]

    def run(batches):
        for batch in blocks(batches, "text"):
            hashes, ends = word_hashes(*buffers(batch.column("text")))
            words, ends = shortened(sent.value[word_ids(hashes)], ends)
            flat_words = pa.ListArray.from_arrays(pa.array(2 * ends, pa.int32()), pa.array(words.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], flat_words], [*names, "words"])

    id_type = dict(known.dtypes)["doc_id"]
    rows = known.select(*names, "text").mapInArrow(run, f"doc_id {id_type}, lang string, kind int, words array<int>")
    return rows.dropDuplicates()


def _texts(words) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a column of words and where each text's end."""
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    ends = words.offsets.to_numpy().astype(np.int64)
    return words.flatten().to_numpy().reshape(-1, 2), (ends - ends[0]) // 2


def _averaged(rows: DataFrame, model: Model, squares: dict, least: int, turn: int) -> tuple[Model, dict]:
    """One round: each part's texts train the model; the average of the parts' models."""
    sent = rows.sparkSession.sparkContext.broadcast((model, squares))
    piece = 1 << 15

    def train_part(group: pa.Table) -> pa.Table:
        begun, squared = sent.value
        mine, own = unflat(flat(begun, squared), begun, squared)
        # The same order in every run.
        group = group.sort_by([("doc_id", "ascending"), ("place", "ascending")])
        pairs, ends = _texts(group.column("words"))
        texts = [pairs[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        y = group.column("kind").to_numpy() % 2
        part = group.column("part")[0].as_py()
        descend(mine, own, texts, y, least, turn * 1_000_003 + part)
        row = flat(mine, own) * len(y)
        cut = [row[i : i + piece].tobytes() for i in range(0, len(row), piece)]
        return pa.table({
            "piece": pa.array(range(len(cut)), pa.int32()),
            "part": pa.array([part] * len(cut), pa.int64()),
            "texts": pa.array([len(y)] * len(cut), pa.int64()),
            "row": pa.array(cut, pa.binary()),
        })

    def average(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        total = 0.0
        for raw in group.column("row"):
            total = total + np.frombuffer(raw.as_buffer())
        mean = total / sum(group.column("texts").to_pylist())
        return pa.table({"piece": group.column("piece").slice(0, 1), "row": pa.array([mean.tobytes()], pa.binary())})

    trained = rows.groupBy("part").applyInArrow(train_part, "piece int, part long, texts long, row binary")
    # One model in all.
    found = trained.groupBy("piece").applyInArrow(average, "piece int, row binary").collect()
    sent.unpersist()
    row = np.concatenate([np.frombuffer(r["row"]) for r in sorted(found, key=lambda r: r["piece"])])
    return unflat(row, model, squares)


def thresholds(scored: DataFrame) -> dict:
    """Per language the threshold of the best F0.5, where there are enough examples.

    ``scored``: lang, toxic, score. Equal scores are decided alike, so they are one row.
    """
    told = scored.where("lang is not null").groupBy("lang", "score").agg(
        F.sum("toxic").cast("long").alias("hits"), F.count(F.lit(1)).alias("texts")
    )
    told = written(told, "toxicity-scores")
    enough = told.groupBy("lang").agg(F.sum("hits").alias("all_hits"), F.sum("texts").alias("all_texts"))
    enough = enough.where((F.col("all_hits") >= FEW) & (F.col("all_texts") - F.col("all_hits") >= FEW))
    plan = ordered.layout(told, ["lang"], ["score"])
    down = {"above": ordered.running_sum(F.col("hits")), "taken": ordered.running_sum(F.col("texts"))}
    rows = ordered.running(told, ["lang"], ["score"], down, reverse=True, plan=plan)
    rows = ordered.running(rows, ["lang"], ["score"], {"lower": ordered.previous(F.col("score"))}, plan=plan)
    f_half = 1.25 * F.col("above") / (F.col("taken") + 0.25 * F.col("all_hits"))
    best = rows.join(enough, "lang").groupBy("lang").agg(
        F.max_by(F.struct("score", "lower"), F.struct(f_half, "score")).alias("at")
    )
    # A row per language with enough examples.
    return {r["lang"]: (r["at"]["score"] + (r["at"]["lower"] or 0.0)) / 2 for r in best.collect()}


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on all texts whose labels may be learned."""
    spark = session(docs.sparkSession)
    usable = (
        labels.where("doc_id is not null and toxic is not null")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    apart = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    texts = docs.where(~held_out()).select("doc_id", F.col("lang").cast("string").alias("lang"), text_of().alias("text"))
    few = total <= BROADCAST_LABELS
    known = texts.join(F.broadcast(usable) if few else usable, "doc_id").where("toxic in (0, 1)").withColumn(
        "kind", (F.col("toxic") + F.when(apart, 2).otherwise(0)).cast("int")
    )
    if not few:
        known = written(known, "toxicity-texts")
    df, n = _counted(known)
    calibrated = n[3] >= FEW  # else no language could be: learn from these too
    if not calibrated:
        df, n = df[:2] + df[2:], n[:2] + n[2:]
    if not n[0] or not n[1]:
        nothing = np.zeros((2 << BITS, DIM), np.float32)
        filters = np.zeros((2 * DIM, len(SPANS) * FILTERS), np.float32)
        none = np.zeros(len(WIDTHS) * FILTERS)
        return Model(nothing, filters, none.astype(np.float32), none, 0.0, share=share)
    learned, small, squares = start(df[:2], n[:2])
    examples = written(_examples(known, learned), "toxicity-examples")
    place = F.xxhash64("doc_id", "words")
    mine = (examples.where("kind < 2") if calibrated else examples).withColumn("place", place)
    parts = -(-int(n[:2].sum()) // PART_ROWS)
    rounds = ROUNDS if parts > 1 else 1
    mine = mine.withColumn("part", F.pmod("place", F.lit(parts)))
    for turn in range(rounds):
        slice_of = F.pmod(F.xxhash64("place", F.lit("round")), F.lit(rounds)) == turn
        small, squares = _averaged(mine.where(slice_of), small, squares, -(-STEPS // rounds), turn)
    # Batches are half toxic; the labels are not.
    share = min(max(share, 1e-3), 1 - 1e-3)
    small.intercept += float(np.log(share / (1 - share))) * 0.5
    model = Model(np.zeros((2 << BITS, DIM), np.float32), small.filters, small.bias, small.weight, small.intercept)
    model.embed[learned] = small.embed[1:]
    if calibrated:
        sent = spark.sparkContext.broadcast(small)

        def run(batches):
            for batch in batches:
                pairs, ends = _texts(batch.column("words"))
                values = pa.array(scores(sent.value, pairs, ends), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("kind"), values], ["lang", "kind", "score"])

        scored = examples.where("kind > 1").mapInArrow(run, "lang string, kind int, score double")
        model.thresholds = thresholds(scored.select("lang", (F.col("kind") - 2).alias("toxic"), "score"))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang, score: one row per document."""
    spark = session(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        fitted = sent.value
        for batch in blocks(batches, "text"):
            hashes, ends = word_hashes(*buffers(batch.column("text")))
            values = scores(fitted, word_ids(hashes), ends)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(values, pa.float64())],
                ["doc_id", "lang", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        text_of().alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, lang string, score double")


def decide(scored: DataFrame, model: Model) -> DataFrame:
    """Adds predicted (score of 0.5 or more), threshold (by language) and toxic."""
    limit = F.lit(0.5)
    for lang, value in model.thresholds.items():
        limit = F.when(F.col("lang") == lang, value).otherwise(limit)
    return scored.select(
        "*",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        limit.alias("threshold"),
        (F.col("score") >= limit).alias("toxic"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose texts are not toxic; all columns stay."""
    model = train(docs, labels)
    spark = session(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)
    names = docs.columns
    text, lang = working(docs, "text", "lang")

    def run(batches):
        fitted = sent.value
        for batch in blocks(batches, text):
            hashes, ends = word_hashes(*buffers(batch.column(text)))
            limit = [fitted.thresholds.get(x, 0.5) for x in batch.column(lang).to_pylist()]
            keep = scores(fitted, word_ids(hashes), ends) < np.array(limit)
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    rows = docs.select(
        *names, text_of().alias(text), F.col("lang").cast("string").alias(lang)
    )
    return rows.mapInArrow(run, docs.schema)
