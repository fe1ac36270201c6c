"""Language identification: sparse multinomial logistic regression on character n-grams.

A text's features are its lower-cased character 1- to 3-grams, hashed into ``BUCKETS``,
with weights (1 + log count) * idf, scaled to length 1. The document frequencies behind
idf are counted over every document that may be learned from. Training is follow the
regularised leader with an elastic-net penalty (L1 makes weights exactly zero, L2 keeps
them small) in numpy, on the driver, on at most ``PER_LANG`` documents of each language and
``MAX_SAMPLE`` in all; a temperature, found on a part of them that training did not see,
calibrates the probabilities.

Learned from: text and lang of documents with a lang and crc32(id) mod 5 not 0. A
prediction depends on the text alone: a learned language, or ``und`` where the text is null
or has no letter, with score 1. With nothing to learn from, everything is ``und`` with
score 0 unless it has no letter. Ties go to the language first in order. Repeated rows are
predicted each. Other columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import blocks, held_out, session, text_of

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
PER_LANG, MAX_SAMPLE = 1000, 8000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
EPOCHS = 3
PIECE = 1 << 20


def counts(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur in the text, in pieces of bounded size."""
    total = np.zeros(BUCKETS, np.int64)
    text = text.lower()
    for at in range(0, max(len(text), 1), PIECE):
        # Pieces overlap so that every n-gram lies in one, and is counted where it begins.
        points = np.frombuffer(
            text[at : at + PIECE + max(ORDERS) - 1].encode("utf-32-le", "surrogatepass"), np.uint32
        )
        begin = min(PIECE, len(text) - at)
        h = np.zeros(begin, np.uint32)
        for order in range(1, max(ORDERS) + 1):
            n = min(begin, len(points) - order + 1)
            if n <= 0:
                break
            h = (h[:n] ^ points[order - 1 : order - 1 + n]) * np.uint32(0x9E3779B1)
            if order in ORDERS:
                spread = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77)
                total += np.bincount(spread >> np.uint32(17), minlength=BUCKETS)
    return total


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of a text."""
    n = counts(text)
    at = np.flatnonzero(n)
    value = (1 + np.log(n[at])) * idf[at]
    norm = np.sqrt((value**2).sum())
    return at, value / norm if norm else value


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages, then the intercepts as the last row
    temperature: float = 1.0


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(examples: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int) -> np.ndarray:
    """FTRL-proximal: weights follow from the summed gradients z and squared ones n."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))

    def weights(at):
        over = np.maximum(np.abs(z[at]) - L1, 0) * np.sign(z[at])
        return -over / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    rng = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            at, value = examples[i]
            at, value = np.append(at, BUCKETS), np.append(value, 0.1)
            w = weights(at)
            error = softmax(value @ w)
            error[y[i]] -= 1
            g = value[:, None] * error
            root = np.sqrt(n[at])
            n[at] += g**2
            z[at] += g - (np.sqrt(n[at]) - root) / ALPHA * w
    return weights(slice(None))


def logits(model: Model, example: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    at, value = example
    return value @ model.weights[at] + 0.1 * model.weights[BUCKETS]


def calibrate(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the smallest log loss, by search over a fixed grid.

    Labels are smoothed by one example in all: n right answers do not prove certainty.
    """
    if not len(y):
        return 1.0
    target = np.full(z.shape, 1 / (len(y) + 2) / z.shape[1])
    target[np.arange(len(y)), y] += 1 - 1 / (len(y) + 2)
    grid = np.exp(np.linspace(np.log(0.02), np.log(10), 120))
    loss = [-(target * np.log(np.maximum(softmax(z / t), 1e-12))).sum() for t in grid]
    return float(grid[int(np.argmin(loss))])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts: all of them count."""

    def run(batches):
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in blocks(batches, "text"):
            for text in batch.column("text").to_pylist():
                total += counts(text) > 0
                n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(BUCKETS), -1)), pa.array(np.append(total, n))],
            ["bucket", "df"],
        )

    rows = (
        docs.select("text")
        .mapInArrow(run, "bucket long, df long")
        .groupBy("bucket")
        .agg(F.sum("df").alias("df"))
        .toPandas()  # BUCKETS + 1 rows
    )
    df = np.zeros(BUCKETS + 1, np.int64)
    df[rows["bucket"].to_numpy()] = rows["df"].to_numpy()
    return df[:BUCKETS], int(df[BUCKETS])


def sample(docs: DataFrame) -> DataFrame:
    """Bounded ids and languages: the first by hash of each language, cut in two steps."""
    h = F.xxhash64(F.lit("sample"), "doc_id")
    ids = docs.select("doc_id", "lang", h.alias("h"), F.pmod(h, F.lit(64)).alias("part"))
    near = Window.partitionBy("lang", "part").orderBy("h", "doc_id")
    far = Window.partitionBy("lang").orderBy("h", "doc_id")
    return (
        ids.withColumn("nth", F.row_number().over(near))
        .where(f"nth <= {PER_LANG}")
        .withColumn("nth", F.row_number().over(far))
        .where(f"nth <= {PER_LANG}")
        .orderBy("nth", "h", "doc_id", "lang")
        .limit(MAX_SAMPLE)
        .select("doc_id", "lang")
    )


def train(docs: DataFrame) -> Model:
    usable = docs.where("lang is not null and doc_id is not null").where(~held_out()).select(
        "doc_id", F.col("lang").cast("string").alias("lang"), text_of().alias("text")
    )
    df, total = document_frequencies(usable)
    idf = np.log((1 + total) / (1 + df)) + 1
    sent = docs.sparkSession.sparkContext.broadcast(idf)

    def run(batches):
        weights = sent.value
        for batch in blocks(batches, "text"):
            pairs = [features(t, weights) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("lang"),
                    batch.column("apart"),
                    pa.array([a.astype(np.int32).tobytes() for a, _ in pairs], pa.binary()),
                    pa.array([v.astype(np.float32).tobytes() for _, v in pairs], pa.binary()),
                ],
                ["doc_id", "lang", "apart", "at", "value"],
            )

    chosen = F.broadcast(sample(usable).distinct())  # at most MAX_SAMPLE rows
    rows = (
        usable.join(chosen, ["doc_id", "lang"])
        .select("doc_id", "lang", (F.crc32(F.col("doc_id").cast("string")) % 5 == 1).alias("apart"), "text")
        .mapInArrow(run, "doc_id long, lang string, apart boolean, at binary, value binary")
        .collect()
    )
    rows = sorted({(r["doc_id"], r["lang"]): r for r in rows}.values(), key=lambda r: (r["doc_id"], r["lang"]))
    langs = sorted({r["lang"] for r in rows})
    examples = [
        (np.frombuffer(r["at"], np.int32), np.frombuffer(r["value"], np.float32).astype(float)) for r in rows
    ]
    y = np.array([langs.index(r["lang"]) for r in rows], int)
    apart = np.array([r["apart"] for r in rows], bool)
    if not apart.any() or set(y[~apart].tolist()) != set(y.tolist()):
        apart[:] = False
    mine, others = np.flatnonzero(~apart), np.flatnonzero(apart)
    model = Model(langs, idf, fit([examples[i] for i in mine], y[mine], max(len(langs), 1)))
    if len(others):
        model.temperature = calibrate(np.stack([logits(model, examples[i]) for i in others]), y[others])
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score: one row per document."""
    spark = session(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        fitted = sent.value
        for batch in blocks(batches, "text"):
            langs, best = [], []
            letters = batch.column("letters").to_pylist()
            for text, some in zip(batch.column("text").to_pylist(), letters, strict=True):
                if not some or not fitted.langs:
                    langs.append("und")
                    best.append(0.0 if some else 1.0)
                    continue
                p = softmax(logits(fitted, features(text, fitted.idf)) / fitted.temperature)
                langs.append(fitted.langs[int(p.argmax())])
                best.append(float(p.max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(best, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
        text_of().rlike(r"\p{L}").alias("letters"),
    )
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
