"""Classifiers on held-out rows, packing against the tokenizer, and the pipeline."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from rivulet.llm import common, langid, lines, mixing, ngram, packing, toxicity

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
DOCS = "doc_id long, text string, lang string, source string, score string"


def apart(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def ids_of(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return toxicity.word_ids(common.word_hashes(raw, np.array([0, len(raw)]))[0])


def made_up(n, seed):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(1, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                text[rng.randrange(len(text))] = rng.choice(["vile", "awful"])
        rows.append((i, " ".join(text), rng.choice(["en", "de", None]), "s", "x", int(toxic)))
    return rows


# Toxicity


def test_pooling_is_the_maximum_over_every_window(monkeypatch):
    rng = np.random.default_rng(1)
    texts = ["a b c d e f", "", "one", "two words", " ".join(f"w{i}" for i in range(500)), ""]
    model = toxicity.Model(
        rng.normal(size=(2 << toxicity.BITS, toxicity.DIM)).astype(np.float32),
        rng.normal(size=(2 * toxicity.DIM, len(toxicity.SPANS) * toxicity.FILTERS)).astype(np.float32),
        rng.normal(size=len(toxicity.WIDTHS) * toxicity.FILTERS).astype(np.float32),
        rng.normal(size=len(toxicity.WIDTHS) * toxicity.FILTERS),
        0.1,
    )
    ids = [ids_of(t) for t in texts]
    want = np.zeros((len(texts), len(toxicity.WIDTHS) * toxicity.FILTERS))
    for n, some in enumerate(ids):
        x = np.concatenate([model.embed[some[:, 0]], model.embed[some[:, 1]]], axis=1)
        for at, width in enumerate(toxicity.WIDTHS):
            best = np.zeros(toxicity.FILTERS) if not len(x) else np.full(toxicity.FILTERS, -np.inf)
            for i in range(len(x)):
                total = np.zeros(toxicity.FILTERS)
                for j in range(width):
                    if i + j < len(x):
                        s = toxicity.SPANS.index((width, j)) * toxicity.FILTERS
                        total += x[i + j] @ model.filters[:, s : s + toxicity.FILTERS]
                best = np.maximum(best, total)
            want[n, at * toxicity.FILTERS : (at + 1) * toxicity.FILTERS] = best
    ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
    for chunk in (1 << 16, 5, 1):
        monkeypatch.setattr(toxicity, "CHUNK", chunk)
        got = toxicity.pooled(model, np.concatenate(ids), ends) - model.bias
        assert np.allclose(got, want, atol=1e-4)


def test_held_out_texts_are_told_apart(spark):
    rows = made_up(900, 2)
    docs = spark.createDataFrame([r[:5] for r in rows], DOCS)
    labels = spark.createDataFrame(
        [(r[0], r[5]) for r in rows] + [(1, None), (None, 1)], "doc_id long, toxic int"
    )
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.decide(toxicity.score(docs, model), model).collect()}
    right = [got[r[0]].predicted == r[5] for r in rows if apart(r[0])]
    assert len(got) == len(rows) and np.mean(right) > 0.95
    # Other ids, languages and sources change no score.
    moved = docs.select((F.col("doc_id") + 10_000).alias("doc_id"), "text", F.lit("fr").alias("lang"), F.lit("t").alias("source"))
    assert {r.doc_id - 10_000: r.score for r in toxicity.score(moved, model).collect()} == {
        i: r.score for i, r in got.items()
    }
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.toxic}
    # Labels of held-out rows teach nothing: turned round, they leave the model as it is.
    turned = labels.withColumn("toxic", F.when(common.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, turned).intercept == model.intercept


def test_nulls_empty_tables_and_labels_of_one_kind(spark):
    docs = spark.createDataFrame([(1, None, None, None, "x"), (None, "", "en", "s", "x"), (2, "w " * 50_000, "en", "s", "x"), (2, "w", "en", "s", "x")], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.decide(toxicity.score(docs, toxicity.train(docs, none)), toxicity.train(docs, none)).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.0, 0)] * 4
    some = spark.createDataFrame([(i, 1) for i in range(1, 9)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, some)).collect()} == {1.0}
    assert toxicity.without_toxic(docs.limit(0), some).collect() == []


def test_shorter_runs_of_unknown_words_leave_every_maximum(monkeypatch):
    rng = np.random.default_rng(3)
    n_filters = len(toxicity.WIDTHS) * toxicity.FILTERS
    embed = rng.normal(size=(6, toxicity.DIM)).astype(np.float32)
    embed[0] = 0
    filters = rng.normal(size=(2 * toxicity.DIM, len(toxicity.SPANS) * toxicity.FILTERS)).astype(np.float32)
    model = toxicity.Model(embed, filters, np.zeros(n_filters, np.float32), np.zeros(n_filters), 0.0)
    sizes = [0, 1, 3, 4, 9, 200, 0, 5]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    words = rng.integers(1, 6, (ends[-1], 2)).astype(np.int32) * (rng.random(ends[-1]) < 0.2)[:, None].astype(np.int32)
    short, cut = toxicity.shortened(words, ends)
    assert len(short) < len(words) and len(cut) == len(ends)
    assert np.allclose(toxicity.pooled(model, short, cut), toxicity.pooled(model, words, ends), atol=1e-5)


def test_every_text_that_may_be_learned_is(spark, monkeypatch):
    """More texts than the old sample had: all are counted and trained on, over several tasks."""
    n = 9000
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("some words here "), F.when(F.col("id") % 3 == 0, "vile").otherwise("fine")).alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit("x").alias("score"),
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    counted, trained, start, averaged = [], [], toxicity.start, toxicity._averaged
    monkeypatch.setattr(toxicity, "start", lambda df, n: counted.append(n) or start(df, n))
    monkeypatch.setattr(toxicity, "PART_ROWS", 3000)
    monkeypatch.setattr(toxicity, "ROUNDS", 2)
    monkeypatch.setattr(
        toxicity, "_averaged", lambda rows, *more: trained.extend(r.doc_id for r in rows.collect()) or averaged(rows, *more)
    )
    model = toxicity.train(docs, labels)
    learnable = [i for i in range(n) if zlib.crc32(str(i).encode()) % 5 > 1]
    assert counted[0].tolist() == [sum(i % 3 > 0 for i in learnable), sum(i % 3 == 0 for i in learnable)]
    assert sorted(trained) == learnable
    got = toxicity.decide(toxicity.score(docs, model), model)
    assert got.where((F.col("doc_id") % 3 == 0) != F.col("toxic")).count() == 0
    assert set(model.thresholds) == {"en"}


# Language


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = entry.queries()["op4_language_id"](spark, SF_DIR).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r.lang_pred == r.lang for r in got if r.held_out]
    assert len(got) == docs.count() and all(r.held_out == apart(r.doc_id) for r in got)
    assert np.mean(held) > 0.95 and all(0 <= r.score <= 1 for r in got)


def test_counts_do_not_depend_on_pieces(monkeypatch):
    text = "Straße Été 中文 😀 " * 30
    want = langid.counts(text)
    n = len(text.lower())
    assert want.sum() == 3 * n - 3 and langid.counts("").sum() == 0 and langid.counts("a").sum() == 1
    monkeypatch.setattr(langid, "PIECE", 7)
    assert (langid.counts(text) == want).all()


def test_texts_without_letters_and_languages_without_examples(spark):
    rows = [(i, t, x, "s", "x") for i, (t, x) in enumerate([("hola que tal", "es"), ("hello there you", "en")] * 30)]
    rows += [(1000, None, "en", "s", "x"), (1001, "12 !?", "en", "s", "x"), (1002, "", None, "s", "x"), (None, "hola", "es", "s", "x"), (3, "hello", None, None, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs.where("doc_id >= 1000 or doc_id is null"), langid.train(docs)).collect()}
    assert got == {1000: "und", 1001: "und", 1002: "und", None: "es"}
    none = langid.train(docs.limit(0))
    assert [(r.lang_pred, r.score) for r in langid.predict(docs.where("doc_id in (0, 1001)"), none).orderBy("doc_id").collect()] == [("und", 0.0), ("und", 1.0)]
    assert langid.predict(docs.limit(0), none).collect() == []


# Packing


@pytest.fixture(scope="module")
def definition():
    import public_tokenizers

    return packing.tokenizer_definition(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_are_the_tokenizers(definition, monkeypatch):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    texts = [
        "don't x's Y'all <|endoftext|>hi <|ENDOFTEXT|> İstanbul H̱ T̈x İ naïve 12,5 a.b a.. 中文字",
        "", " \n", "\x1c z\x85q ​ ﬀ Σας ς. é. é É.", "ab'S. CAN'T! it's. ’s x’s", "x" * 3000, "a\xa0b a b. C.",
    ]
    monkeypatch.setattr(packing, "KNOWN_WORDS", 5)
    encoder = packing.Encoder(definition)
    for some in (texts, texts[::-1], [" ".join(texts)]):
        for text, raw in zip(some, encoder.encode([t.encode() for t in some]), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    whole = ("word more " * 40).encode()
    monkeypatch.setattr(packing, "PART", 16)
    assert b"".join(packing._parts(whole)) == whole and len(list(packing._parts(whole))) > 20


def test_knapsack_is_optimal():
    rng = random.Random(3)
    for _ in range(30):
        sizes = np.array(sorted(rng.sample(range(1, 20), 5)))
        prices = np.array([rng.random() for _ in sizes])
        taken = packing.knapsack(sizes, prices, 23)
        best = np.zeros(24)
        for c in range(1, 24):
            best[c] = max([best[c - 1], *(best[c - s] + p for s, p in zip(sizes, prices, strict=True) if s <= c)])
        assert sum(sizes[i] * n for i, n in taken.items()) <= 23
        assert sum(prices[i] * n for i, n in taken.items()) == pytest.approx(best[23])


@pytest.mark.parametrize("capacity", [16, 37])
def test_pieces_lie_gapless_in_few_sequences(spark, definition, capacity):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    texts = [" ".join(rng.choice(["alpha", "be", "gamma9", "x"]) for _ in range(rng.choice([0, 1, 3, 7, 40, 150]))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (7, texts[7]), (None, "alone")] + [(1000 + i, "same same") for i in range(200)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, length int")
    got = packing.pack(docs, definition, capacity).collect()
    tokenizer = Tokenizer.from_str(definition)
    want, total = [], 0
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        total += len(ids)
        for n, at in enumerate(range(0, len(ids), capacity)):
            some = np.array(ids[at : at + capacity], "<u4")
            want.append((i, n, at, len(some), zlib.crc32(some.tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= 1.15 * -(-total // capacity)


@pytest.mark.parametrize(
    "counts, sequences",
    [({1: 4096 * 5}, 5), ({1365: 300}, 100), ({819: 500}, 100), ({2049: 70, 2047: 70}, 70), ({4095: 9, 1: 9}, 9)],
)
def test_room_is_not_lost_to_rounding(counts, sequences):
    used = {}
    table = packing.placement(counts).tolist()
    for at, (length, rank, first, offset) in enumerate(table):
        more = at + 1 < len(table) and table[at + 1][0] == length
        for i in range((table[at + 1][1] if more else counts[length]) - rank):
            used.setdefault(first + i, []).append((offset, length))
    assert sum(map(len, used.values())) == sum(counts.values()) and len(used) == sequences
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_packing_of_an_empty_table(spark, definition):
    assert packing.pack(spark.createDataFrame([], DOCS), definition).collect() == []


def test_batches_are_cut_by_bytes_and_sliced_right():
    batch = pa.RecordBatch.from_pydict({"text": ["aa", "", "b" * 50, "c", "d"], "n": [1, 2, 3, 4, 5]}).slice(1)
    parts = list(common.blocks([batch], "text", 10))
    assert [p.column("n").to_pylist() for p in parts] == [[2], [3], [4, 5]]
    assert [bytes(common.buffers(p.column("text"))[0]) for p in parts] == [b"", b"b" * 50, b"cd"]


# The pipeline


def test_every_stage_does_what_its_operator_says(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources", "best-fit packing"]
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(common.written(stage(spark, frames[-1], SF_DIR), f"test-{name.replace(' ', '-')}"))
        if name != "best-fit packing":
            assert frames[-1].columns == docs.columns
    clean, cut, single, mixed, packed = frames[1:]
    scores = toxicity.decide(toxicity.score(docs, model := toxicity.train(docs, labels)), model)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in scores.where("not toxic").collect()}
    assert cut.count() == clean.count() and cut.where("n_chars <> length(text)").count() == 0
    assert lines.line_dedup(cut).agg(F.sum("n_dropped")).first()[0] == 0
    groups = ngram.jaccard_components(cut).collect()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in groups}
    copies = {r.doc_id: r.copies for r in mixing.mix(single).collect() if r.copies}
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert times == copies
    assert packed.where("piece = 0").count() == mixed.count()


@pytest.mark.parametrize("kind", ["all lengths", "long", "middle", "two halves"])
def test_the_program_places_nearly_all_near_its_bound(kind):
    rng = np.random.default_rng(1)
    sizes, demand, gap = {
        "all lengths": (np.arange(1, 4096), rng.integers(2000, 8000, 4095), 0.013),
        "long": (np.arange(1500, 2700), rng.integers(100, 800, 1200), 0.15),
        "middle": (np.arange(900, 1800), rng.integers(1, 800, 900), 0.02),
        "two halves": (np.array([2047, 2049]), np.array([10000, 10000]), 0.0),
    }[kind]
    used, bound = packing.solve(sizes, demand, 4096)
    covered = np.zeros(len(sizes))
    for key, times in used.items():
        assert sum(int(sizes[i]) * n for i, n in key) <= 4096
        for i, n in key:
            covered[i] += n * times
    assert np.allclose(covered, demand)
    assert bound >= float(sizes @ demand) / 4096 - 1e-6
    _, placed = packing.rounded(used, sizes, demand, 4096)
    plan = packing.configurations(sizes, demand, 4096)
    assert sum(t for _, t in plan) <= (1 + gap) * bound + 1
    by_program, _ = packing.rounded(used, sizes, demand, 4096)
    tokens = sum(t * sum(int(sizes[i]) * n for i, n in c.items()) for c, t in by_program[:placed])
    assert tokens >= 0.9 * float(sizes @ demand)
    whole = np.zeros(len(sizes), int)
    for config, times in plan:
        for i, n in config.items():
            whole[i] += n * times
    assert (whole == demand).all()


def test_working_columns_clash_with_no_given_ones(spark):
    docs = spark.createDataFrame(
        [(1, "a line that comes twice\nb", "en", "s", "x"), (2, "a line that comes twice\nc", "en", "s", "y")],
        DOCS,
    )
    taken = ["_doc_id", "_body", "_drops", "_lines", "_source", "_to", "_salt", "_copy", "_text", "_lang",
             "_whole", "whole", "_last_slot", "__drops", "last_slot"]
    wide = docs.select("*", *[F.concat(F.lit("own "), "doc_id").alias(c) for c in taken])

    def own(df):
        rows = df.collect()
        assert all(r[c] == f"own {r['doc_id']}" for r in rows for c in taken)
        return sorted((r["doc_id"], r["text"]) for r in rows)

    assert own(lines.line_dedup(wide)) == [(1, "a line that comes twice\nb"), (2, "c")]
    for limit in (mixing.BROADCAST_BYTES, 0):
        mixed = mixing.mix(wide, broadcast_bytes=limit)
        assert len(own(mixed)) == 2
        assert set(own(mixing.repeated(mixed))) <= {(r["doc_id"], r["text"]) for r in docs.collect()}
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert len(own(toxicity.without_toxic(wide, labels))) == 2
