"""N-gram Jaccard join, embedding near-dedup and components against brute force."""

import random
import re
import string

import numpy as np
import pytest

from rivulet.llm import common, hnsw, ngram
from rivulet.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


class Sets:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, i, j):
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def expected_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    groups = Sets([i for i, _ in rows])
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if both and 100 * both >= 80 * len(a | b):
                groups.join(i, j)
    return sorted((i, len(s), groups.find(i)) for i, s in sets)


def test_words_are_hashed_alike_wherever_they_stand(monkeypatch):
    texts = ["The cat\tSAT", "", "the  cat sat ", "été École", "x" * 70_000, "a" + "x" * 70_000, "ñ\x0bÑ"]
    def hashed(some):
        raw = [t.encode() for t in some]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        h, ends = common.word_hashes(np.frombuffer(b"".join(raw), np.uint8), offsets)
        return [h[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]

    want = [hashed([t])[0] for t in texts]
    assert [len(w) for w in want] == [3, 0, 3, 2, 1, 1, 2]
    assert want[0] == want[2] and want[4] != want[5] and want[6][0] != want[6][1]
    assert hashed(texts) == want
    monkeypatch.setattr(common, "BLOCK", 7)
    assert hashed(texts) == want


def corpus(rng):
    word = lambda: rng.choice(string.ascii_lowercase) + str(rng.randrange(4000))
    rows, n = [], 0

    def add(text):
        nonlocal n
        rows.append((n * 3 + 1, text))
        n += 1

    passage = [word() for _ in range(60)]
    for _ in range(40):  # a passage many documents share
        add(" ".join([word() for _ in range(rng.randrange(10, 90))] + passage))
    for size in (3, 12, 45):  # near copies, some too far from each other
        base = [word() for _ in range(rng.randrange(60, 120))]
        for _ in range(size):
            mine = list(base)
            for _ in range(rng.randrange(4)):
                mine[rng.randrange(len(mine))] = word()
            add(" ".join(mine).upper() if rng.random() < 0.3 else "\n".join(mine))
    chain = [word() for _ in range(100)]
    for i in range(12):  # each links with the next only
        add(" ".join(chain[4 * i : 4 * i + 52]))
    exactly = [f"t{i}" for i in range(13)]  # 9 shingles, 8 shared with the next: 0.8
    add(" ".join(exactly))
    add(" ".join(exactly + ["more"]))
    add(" ".join(exactly[:-1]))
    for text in (None, "", " \n", "one", "ONE", "one two", "one two three four", "one two three four five",
                 "one two three four five", "one  two three Four five six", "été ÉTÉ", "x " * 3000):
        add(text)
    return rows


@pytest.mark.parametrize("costly", [32, 3])
def test_components_are_those_of_all_pairs(spark, monkeypatch, costly):
    monkeypatch.setattr(ngram, "COSTLY", costly)
    rows = corpus(random.Random(4))
    docs = spark.createDataFrame([(i, t, 7, "z") for i, t in rows], "doc_id long, text string, k int, token string")
    got = sorted(tuple(r) for r in ngram.jaccard_components(docs.repartition(3)).collect())
    assert got == expected_components(rows)


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(6)
    fit = out = 0
    for _ in range(400):
        n = int(rng.integers(20, 1200))
        base = rng.integers(0, 1 << 64, n, np.uint64, endpoint=False)
        sets = [base]
        for share in (0.02, 0.1, 0.2, 0.5):
            mine = base.copy()
            at = rng.choice(n, int(share * n), replace=False)
            mine[at] = rng.integers(0, 1 << 64, len(at), np.uint64, endpoint=False)
            sets.append(mine)
        rows = np.array([[0, i, len(s), -len(s), 0, *ngram.sketch(s)] for i, s in enumerate(sets)], np.int64)
        got = ngram._sketches_fit(rows[0], rows)
        bits = [sum(1 << x for x in {int(h) & 1023 for h in s}) for s in sets]
        for s, b, fits in zip(sets, bits, got.tolist(), strict=True):
            both = len(np.intersect1d(base, s))
            assert fits or ngram.DEN * both < ngram.NUM * (len(base) + len(s) - both)
            most = min(n - (bits[0] & ~b).bit_count(), len(s) - (b & ~bits[0]).bit_count())
            assert fits == (9 * most >= 4 * (n + len(s)))
            fit, out = fit + fits, out + (not fits)
    assert fit and out


def test_rows_without_id_and_repeated_rows_and_no_rows(spark):
    text = "a b c d e f g h"
    rows = [(5, text), (5, text), (9, text), (None, text), (None, "q r s"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in ngram.jaccard_components(docs).collect()), key=repr)
    want = [(5, 4, 5), (5, 4, 5), (9, 4, 5), (None, 4, 5), (None, 1, None), (3, 0, 3)]
    assert got == sorted(want, key=repr)
    assert ngram.jaccard_components(docs.limit(0)).collect() == []


X, Y, Z = (" ".join(f"{c}{i}" for i in range(30)) for c in "xyz")


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(2, Y), (5, X), (5, Y), (7, X)], [(2, Y), (5, X)]),
        ([(2, Y), (2, Y), (3, Y)], [(2, Y)]),
        ([(2, Y), (2, X), (2, Z), (4, X)], [(2, X), (2, Y), (2, Z)]),
        ([(4, X), (3, X + " more"), (9, Z)], [(3, X + " more"), (9, Z)]),
        ([(2, Y), (None, Y), (None, Y), (3, None), (3, None), (4, " ")], [(2, Y), (3, None), (3, None), (4, " "), (None, Y), (None, Y)]),
        ([], []),
    ],
)
def test_one_row_of_each_component_stays(spark, rows, want):
    names = "_gone long, doc_id long, text string, h string, row int, stay string"
    frame = spark.createDataFrame([(1, i, t, "a", 2, "b") for i, t in rows], names)
    got = ngram.keep_one(frame)
    assert got.columns == frame.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, i, t, "a", 2, "b") for i, t in want], key=repr)


def test_one_row_of_each_component_stays_by_brute_force(spark):
    rows = corpus(random.Random(9))
    kept = ngram.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted(
        ((i, t) for (i, t), (_, _, c) in zip(sorted(rows), expected_components(rows), strict=True) if i == c), key=repr
    )


def test_similar_sets_share_what_their_prefixes_ask_for():
    rng = random.Random(10)
    close = 0
    for _ in range(3000):
        n = rng.randint(1, 60)
        a = set(rng.sample(range(10_000), n))
        b = {x for x in a if rng.random() > rng.choice([0.02, 0.08])} | set(rng.sample(range(10_000), n // 15))
        if not b or ngram.DEN * len(a & b) < ngram.NUM * len(a | b):
            continue
        close += 1
        prefixes, asked = [], []
        for s in (a, b):
            p = ngram.prefix_length(len(s))
            asked.append(ngram.required(len(s), p, len(s), rng.choice([1, 3, 50])))
            assert p + asked[-1] - 1 <= len(s)
            prefixes.append(set(sorted(s)[: p + asked[-1] - 1]))
        assert len(prefixes[0] & prefixes[1]) >= min(asked)
        # A signature never has less in common than the prefixes.
        signs = [np.sort(np.array(list(p), np.uint64).astype(np.uint16) % 50) for p in prefixes]
        assert ngram.in_common(*signs) >= len(prefixes[0] & prefixes[1])
    assert close > 500
    assert ngram.in_common(np.array([1, 1, 2, 4]), np.array([1, 1, 1, 4, 5])) == 3


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7), (2000, 2001)] * 2
    rng.shuffle(links)
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = Sets({i for link in links for i in link})
    for a, b in links:
        groups.join(a, b)
    assert sorted(map(tuple, found)) == [(i, groups.find(i)) for i in sorted(groups.up)]
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_graph_search_recalls_dense_and_sparse_neighbours():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 24))
    dense = centres[:2].repeat(300, axis=0) + rng.normal(size=(600, 24)) * 0.06
    x = hnsw.unit(np.concatenate([dense, centres.repeat(4, axis=0) + rng.normal(size=(120, 24)) * 0.1, rng.normal(size=(900, 24))]))
    graph, order = hnsw.Graph.build(x)
    pairs = hnsw.audited(graph, x[order].astype(np.float32), 0.98)
    true = x[order] @ x[order].T >= 0.98
    found = np.zeros_like(true)
    found[pairs[:, 0], pairs[:, 1]] = True
    assert (true & found).sum() >= 0.99 * true.sum()


@pytest.mark.parametrize("shard", [8192, 40])
def test_links_and_components_of_vectors(spark, shard):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16)).astype(np.float32)
    rows = []
    for n in range(260):
        v = centres[rng.integers(12)] * np.float32(rng.choice([1, 1e-3, 50]))
        if rng.random() < 0.6:
            v = v + rng.normal(size=16).astype(np.float32) * np.float32(0.05) * np.abs(v).mean()
        rows.append((n * 2 + 1, [float(e) for e in v], int(rng.integers(2))))
    rows += [(n, rows[0][1], rows[0][2]) for n in (0, 600, 600, 602)]
    bad = [(700, None, 1), (701, [0.0] * 16, 1), (702, [float("nan")] + [1.0] * 15, 1), (703, [], 0),
           (704, [None] + [1.0] * 15, 0), (705, rows[0][1], None), (706, [float("inf")] * 16, 0), (None, rows[0][1], 0),
           (707, [1.0, 2.0], 0), (708, [1.0, 2.0], 0)]
    frame = spark.createDataFrame(
        [(i, v, label, "x") for i, v, label in rows + bad], "vec_id long, embedding array<float>, label int, vector string"
    )
    got = sorted((tuple(r) for r in hnsw.near_duplicates(frame, shard_size=shard).collect()), key=repr)
    x = hnsw.unit(np.array([v for _, v, _ in rows], np.float32).astype(float))
    label = np.array([c for _, _, c in rows])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    groups = Sets([i for i, _, _ in rows])
    for a, b in zip(*np.nonzero(near), strict=True):
        groups.join(rows[a][0], rows[b][0])
    want = [(i, int(near[n].sum()), groups.find(i), groups.find(i) == i) for n, (i, _, _) in enumerate(rows)]
    want += [(i, 0, i, True) for i in (700, 701, 702, 703, 704, 705, 706)] + [(None, 0, None, None)]
    want += [(707, 1, 707, True), (708, 1, 707, False)]
    assert got == sorted(want, key=repr)
    assert hnsw.near_duplicates(frame.limit(0)).collect() == []
