"""The operators made of DataFrame functions, against plain Python."""

import hashlib
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from rivulet.llm import chat, exact, lines, mixing

LOG = "conv_id long, turn long, message_id long, seq long, kind string, role string, text string"
DOCS = "doc_id long, text string, source string, h string, slot int"
WS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], DOCS)


# Chat formatting


def test_deltas_edits_and_regenerations_fold(spark):
    log = [
        (1, 0, 10, 1, "delta", "user", "hel"),
        (1, 0, 10, 2, "delta", None, "lo"),
        (1, 1, 11, 3, "delta", "assistant", "first"),
        (1, 1, 11, 5, "delta", "assistant", "sec"),
        (1, 1, 11, 4, "regenerate", "assistant", None),
        (1, 1, 11, 6, "delta", "assistant", "ond"),
        (1, 0, 10, 9, "edit", "user", "hi"),
        (1, 0, 10, 10, None, None, "!"),
        (2, None, 12, 0, "delta", None, None),
    ]
    random.Random(1).shuffle(log)
    got = {
        (r.conv_id, r.turn): (r.role, r.text)
        for r in chat.fold_events(spark.createDataFrame(log, LOG)).collect()
    }
    assert got == {(1, 0): ("user", "hi!"), (1, 1): ("assistant", "second"), (2, None): ("", "")}


def test_texts_come_back_whatever_they_hold(spark):
    rng = random.Random(2)
    parts = ["<|im_end|>", "<|im_start|>", "assistant", "\n", "\\", "\\n", "|", "<", "<\\|", "é😀", ">", ""]
    log, n = [], 0
    for conv in range(40):
        for turn in range(rng.randrange(1, 6)):
            text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
            role = rng.choice(["user", "assistant", "a\nb", "<|im_end|>\n", "\\", ""])
            log.append((conv, turn, n, 0, "delta", role, text))
            n += 1
    rendered = chat.render(chat.fold_events(spark.createDataFrame(log, LOG)))
    out = rendered.withColumn("turns", chat.read_back(F.col("formatted"))).collect()
    digests = {r.conv_id: r for r in chat.digests(rendered).collect()}
    for r in out:
        mine = sorted((t, role, text) for c, t, _, _, _, role, text in log if c == r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in mine]
        learnt = [text for _, role, text in mine if role == "assistant"]
        spans = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
        assert spans == [t.replace("\\", "\\\\").replace("<|", "<\\|") for t in learnt]
        d = digests[r.conv_id]
        said = "".join(f"{role}\n{text}\n" for _, role, text in mine)
        assert d.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert d.loss_sha256 == hashlib.sha256("".join(learnt).encode()).hexdigest()
        assert (d.loss_chars, d.formatted_chars) == (len("".join(learnt)), len(r.formatted))


def test_equal_turns_repeated_rows_and_empty_logs(spark):
    log = [(None, 1, i, 0, "delta", "user", t) for i, t in enumerate(["b", "a", "a"])]
    got = chat.render(chat.fold_events(spark.createDataFrame(log, LOG).withColumn("piece", F.lit(1))))
    rows = got.select("conv_id", "n_turns", chat.read_back(F.col("formatted"))["text"]).collect()
    assert [tuple(r) for r in rows] == [(None, 3, ["a", "a", "b"])]
    empty = spark.createDataFrame([], LOG)
    assert chat.digests(chat.render(chat.fold_events(empty))).collect() == []


# Exact dedup


def expected_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[ \t-\r]+", " ", t or ""), []).append(i)
    out = []
    for i, t in rows:
        norm = re.sub("[ \t-\r]+", " ", t or "")
        ids = [x for x in groups[norm] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


EXACT = [
    (5, "a  b"), (3, "a\tb"), (9, "a b "), (1, None), (2, ""), (7, " "), (8, "\n\n"), (8, "\n\n"),
    (None, "a b"), (None, "only"), (4, "é" * 70_000), (6, "é" * 70_000), (10, "A B"), (11, "a\xa0b"),
]


@pytest.mark.parametrize("weak", [False, True])
def test_equal_texts_share_a_group_even_if_hashes_collide(spark, weak):
    rows = EXACT + [(100 + i, f"text {i % 60}") for i in range(200)]
    settings = {}
    if weak:
        settings = {
            "hashed": lambda norm: F.length(norm).cast("long") % 3,
            "digest": F.substring(F.sha2("norm", 256), 1, 1),
        }
    docs = docs_of(spark, [(i, t, "s") for i, t in rows])
    got = exact.dedup(docs, capacity=4, **settings).drop("bucket").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected_groups(rows)


def test_overfull_buckets_split_and_the_directory_doubles():
    top = 1 << exact.MAX_DEPTH
    depth, pointers, local = exact.directory({0: 3, 1: 3, top // 2: 1}, 4)
    assert depth == exact.MAX_DEPTH and len(pointers) == top
    assert pointers[0] != pointers[1] and len(set(pointers[top // 2 :])) == 1
    assert pointers == sorted(pointers) and local[pointers[top // 2]] == 1
    assert exact.directory({}, 4) == (0, [0], [0])
    assert exact.directory({5: 100}, 4)[0] == exact.MAX_DEPTH  # cannot be split: chained on


def test_exact_dedup_of_an_empty_table(spark):
    assert exact.dedup(docs_of(spark, [])).collect() == []


# Line dedup


def expected_lines(rows, threshold=2, min_chars=10):
    key = lambda line: line.strip(WS).translate(LOWER)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [
            x
            for x in all_lines
            if i is None
            or len(holders.get(key(x), ())) < threshold
            or min(holders[key(x)]) == i
        ]
        out.append((i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("threshold", [2, 3])
def test_lines_of_many_documents_stay_in_the_first(spark, threshold):
    rng = random.Random(3)
    pool = ["A shared LINE here", "  a shared line HERE\t", "short", "", "ÉCOLE longue ligne", "école longue ligne",
            "another common line", "0123456789", "012345678", "x" * 5000]
    rows = [(i, "\n".join(rng.choice(pool + [f"own line number {i}"]) for _ in range(rng.randrange(9)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "\n\n"), (None, "A shared LINE here"), (63, "0123456789\n" * 3), (7, "another common line")]
    rows += [(64, "another common line")] * 2
    got = lines.line_dedup(docs_of(spark, [(i, t, "s") for i, t in rows]), threshold)
    assert got.columns == ["doc_id", "text", "source", "h", "slot", "n_lines", "n_dropped"]
    got = got.select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected_lines(rows, threshold)


def test_lines_of_an_empty_table(spark):
    assert lines.line_dedup(docs_of(spark, [])).collect() == []


# Mixing


def water_fill(sizes, weights, share, most):
    """Clamp, deal out again, until nothing is above its cap."""
    budget, left = share * sum(sizes), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while left:
        rest = budget - sum(out[i] for i in range(len(sizes)) if i not in left)
        level = rest / sum(weights[i] for i in left)
        over = {i for i in left if level * weights[i] > most * sizes[i]}
        if not over:
            for i in left:
                out[i] = level * weights[i]
            return out
        for i in over:
            out[i] = most * sizes[i]
        left -= over
    return out


@pytest.mark.parametrize("share,most", [(1.5, 2.0), (0.3, 1.0), (4.0, 2.0), (1.0, 50.0)])
def test_targets_are_those_of_clamping_again_and_again(spark, share, most):
    rng = random.Random(int(share * 10))
    names = ["a", "B", "é", "b", "", "z", None, "empty"]
    rows, n = [], 0
    for s in names:
        for _ in range(rng.randrange(1, 90)):
            rows.append((n, " ".join("w" * 3 for _ in range(0 if s == "empty" else rng.randrange(60))), s))
            n += 1
    rows += [(n, None, "a"), (None, "x y", "a"), (3, rows[3][1], rows[3][2])]
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = water_fill([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], share, most)
    mixed = mixing.mix(docs_of(spark, rows), share=share, max_epochs=most)
    got = mixed.withColumn("words", mixing.word_count()).collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.target == pytest.approx(want[order.index(r.source)]) and r.source_size == sizes[r.source]
        assert 0 <= r.copies <= most
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.words
    for s, target in zip(order, want, strict=True):
        assert abs(taken[s] - target) <= 60
    assert sorted(map(repr, mixed.collect())) == sorted(
        map(repr, mixing.mix(docs_of(spark, rows[::-1]), share=share, max_epochs=most).collect())
    )
    salted = mixing.mix(docs_of(spark, rows), share=share, max_epochs=most, broadcast_bytes=0)
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, mixed.collect()))
    again = mixing.repeated(mixed)
    assert again.columns == ["doc_id", "text", "source", "h", "slot"]
    assert again.count() == sum(r.copies for r in got)


def test_mixing_of_an_empty_table_and_of_empty_texts(spark):
    assert mixing.mix(docs_of(spark, [])).collect() == []
    got = mixing.mix(docs_of(spark, [(1, None, None), (2, " ", "a")])).collect()
    assert [(r.source_size, r.target, r.copies) for r in got] == [(0, 0.0, 0)] * 2
