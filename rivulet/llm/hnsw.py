"""Embedding near-dedup: hierarchical navigable small-world graphs, one per shard.

Vectors of one label (and dimension) are dealt into shards of at most about ``SHARD`` by a
hash. Each shard becomes a graph, written to shared files; every shard of a label queries
every shard of it, a pair of shards per task. A query descends the graph's levels, then
searches its ground level with a beam. Beams widen in two ways: a query whose beam is half
full of vectors within reach is asked again with a wider one, and all of a task's queries
are, until an audit (queries compared with all vectors of the shard) recalls
``RECALL`` of the true links. Pairs found are verified by cosine in double precision.

Equal vectors of a label are one vertex with a count, so a vector with a third of all rows
is one. Of its links a task returns numbers per vertex and a spanning forest, not pairs;
forests are united into components.

Vectors without id or label, empty or zero ones, and those with null, NaN or infinite
components link with nothing: n_links 0, component_id their own id (null without id), kept
(null without id). Repeated rows are vectors of their own that link with each other.
Vectors of different dimensions do not link. Other columns are left out. An empty table
gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import session, written
from rivulet.llm.components import connected_components

COSINE = 0.98
SHARD = 8192
LINKS = 16
BUILD_BEAM, BEAM = 64, 48
BATCH = 256
AUDITED, RECALL = 64, 0.995
SLACK = 1e-5


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, whatever their scale."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def beam_search(
    x: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` best vertices found for each query, all queries in step.

    Every step expands the best vertices of each beam that are not expanded yet; several
    at once in wide beams. Returns vertices (-1: none) and similarities.
    """
    q, at_once = len(queries), 1 if width < 128 else 8
    rows = np.arange(q)
    seen = np.zeros((q, n), bool)
    ids = np.full((q, width), -1)
    sims = np.full((q, width), -np.inf, np.float32)
    done = np.ones((q, width), bool)
    ids[:, 0], done[:, 0] = entry, False
    sims[:, 0] = np.einsum("qd,qd->q", queries, x[entry])
    seen[rows, entry] = True
    while len(rows):
        ready = np.where(done[rows], -np.inf, sims[rows])
        if at_once == 1:
            best = ready.argmax(axis=1)[:, None]
        else:
            best = np.argpartition(-ready, at_once - 1, axis=1)[:, :at_once]
        real = np.take_along_axis(ready, best, axis=1) > -np.inf
        some = real.any(axis=1)
        rows, best, real = rows[some], best[some], real[some]
        if not len(rows):
            break
        done[rows[:, None], best] = True
        near = links[ids[rows[:, None], best]]
        near = np.where(real[:, :, None], near, -1).reshape(len(rows), -1)
        if at_once > 1:
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        fresh = (near >= 0) & ~seen[rows[:, None], near]
        r, c = np.nonzero(fresh)
        seen[rows[r], near[r, c]] = True
        new = np.full(near.shape, -np.inf, np.float32)
        new[r, c] = np.einsum("nd,nd->n", queries[rows[r]], x[near[r, c]])
        all_sims = np.concatenate([sims[rows], new], axis=1)
        all_ids = np.concatenate([ids[rows], near], axis=1)
        all_done = np.concatenate([done[rows], ~fresh], axis=1)
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        sims[rows] = np.take_along_axis(all_sims, top, axis=1)
        ids[rows] = np.take_along_axis(all_ids, top, axis=1)
        done[rows] = np.take_along_axis(all_done, top, axis=1)
    ids[~np.isfinite(sims)] = -1
    return ids, sims


def diverse(x: np.ndarray, base: np.ndarray, candidates: np.ndarray, m: int) -> np.ndarray:
    """Up to m neighbours for each base vector: near, but nearer to it than to each other.

    Places left over go to the nearest others. -1 pads candidates and result.
    """
    sims = np.where(candidates >= 0, np.einsum("bd,bcd->bc", base, x[candidates]), -np.inf)
    order = np.argsort(-sims, axis=1, kind="stable")
    candidates = np.take_along_axis(candidates, order, axis=1)
    sims = np.take_along_axis(sims, order, axis=1)
    again = np.zeros(candidates.shape, bool)  # equal ids have equal similarity, not always side by side
    by_id = np.argsort(candidates, axis=1, kind="stable")
    sorted_ids = np.take_along_axis(candidates, by_id, axis=1)
    np.put_along_axis(again[:, :], by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], axis=1)
    usable = (candidates >= 0) & ~again
    vectors = x[candidates]
    mutual = np.matmul(vectors, vectors.transpose(0, 2, 1))
    chosen = np.zeros(candidates.shape, bool)
    closest = np.full(candidates.shape, -np.inf, np.float32)
    for k in range(candidates.shape[1]):
        take = usable[:, k] & (sims[:, k] > closest[:, k]) & (chosen.sum(axis=1) < m)
        chosen[:, k] = take
        closest = np.where(take[:, None], np.maximum(closest, mutual[:, k, :]), closest)
    rank = np.where(chosen, 0, np.where(usable, 1, 2)) * candidates.shape[1]
    first = np.argsort(rank + np.arange(candidates.shape[1]), axis=1)[:, :m]
    out = np.take_along_axis(candidates, first, axis=1)
    return np.where(np.take_along_axis(usable, first, axis=1), out, -1)


def _connect(x: np.ndarray, links: np.ndarray, new: np.ndarray, near: np.ndarray) -> None:
    """Give new vertices their neighbours and these the links back, pruned where full."""
    links[new, : near.shape[1]] = near
    u, v = near.ravel(), np.repeat(new, near.shape[1])
    u, v = u[u >= 0], v[u >= 0]
    order = np.argsort(u, kind="stable")
    u, v = u[order], v[order]
    starts = np.flatnonzero(np.append(True, u[1:] != u[:-1])) if len(u) else np.zeros(0, int)
    sizes = np.diff(np.append(starts, len(u)))
    full, extra = [], []
    for s, k in zip(starts.tolist(), sizes.tolist(), strict=True):
        at, back = u[s], v[s : s + k]
        mine = links[at]
        back = back[~np.isin(back, mine)]
        free = np.flatnonzero(mine < 0)
        mine[free[: len(back)]] = back[: len(free)]
        if len(back) > len(free):
            full.append(at)
            extra.append(back[len(free) :])
    if full:
        wide = max(map(len, extra))
        pad = np.full((len(full), wide), -1)
        for i, e in enumerate(extra):
            pad[i, : len(e)] = e
        full = np.array(full)
        for at in range(0, len(full), BATCH):
            some = full[at : at + BATCH]
            both = np.concatenate([links[some], pad[at : at + BATCH]], axis=1)
            links[some] = diverse(x, x[some], both, links.shape[1])


class Graph:
    """Levels of links over unit vectors; vertex 0 is the entry, on the highest level."""

    def __init__(self, x: np.ndarray, levels: list[np.ndarray]):
        self.x, self.levels = x, levels

    @classmethod
    def build(cls, x: np.ndarray, seed: int = 5) -> tuple[Graph, np.ndarray]:
        """The graph, and the order in which it has the given vectors."""
        rng = np.random.default_rng(seed)
        n = len(x)
        height = np.floor(-np.log(rng.random(n)) / np.log(LINKS)).astype(int)
        order = rng.permutation(n)
        top = int(height[order].argmax())
        order[[0, top]] = order[[top, 0]]
        height, x = height[order], np.ascontiguousarray(x[order], np.float32)
        levels = [
            np.full((n, 2 * LINKS if level == 0 else LINKS), -1)
            for level in range(int(height[0]) + 1)
        ]
        graph, at = cls(x, levels), 1
        while at < n:
            new = np.arange(at, min(n, at + max(1, min(BATCH, at))))
            graph._insert(new, height[new])
            at = int(new[-1]) + 1
        return graph, order

    def _insert(self, new: np.ndarray, height: np.ndarray) -> None:
        entry = np.zeros(len(new), int)
        mutual = self.x[new] @ self.x[new].T
        for level in range(len(self.levels) - 1, -1, -1):
            links = self.levels[level]
            width = BUILD_BEAM if level == 0 else 8
            ids, sims = beam_search(
                self.x, links, self.x[new], entry, width, int(new[-1]) + 1
            )
            best = np.take_along_axis(ids, sims.argmax(axis=1)[:, None], axis=1)[:, 0]
            mine = height >= level
            if mine.any():
                own = np.flatnonzero(mine)
                among = np.where(own[None, :] < own[:, None], mutual[np.ix_(own, own)], -np.inf)
                k = min(8, len(own))
                peers = np.argpartition(-among, k - 1, axis=1)[:, :k]
                peer_ids = np.where(
                    np.isfinite(np.take_along_axis(among, peers, axis=1)), new[own][peers], -1
                )
                candidates = np.concatenate([ids[own], peer_ids], axis=1)
                near = diverse(self.x, self.x[new[own]], candidates, LINKS)
                _connect(self.x, links, new[own], near)
            entry = best

    def search(self, queries: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Per batch: the queries' numbers, vertices found, similarities."""
        n = len(self.x)
        rows = max(16, min(512, (32 << 20) // max(n, width * 8)))
        for at in range(0, len(queries), rows):
            some = queries[at : at + rows]
            entry = np.zeros(len(some), int)
            for links in self.levels[:0:-1]:
                ids, sims = beam_search(self.x, links, some, entry, 4, n)
                entry = np.take_along_axis(ids, sims.argmax(axis=1)[:, None], axis=1)[:, 0]
            ids, sims = beam_search(self.x, self.levels[0], some, entry, min(width, n), n)
            yield np.arange(at, at + len(some)), ids, sims


def within(graph: Graph, queries: np.ndarray, cosine: float, width: int) -> np.ndarray:
    """Pairs (query, vertex) found at this similarity; a beam that is half full widens."""
    out = []
    asked, n = np.arange(len(queries)), len(graph.x)
    while len(asked):
        more = []
        for at, ids, sims in graph.search(queries[asked], width):
            good = sims >= cosine - SLACK
            wider = (good.sum(axis=1) * 2 >= min(width, n)) & (width < n)
            r, c = np.nonzero(good & ~wider[:, None])
            out.append(np.stack([asked[at[r]], ids[r, c]], axis=1))
            more.append(asked[at[wider]])
        asked = np.concatenate(more)
        width = min(4 * width, n)
    return np.concatenate(out) if out else np.zeros((0, 2), int)


def audited(graph: Graph, queries: np.ndarray, cosine: float, seed: int = 3) -> np.ndarray:
    """Pairs found once an audit recalls enough: else all queries get twice the beam."""
    rng = np.random.default_rng(seed)
    tested = rng.choice(len(queries), min(AUDITED, len(queries)), replace=False)
    true = queries[tested] @ graph.x.T >= cosine + SLACK
    width, n = BEAM, len(graph.x)
    while True:
        pairs = within(graph, queries, cosine, width)
        hit = np.zeros((len(queries), 1), int)
        place = np.full(len(queries), -1)
        place[tested] = np.arange(len(tested))
        mine = pairs[place[pairs[:, 0]] >= 0]
        hit = int(true[place[mine[:, 0]], mine[:, 1]].sum())
        if width >= n or hit >= RECALL * true.sum():
            return pairs
        width = min(2 * width, n)


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw)) as arrays:
        return {k: arrays[k] for k in arrays.files}


def build_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard's rows (label, dim, shard, cls, copies, vector) as one row with its graph."""
    pdf = pdf.sort_values("cls")
    exact = unit(np.stack(pdf["vector"].to_numpy()).astype(np.float64))
    graph, order = Graph.build(exact)
    levels = {f"level{i}": links.astype(np.int32) for i, links in enumerate(graph.levels)}
    raw = _pack(
        cls=pdf["cls"].to_numpy()[order],
        copies=pdf["copies"].to_numpy()[order],
        exact=exact[order],
        **levels,
    )
    head = {c: [pdf[c].iloc[0]] for c in ("label", "dim", "shard")}
    return pd.DataFrame({**head, "graph": [raw]})


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest vertex each one is connected with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def query_shards(pdf: pd.DataFrame, cosine: float = COSINE) -> pd.DataFrame:
    """One pair of shards: numbers of links per class (a, links) and forest links (a, b)."""
    left, right = _unpack(pdf["graph_a"].iloc[0]), _unpack(pdf["graph_b"].iloc[0])
    same = pdf["shard_a"].iloc[0] == pdf["shard_b"].iloc[0]
    levels = [right[f"level{i}"] for i in range(sum(k.startswith("level") for k in right))]
    graph = Graph(right["exact"].astype(np.float32), levels)
    pairs = audited(graph, left["exact"].astype(np.float32), cosine)
    q, v = pairs[:, 0], pairs[:, 1]
    if same:
        q, v = np.minimum(q, v)[q != v], np.maximum(q, v)[q != v]
        code = np.unique(q * len(graph.x) + v)
        q, v = code // len(graph.x), code % len(graph.x)
    keep = np.zeros(len(q), bool)
    for at in range(0, len(q), 1 << 16):
        part = slice(at, at + (1 << 16))
        keep[part] = np.einsum("nd,nd->n", left["exact"][q[part]], right["exact"][v[part]]) >= cosine
    q, v = q[keep], v[keep]
    n = len(left["cls"])
    cls = left["cls"] if same else np.concatenate([left["cls"], right["cls"]])
    copies = left["copies"] if same else np.concatenate([left["copies"], right["copies"]])
    v = v if same else v + n
    links = np.zeros(len(cls), np.int64)
    np.add.at(links, q, copies[v])
    np.add.at(links, v, copies[q])
    root = _roots(q, v, len(cls))
    linked, child = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(cls)))
    return pd.DataFrame(
        {
            "a": np.concatenate([cls[linked], cls[child]]),
            "b": pd.array(
                np.concatenate([np.zeros(len(linked), np.int64), cls[root[child]]]), "Int64"
            ),
            "links": np.concatenate([links[linked], np.full(len(child), -1)]),
        }
    )


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, shard_size: int = SHARD
) -> DataFrame:
    """For each row: vec_id, n_links, component_id, kept."""
    spark = session(vectors.sparkSession)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    bad = F.exists("vector", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    some = F.exists("vector", lambda e: e != 0)
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad & some, F.lit(False)
    )
    classes = written(
        rows.where(usable)
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("cls", F.monotonically_increasing_id())
        .withColumn("dim", F.size("vector")),
        "hnsw-classes",
    )
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard_size).alias("shards"))
    totals = sizes.agg(
        F.sum("shards").alias("n"), F.sum(F.expr("shards * (shards + 1) / 2")).alias("pairs")
    ).first()
    tasks = lambda n: max(1, min(4 * int(n or 0), 20_000))
    dealt = classes.join(sizes, ["label", "dim"]).select(
        "label",
        "dim",
        F.pmod(F.xxhash64("cls"), "shards").alias("shard"),
        "cls",
        "copies",
        "vector",
    )
    keys = ["label", "dim", "shard"]
    kind = dict(dealt.dtypes)["label"]
    graphs = written(
        dealt.repartition(tasks(totals["n"]), *keys)
        .groupBy(*keys)
        .applyInPandas(build_shard, f"label {kind}, dim int, shard long, graph binary"),
        "hnsw-graphs",
    )
    side = lambda s: graphs.select(
        "label", "dim", F.col("shard").alias(f"shard_{s}"), F.col("graph").alias(f"graph_{s}")
    )
    both = side("a").join(side("b"), ["label", "dim"]).where("shard_a <= shard_b")
    keys = ["label", "dim", "shard_a", "shard_b"]

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        return query_shards(pdf, cosine)

    answers = written(
        both.repartition(tasks(totals["pairs"]), *keys)
        .groupBy(*keys)
        .applyInPandas(ask, "a long, b long, links long"),
        "hnsw-links",
    )
    links = answers.where("links >= 0").groupBy("a").agg(F.sum("links").alias("links"))
    reached = connected_components(answers.where("links < 0").select("a", "b")).select(
        F.col("id").alias("cls"), "component"
    )
    joined = classes.join(reached, "cls", "left").select(
        "label", "vector", "rep", "copies", "cls", F.coalesce("component", "cls").alias("component")
    )
    lowest = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = written(
        joined.join(lowest, "component")
        .join(links.select(F.col("a").alias("cls"), "links"), "cls", "left")
        .select(
            "label",
            "vector",
            "component_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "hnsw-known",
    )
    out = rows.withColumn("usable", usable).join(known, ["label", "vector"], "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.when(F.col("usable"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
