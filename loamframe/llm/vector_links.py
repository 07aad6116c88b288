"""Near-duplicate vectors: navigable small-world graphs per shard, every shard queried.

Vectors are compared within one label only.  Equal vectors are collapsed first.
Each label is dealt into shards of bounded size; a shard builds a hierarchical
navigable small-world graph, and every vector of the label searches every shard
of it.  Graphs are grown and searched by whole batches of vectors in numpy.  Each
search task audits some of its queries, from its own and from other shards, against
brute force and widens its beam until the audit passes; a query whose beam is half
full of links, and all queries of a task whose audit cannot pass, are compared with
the whole shard in one product.  Cosines of pairs near the threshold are computed again
in double precision before they count as links.

A task returns counts and spanning edges, not pairs, so its output follows the
number of vectors however many of them link.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamframe.llm.components import components
from loamframe.llm.shared import discard, materialise, numbered, salted_join, stable

THRESHOLD = 0.93
#: Vectors to a shard, about, and queries sent to a shard together.
SHARD, QUERIES = 8192, 16384
#: Links of a node, width of the beam when building and, at first, when searching, and the widest.
LINKS, BUILD_BEAM, BEAM, WIDEST = 10, 40, 24, 384
#: Vectors inserted, and queries searched, at once; nodes of each beam opened at once.
BATCH, OPENED = 1024, 4
#: Queries of a task whose neighbours are also found by brute force, and the share to be found.
AUDIT, RECALL = 64, 0.99
#: Slack for single precision before pairs are computed again.
SLACK = 1e-4


class SmallWorld:
    """A graph over unit vectors."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.exact, self.v = vectors, vectors.astype(np.float32)
        n = len(vectors)
        rng = np.random.default_rng(11)
        self.level = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(LINKS)).astype(int), 6)
        high = int(self.level.max(initial=0))
        self.links = [np.full((n, LINKS * 2 if k == 0 else LINKS), -1, np.int32) for k in range(high + 1)]
        order = np.argsort(-self.level, kind="stable")
        self.entry = int(order[0]) if n else -1
        for k in range(high, -1, -1):
            own = order[self.level[order] >= k]
            for at in range(0, len(own), BATCH):
                self._insert(own[at : at + BATCH], at > 0, k)

    def _search(self, q: np.ndarray, start: np.ndarray, beam: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) of each query's beam, best first; -1 where the beam is not full."""
        links, v = self.links[layer], self.v
        b = len(q)
        ids, sims, opened = np.full((b, beam), -1, np.int32), np.full((b, beam), -np.inf, np.float32), np.zeros((b, beam), bool)
        ids[:, 0], sims[:, 0] = start, np.einsum("bd,bd->b", v[start], q)
        rows = np.arange(b)
        while True:
            todo = ~opened[rows] & (ids[rows] >= 0)
            rows = rows[todo.any(axis=1)]
            if len(rows) == 0:
                return ids, sims
            todo = ~opened[rows] & (ids[rows] >= 0)
            pick = todo & (np.cumsum(todo, axis=1) <= OPENED)
            opened[rows] |= pick
            at = np.argsort(~pick, axis=1, kind="stable")[:, :OPENED]
            from_ = np.where(np.take_along_axis(pick, at, 1), np.take_along_axis(ids[rows], at, 1), -1)
            near = np.where(from_[:, :, None] >= 0, links[from_], -1).reshape(len(rows), -1)
            every = np.concatenate([ids[rows], near], axis=1)
            by = np.argsort(2 * every + (np.arange(every.shape[1]) >= beam), axis=1)  # of equal nodes the beam's own first
            in_order = np.take_along_axis(every, by, 1)
            again = np.zeros(every.shape, bool)
            np.put_along_axis(again, by[:, 1:], in_order[:, 1:] == in_order[:, :-1], 1)
            every[:, beam:][again[:, beam:]] = -1
            r, c = np.nonzero(every[:, beam:] >= 0)
            all_sims = np.full(every.shape, -np.inf, np.float32)
            all_sims[:, :beam] = sims[rows]
            all_sims[r, beam + c] = np.einsum("kd,kd->k", v[every[r, beam + c]], q[rows[r]])
            top = np.argsort(-all_sims, axis=1)[:, :beam]
            flags = np.zeros(every.shape, bool)
            flags[:, :beam] = opened[rows]
            ids[rows], sims[rows], opened[rows] = (np.take_along_axis(x, top, 1) for x in (every, all_sims, flags))

    def _choose(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """For each row near nodes that are not nearer to each other, then the nearest of the rest; -1 where there are none."""
        x = self.v[ids]
        between = x @ x.transpose(0, 2, 1)
        closest = np.full(ids.shape, -np.inf, np.float32)
        kept = np.zeros(ids.shape, bool)
        count = np.zeros(len(ids), int)
        for a in range(ids.shape[1]):
            good = (ids[:, a] >= 0) & (count < most) & (closest[:, a] < sims[:, a])
            kept[:, a] = good
            count += good
            np.maximum(closest, between[:, a], out=closest, where=good[:, None])
        by = np.argsort(np.where(kept, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
        return np.take_along_axis(ids, by, 1)

    def _insert(self, new: np.ndarray, grown: bool, layer: int) -> None:
        v, links = self.v, self.links[layer]
        q = v[new]
        own = q @ q.T
        np.fill_diagonal(own, -np.inf)
        near = np.argsort(-own, axis=1)[:, : BUILD_BEAM if not grown else BUILD_BEAM // 2]
        sims = np.take_along_axis(own, near, 1)
        ids = np.where(np.isfinite(sims), new[near], -1).astype(np.int32)
        if grown:
            far, far_sims = self._search(q, self._enter(q, layer), BUILD_BEAM, layer)
            ids, sims = np.concatenate([far, ids], axis=1), np.concatenate([far_sims, sims], axis=1)
            by = np.argsort(-sims, axis=1)[:, :BUILD_BEAM]
            ids, sims = np.take_along_axis(ids, by, 1), np.take_along_axis(sims, by, 1)
        chosen = self._choose(ids, sims, LINKS)
        links[new, : chosen.shape[1]] = chosen
        r, c = np.nonzero(chosen >= 0)
        to = np.unique(chosen[r, c])
        old_r, old_c = np.nonzero(links[to] >= 0)
        dst, src = np.concatenate([chosen[r, c], to[old_r]]), np.concatenate([new[r], links[to][old_r, old_c]])
        dst, src = np.divmod(np.unique(dst.astype(np.int64) * len(v) + src), len(v))
        s = np.einsum("kd,kd->k", v[dst], v[src])
        by = np.lexsort((-s, dst))
        dst, src, s = dst[by], src[by], s[by]
        first = np.flatnonzero(np.concatenate([[True], dst[1:] != dst[:-1]])[: len(dst)])
        rank = np.arange(len(dst)) - np.repeat(first, np.diff(np.append(first, len(dst))))
        row = np.searchsorted(to, dst)
        ok = rank < BUILD_BEAM
        ids, sims = np.full((len(to), BUILD_BEAM), -1, np.int32), np.full((len(to), BUILD_BEAM), -np.inf, np.float32)
        ids[row[ok], rank[ok]], sims[row[ok], rank[ok]] = src[ok], s[ok]
        most = links.shape[1]
        for at in range(0, len(to), BATCH):
            part = slice(at, at + BATCH)
            links[to[part]] = self._choose(ids[part], sims[part], most)

    def _enter(self, q: np.ndarray, layer: int) -> np.ndarray:
        """The node of ``layer`` from which each query starts."""
        start = np.full(len(q), self.entry)
        for k in range(len(self.links) - 1, layer, -1):
            start = self._search(q, start, OPENED, k)[0][:, 0]
        return start

    def near(self, q: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs with a cosine of at least ``least``; brute force where half the beam links, or without a beam."""
        single = q.astype(np.float32)
        none = np.zeros(0, int)
        if beam:
            ids, sims = self._search(single, self._enter(single, 0), min(beam, len(self.v)), 0)
            good = sims >= least - SLACK
            crowded = 2 * good.sum(axis=1) >= ids.shape[1]
            r, c = np.nonzero(good & ~crowded[:, None])
            rows, nodes, found = r, ids[r, c].astype(int), sims[r, c]
        else:
            crowded = np.ones(len(q), bool)
            rows, nodes, found = none, none, none.astype(np.float32)
        full = np.flatnonzero(crowded)
        if len(full):
            all_sims = single[full] @ self.v.T
            r, c = np.nonzero(all_sims >= least - SLACK)
            rows, nodes, found = np.concatenate([rows, full[r]]), np.concatenate([nodes, c]), np.concatenate([found, all_sims[r, c]])
        ok = np.ones(len(rows), bool)
        close = np.flatnonzero(found < least + SLACK)  # the others are above in double precision too
        for at in range(0, len(close), 1 << 18):
            i = close[at : at + (1 << 18)]
            ok[i] = np.einsum("kd,kd->k", q[rows[i]], self.exact[nodes[i]]) >= least
        return rows[ok], nodes[ok]


def _recall(world: SmallWorld, q: np.ndarray, own: np.ndarray, least: float, beam: int) -> tuple[float, int, int]:
    """(mean share found by ``beam`` over queries with neighbours, pairs found, pairs); ``own`` is a query's node, else -1."""
    true, found = (np.zeros(len(q), int) for _ in range(2))
    for out, width in ((true, 0), (found, beam)):
        r, c = world.near(q, least, width)
        other = c != own[r]
        out += np.bincount(r[other], minlength=len(q))
    some = true > 0
    return float((found[some] / true[some]).mean()) if some.any() else 1.0, int(found.sum()), int(true.sum())


def _search_shard(world: SmallWorld, nodes: np.ndarray, copies: np.ndarray, q: np.ndarray, names: np.ndarray, least: float) -> dict[str, list]:
    """What one shard tells about queries: their links, and edges that connect what they link."""
    own = np.where(np.isin(names, nodes), np.searchsorted(nodes, names), -1)
    own[own >= 0] = np.where(nodes[own[own >= 0]] == names[own >= 0], own[own >= 0], -1)
    some = np.unique(np.linspace(0, len(q) - 1, min(AUDIT, len(q))).astype(int))
    beam = BEAM
    share, found, true = _recall(world, q[some], own[some], least, beam)
    while share < RECALL and beam:
        beam = 0 if 2 * beam > WIDEST else 2 * beam  # without a beam: brute force
        share, found, true = _recall(world, q[some], own[some], least, beam)
    top = np.arange(len(nodes))

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = int(top[x])
        return x

    links, peer, met = np.zeros(len(q), np.int64), np.full(len(q), -1), np.zeros(len(nodes), bool)
    for at in range(0, len(q), BATCH):
        r, c = world.near(q[at : at + BATCH], least, beam)
        r = r + at
        other = c != own[r]
        r, c = r[other], c[other]
        met[c] = True
        links += np.bincount(r, weights=copies[c], minlength=len(q)).astype(np.int64)
        tops = top.copy()  # as of now, with chains cut short
        while (tops[tops] != tops).any():
            tops = tops[tops]
        for both in np.unique(r * len(nodes) + tops[c]).tolist():
            i, k = divmod(both, len(nodes))
            k = root(k)
            for other_k in (peer[i], own[i]):
                if other_k >= 0 and (j := root(int(other_k))) != k:
                    k, j = min(k, j), max(k, j)
                    top[j] = k
            peer[i] = k
    ends = np.array([root(int(x)) for x in top]) if len(top) else top
    has = peer >= 0
    hit = np.flatnonzero(met & (ends != np.arange(len(nodes))))
    node = np.concatenate([names, nodes[hit]])
    to = np.concatenate([np.where(has, nodes[ends[peer]], names), nodes[ends[hit]]])
    return {"node": node, "peer": to, "links": np.concatenate([links, np.zeros(len(hit), np.int64)]), "found": [found] + [0] * (len(node) - 1), "true": [true] + [0] * (len(node) - 1)}


def _unit(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = flat.reshape(len(column), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # squares of very large or small numbers do not fit
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def vector_links(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``rows`` (``vec_id``, ``embedding``, ``label``): ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Two vectors link when their labels are equal and not null, their lengths are
    equal and their cosine is at least ``threshold``.  Vectors that are null, empty,
    zero or hold null or non-finite components link with nothing, and stand for
    themselves.  ``component_id`` is the smallest ``vec_id`` reachable; repeated
    rows are vectors of their own and link with each other; rows with a null
    ``vec_id`` take part and never name a component that has another id.  An empty
    table gives an empty result; other columns are ignored, whatever they are called.
    ``audited_recall`` is the share of links of the audited queries that graphs found.
    """
    spark = rows.sparkSession
    all_rows = materialise(numbered(stable(rows)).select("rid", F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("v")), "vectors")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = all_rows.where("label is not null and v is not null and size(v) > 0").where(~F.exists("v", bad)).where(F.exists("v", lambda x: x != 0))
    classes = materialise(usable.groupBy("label", "v").agg(F.min("rid").alias("node"), F.count(F.lit(1)).alias("copies")), "classes")
    total = classes.count()
    classes = classes.withColumn("size", F.size("v"))
    shards = classes.groupBy("label", "size").agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("shards"), F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("parts"))
    placed = salted_join(classes, shards, ["label", "size"], ["node"], total)
    shard = F.pmod(F.xxhash64("node"), "shards").cast("int").alias("shard")
    key = ["label", "size", "shard"]

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        raw = pickle.dumps((SmallWorld(_unit(table.column("v"))), table.column("node").to_numpy(), table.column("copies").to_numpy()), protocol=5)
        first = table.slice(0, 1)
        return pa.table({"label": first.column("label"), "size": first.column("size"), "shard": first.column("shard"), "graph": pa.array([raw], pa.large_binary()).cast(pa.binary()), "parts": first.column("parts")})

    label_type = classes.schema["label"].dataType.simpleString()
    graphs = placed.select("label", "size", shard, "node", "copies", "v", "parts").groupBy(*key).applyInArrow(build, f"label {label_type}, size int, shard int, graph binary, parts int")
    graphs = materialise(graphs, "graphs").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    queries = placed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    queries = queries.select(*key, F.pmod(F.xxhash64("node", F.lit(1)), "parts").cast("int").alias("part"), "node", "v")
    schema = pa.schema([(c, pa.int64()) for c in ("node", "peer", "links", "found", "true")])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        world, nodes, copies = pickle.loads(left.column("graph")[0].as_py())  # noqa: S301  our own graph
        return pa.table(_search_shard(world, nodes, copies, _unit(right.column("v")), right.column("node").to_numpy(), threshold), schema=schema)

    by = [*key, "part"]
    told = graphs.select(*by, "graph").groupBy(*by).cogroup(queries.groupBy(*by)).applyInArrow(search, "node long, peer long, links long, found long, true long")
    told = materialise(told, "links")
    discard(spark, graphs)
    recall = told.agg(F.try_divide(F.sum("found"), F.sum("true")).alias("recall")).first()["recall"]
    degree = told.groupBy("node").agg(F.sum("links").alias("others"))
    group = components(told.select(F.col("node").alias("u"), F.col("peer").alias("v")).where("u <> v")).withColumnRenamed("component", "group")
    known = classes.join(degree, "node", "left").join(group, "node", "left").select("label", "v", "node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("group", "node").alias("group"))
    count = all_rows.count()
    out = salted_join(all_rows, known, ["label", "v"], ["rid"], count, "left").select("rid", "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("group", "rid").alias("group"))
    out = materialise(out, "linked")
    discard(spark, told, classes, all_rows)
    least = out.groupBy("group").agg(F.min("vec_id").alias("component_id"))
    kept = F.col("vec_id").eqNullSafe(F.col("component_id"))
    return salted_join(out, least, ["group"], ["rid"], count).select("rid", "vec_id", "n_links", "component_id", kept.alias("kept"), F.lit(recall).cast("double").alias("audited_recall"))
