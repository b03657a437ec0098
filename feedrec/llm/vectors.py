"""Embedding near-duplicates by a robust-pruned flat graph.

Equal vectors are one node with a weight. Centroids fitted on at most
``SAMPLE`` nodes deal the nodes out: a node is a member of its ``MEMBER`` nearest
shards and is searched for in its ``searches`` nearest. A shard of more than about
``LIMIT`` members is cut into parts by hash, its queries into blocks of about
``LIMIT``; every block meets every part, so nothing is lost by a cut. A task holds
one part and one block. It cuts it again into overlapping clusters of about ``CLUSTER`` nodes, builds a
robust-pruned graph on each (every node keeps close neighbours of which none is
much nearer to another one kept), unites the adjacency lists and adds the
reverse edges. Each query starts from the clusters' medoids, walks greedily with
a beam, then expands from every node within range until none is new. What is
found is verified by the cosine in double precision.

A link found in two shards counts in the first of the query's shards that holds
the other node. For components a shard gives one edge per node, to the least
node that its links reach there, so large groups stay linear.

``audit`` compares hash-ordered nodes with all rows by brute force in blocks, and
draws more until ``LINKED`` of them have few links and as many have many, or all
nodes or ``MOST_AUDITED`` are drawn; nodes of either kind that the search itself
found come on top. Every node weighs the same, and the lower recall of the two kinds
counts. Below ``min_recall`` the search is repeated with a wider beam and in more
shards, at last in all; if that is not enough it raises.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are kept; vectors of different length never
link; repeated rows are vectors of their own; a null vec_id has links but no
component; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedrec.llm.common import store
from feedrec.llm.graph import components

SAMPLE = 20_000
SHARD, CLUSTER, MEMBER = 4000, 1000, 2
MAX_SHARDS, LIMIT = 4096, 16_000
DEGREE, NEAREST, ALPHA = 24, 4, 1.2
BEAM, BATCH = 32, 512
AUDIT, LINKED, MOST_AUDITED = 256, 64, 8192
FEW = 8  # links of a node in a small group, at most


def _unit(column) -> np.ndarray:
    v = np.array([np.asarray(x, dtype=np.float64) for x in column])
    if not len(v):
        return v.reshape(0, 1)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # squares stay finite
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def centroids(v: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced rows."""
    c = v[np.linspace(0, len(v) - 1, k).astype(int)]
    for _ in range(rounds):
        near = (v @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, v)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), c)
    return c


def _nearest(v: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    return np.argsort(-(v @ c.T), axis=1, kind="stable")[:, :k]


def pruned(v: np.ndarray) -> np.ndarray:
    """Out-edges of each node by robust pruning, -1 where there are fewer."""
    n = len(v)
    near = v @ v.T
    far = np.sqrt(np.maximum(0.0, 2 - 2 * near)).astype(np.float32)
    np.fill_diagonal(far, np.inf)
    out = np.full((n, DEGREE + NEAREST), -1)
    k = min(NEAREST, n - 1)
    if k:
        out[:, DEGREE:DEGREE + k] = np.argpartition(far, k - 1, axis=1)[:, :k]
    left, rows = far.copy(), np.arange(n)
    np.fill_diagonal(far, 0.0)
    for step in range(min(DEGREE, n - 1)):
        c = left.argmin(axis=1)
        open_ = np.isfinite(left[rows, c])
        if not open_.any():
            break
        out[open_, step] = c[open_]
        left[rows, c] = np.inf
        left[ALPHA * far[c] <= left] = np.inf  # nearer to the neighbour just kept
    return out


class Graph:
    """United adjacency of overlapping clusters, with the clusters' medoids."""

    def __init__(self, v: np.ndarray):
        n = len(v)
        k = max(1, -(-n // CLUSTER))
        c = centroids(v[:: max(1, n // SAMPLE)], k) if k > 1 else v.mean(axis=0, keepdims=True)
        near = _nearest(v, c, min(MEMBER, len(c)))
        a, b, medoids = [], [], []
        todo = [np.flatnonzero((near == i).any(axis=1)) for i in range(len(c))]
        while todo:
            ids = todo.pop()
            if len(ids) > 4 * CLUSTER:  # a dense cluster: halves that share a quarter of it
                side = v[ids] @ (v[ids[0]] - v[ids[-1]])
                order = ids[np.argsort(side, kind="stable")]
                cut, lap = len(ids) // 2, len(ids) // 8
                todo += [order[:cut + lap], order[cut - lap:]]
            elif len(ids):
                edges = pruned(v[ids])
                at, to = np.nonzero(edges >= 0)
                a.append(ids[at])
                b.append(ids[edges[at, to]])
                medoids.append(ids[int((v[ids] @ v[ids].mean(axis=0)).argmax())])
        pair = np.unique(np.concatenate([np.concatenate(a) * n + np.concatenate(b), np.concatenate(b) * n + np.concatenate(a)]))
        pair = pair[pair // n != pair % n]
        self.v, self.n = v.astype(np.float32), n
        self.first = np.searchsorted(pair // n, np.arange(n + 1))
        self.to = pair % n
        self.medoids = np.unique(medoids)

    def around(self, q: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, neighbour) for all neighbours of each (query, node)."""
        count = self.first[node + 1] - self.first[node]
        at = np.repeat(self.first[node] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return np.repeat(q, count), self.to[at]

    def search(self, q: np.ndarray, low: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs with a cosine of at least ``low``."""
        m, q = len(q), q.astype(np.float32)
        seen = np.zeros((m, self.n), dtype=bool)
        ids = np.full((m, beam), -1)
        sims = np.full((m, beam), -np.inf, dtype=np.float32)
        done = np.ones((m, beam), dtype=bool)
        hit_q, hit_n = [], []

        def look(qi: np.ndarray, ni: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            key = np.unique(qi * self.n + ni)
            key = key[~seen.reshape(-1)[key]]
            seen.reshape(-1)[key] = True
            qi, ni = key // self.n, key % self.n
            s = np.einsum("ij,ij->i", q[qi], self.v[ni])
            near = s >= low
            hit_q.append(qi[near])
            hit_n.append(ni[near])
            return qi, ni, s

        def merge(qi: np.ndarray, ni: np.ndarray, s: np.ndarray) -> None:
            if not len(qi):
                return
            count = np.bincount(qi, minlength=m)
            rows = np.flatnonzero(count)
            slot = np.arange(len(qi)) - np.repeat(np.cumsum(count[rows]) - count[rows], count[rows])
            wide = count.max()
            new_i, new_s = np.full((m, wide), -1), np.full((m, wide), -np.inf, dtype=np.float32)
            new_i[qi, slot], new_s[qi, slot] = ni, s
            all_i, all_s = np.hstack([ids, new_i]), np.hstack([sims, new_s])
            all_d = np.hstack([done, new_i < 0])
            best = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            ids[:], sims[:], done[:] = (np.take_along_axis(x, best, axis=1) for x in (all_i, all_s, all_d))

        merge(*look(np.repeat(np.arange(m), len(self.medoids)), np.tile(self.medoids, m)))
        while True:
            pick = np.where(done, -np.inf, sims).argmax(axis=1)
            rows = np.flatnonzero(~done[np.arange(m), pick])
            if not len(rows):
                break
            done[rows, pick[rows]] = True
            merge(*look(*self.around(rows, ids[rows, pick[rows]])))
        fresh = np.concatenate(hit_q), np.concatenate(hit_n)
        while len(fresh[0]):  # expand within range
            before = len(hit_q)
            for at in range(0, len(fresh[0]), 50_000):
                look(*self.around(fresh[0][at:at + 50_000], fresh[1][at:at + 50_000]))
            fresh = np.concatenate(hit_q[before:]), np.concatenate(hit_n[before:])
        return np.concatenate(hit_q), np.concatenate(hit_n)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node reachable, by label passing with pointer jumps."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _search_shard(least: float, beam: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", kind="stable").reset_index(drop=True)
        v = _unit(pdf.embedding)
        query, inside = np.flatnonzero(pdf["query"].to_numpy(bool)), np.flatnonzero(pdf.member.to_numpy(bool))
        out = pd.DataFrame({"node": pdf.node, "links": 0, "root": pdf.node})
        if not len(inside) or not len(query):
            return out.iloc[query]
        graph = Graph(v[inside])
        shard = int(pdf.shard.iloc[0])
        searches = np.array(pdf.searches.tolist())
        members = np.array(pdf.members.tolist())[inside]
        weight, links = pdf.weight.to_numpy(np.int64)[inside], np.zeros(len(pdf), np.int64)
        every, root = np.arange(len(pdf)), np.arange(len(pdf))
        step = max(1000, 1_000_000 // searches.shape[1])
        for at in range(0, len(query), BATCH):
            qi, ni = graph.search(v[query[at:at + BATCH]], least - 1e-5, beam)
            qi = query[qi + at]
            other = inside[ni] != qi
            qi, ni = qi[other], ni[other]
            edges = [every], [root]
            for i in range(0, len(qi), step):  # verify in double precision
                q, n = qi[i:i + step], ni[i:i + step]
                sure = np.einsum("ij,ij->i", v[q], v[inside[n]]) >= least
                q, n = q[sure], n[sure]
                edges[0].append(q)
                edges[1].append(inside[n])
                # the first of the query's shards that holds the other node
                holds = (searches[q][:, :, None] == members[n][:, None, :]).any(axis=2)
                mine = np.take_along_axis(searches[q], holds.argmax(axis=1)[:, None], axis=1)[:, 0] == shard
                np.add.at(links, q[mine], weight[n[mine]])
            root = _roots(len(pdf), np.concatenate(edges[0]), np.concatenate(edges[1]))  # one batch's links at a time
        out["root"] = pdf.node.to_numpy()[root]
        out["links"] = links
        return out[pdf["query"].astype(bool) | (out.root != out.node)]

    return run


def _fitted(nodes: DataFrame, n: int) -> np.ndarray:
    rows = nodes.select("node", "embedding").orderBy(F.xxhash64("node"), "node").limit(SAMPLE).collect()  # bounded
    v = _unit([r.embedding for r in rows])
    return centroids(v, max(1, min(MAX_SHARDS, -(-n // SHARD), len(rows))))


def _found(nodes: DataFrame, c: np.ndarray, least: float, searches: int, beam: int) -> DataFrame:
    """(node, links, root): by shard, part and block, from every node."""
    shared = nodes.sparkSession.sparkContext.broadcast(c)  # MAX_SHARDS centroids at most
    wide = max(searches, min(MEMBER, len(c)))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        members, queries = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
        for pdf in batches:
            near = _nearest(_unit(pdf.embedding), c, wide)
            members += np.bincount(near[:, :MEMBER].ravel(), minlength=len(c))
            queries += np.bincount(near[:, :searches].ravel(), minlength=len(c))
        yield pd.DataFrame({"shard": np.arange(len(c)), "members": members, "queries": queries})

    sizes = (nodes.select("embedding").mapInPandas(count, "shard int, members long, queries long").groupBy("shard")
             .agg(F.sum("members").alias("members"), F.sum("queries").alias("queries")).collect())  # a row a shard
    parts, blocks = np.ones(len(c), np.int64), np.ones(len(c), np.int64)
    for r in sizes:
        parts[r.shard], blocks[r.shard] = max(1, -(-r.members // LIMIT)), max(1, -(-r.queries // LIMIT))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        for pdf in batches:
            near = _nearest(_unit(pdf.embedding), c, wide)
            pdf = pdf.assign(searches=list(near[:, :searches]), members=list(near[:, :MEMBER]))
            h = pdf.node.to_numpy(np.int64).view(np.uint64)
            for i in range(wide):
                s, member = near[:, i], i < MEMBER
                part = (h % parts[s].astype(np.uint64)).astype(np.int64)
                block = ((h >> np.uint64(32)) % blocks[s].astype(np.uint64)).astype(np.int64)
                for p in range(parts[s].max() if len(s) else 0):  # as a query: its block with every part
                    at = parts[s] > p
                    yield pdf[at].assign(shard=s[at], part=p, block=block[at], member=member & (part[at] == p), query=True)
                for b in range(blocks[s].max() if member and len(s) else 0):  # as a member: its part with the other blocks
                    at = (blocks[s] > b) & (block != b)
                    if at.any():
                        yield pdf[at].assign(shard=s[at], part=part[at], block=b, member=True, query=False)

    schema = ("node long, weight long, embedding array<double>, searches array<int>, members array<int>, shard int, part int, block int, "
              "member boolean, query boolean")
    dealt = nodes.select("node", "weight", "embedding").mapInPandas(deal, schema)
    return dealt.groupBy("shard", "part", "block").applyInPandas(_search_shard(least, beam), "node long, links long, root long")


def _truth(nodes: DataFrame, ids: list[int], q: np.ndarray, least: float) -> dict[int, int]:
    """Links of each of ``ids`` by brute force."""
    shared = nodes.sparkSession.sparkContext.broadcast((np.array(ids), q))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q = shared.value
        truth = np.zeros(len(ids), np.int64)
        for pdf in batches:
            near = _unit(pdf.embedding) @ q.T >= least
            near &= pdf.node.to_numpy()[:, None] != ids
            truth += pdf.weight.to_numpy(np.int64) @ near
        yield pd.DataFrame({"node": ids, "truth": truth})

    parts = nodes.select("node", "weight", "embedding").mapInPandas(count, "node long, truth long")
    return {r.node: r.truth for r in parts.groupBy("node").agg(F.sum("truth").alias("truth")).collect()}  # a row a query


def audit(nodes: DataFrame, found: DataFrame, least: float, queries: int = AUDIT, linked: int = LINKED) -> float:
    """Mean share of a node's links that were found, of nodes with few links or of
    those with many, the lower one; 1.0 where brute force finds no link."""
    order = F.xxhash64("node", F.lit(7))
    drawn: dict[int, int] = {}
    got = found.groupBy("node").agg(F.sum("links").alias("links"))

    def draw(rows: list) -> None:
        for at in range(0, len(rows), 1024):
            part = rows[at:at + 1024]
            drawn.update(_truth(nodes, [r.node for r in part], _unit([r.embedding for r in part]), least))

    def short() -> bool:
        few = sum(0 < t <= FEW for t in drawn.values())
        return min(few, sum(t > FEW for t in drawn.values())) < linked

    seen = 0
    while short() and seen < MOST_AUDITED:
        want = min(MOST_AUDITED, max(queries, 4 * seen))
        rows = nodes.select("node", "embedding").orderBy(order, "node").limit(want).collect()[seen:]
        draw(rows)
        if seen + len(rows) < want:  # every node
            break
        seen = want
    if seen and short():  # links are rare, or of one kind: nodes with links found
        for kind in (F.col("links").between(1, FEW), F.col("links") > FEW):
            some = got.where(kind).join(nodes, "node").select("node", "embedding").orderBy(order, "node").limit(linked).collect()
            draw([r for r in some if r.node not in drawn])
    ids = [i for i, t in drawn.items() if t]
    if not ids:
        return 1.0
    links = {r.node: r.links for r in got.where(F.col("node").isin(ids)).collect()}
    kinds = [[min(1.0, (links.get(i) or 0) / drawn[i]) for i in ids if (drawn[i] <= FEW) == few] for few in (True, False)]
    return min(float(np.mean(k)) for k in kinds if k)


def near_vectors(vectors: DataFrame, least: float = 0.95, min_recall: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    x = F.col("embedding")
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    fine = F.coalesce(fine & F.exists(x, lambda e: e != 0), F.lit(False))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.select("vec_id", F.when(fine, F.col("embedding")).alias("embedding"))
    digest = F.sha2(F.array_join(F.transform("embedding", lambda e: e.cast("string")), ",").cast("binary"), 256)
    rows = rows.withColumn("digest", digest)
    # equal vectors: counted before the shuffle, so a common one does not gather in one task
    nodes = (rows.where("digest is not null").groupBy("digest")
             .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"), F.first("embedding").alias("embedding"))
             .withColumn("node", F.xxhash64("digest")).withColumn("dim", F.size("embedding")))
    nodes = store(nodes, "vector-nodes")
    labels = None
    parts = []
    for dim, n in sorted((r.dim, r["count"]) for r in nodes.groupBy("dim").count().collect()):  # one row per vector length
        part = nodes.where(F.col("dim") == dim)
        c = _fitted(part, n)
        searches, beam = min(3, len(c)), BEAM
        while True:
            found = store(_found(part, c, least, searches, beam), "vector-links")
            recall = audit(part, found, least)
            if recall >= min_recall:
                break
            if searches == len(c) and beam >= 16 * BEAM:
                raise RuntimeError(f"the widest search of the vectors of length {dim} has a recall of {recall:.4f}, below {min_recall}")
            searches, beam = min(len(c), 2 * searches), min(2 * beam, 16 * BEAM)
        parts.append(found)
    for p in parts:
        labels = p if labels is None else labels.unionByName(p)
    if labels is None:
        labels = nodes.select("node", F.lit(0).cast("long").alias("links"), F.col("node").alias("root"))
    links = labels.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(labels.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b"))
    named = nodes.join(links, "node").join(classes, "node", "left").withColumn("class", F.coalesce("component", "node"))
    first = named.groupBy("class").agg(F.min("least").alias("component_id"))
    named = named.join(first, "class").select("digest", (F.col("links") + F.col("weight") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "digest").join(named, "digest", "left")
    component = F.coalesce(F.when(F.col("vec_id").isNotNull(), F.col("component_id")), F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
