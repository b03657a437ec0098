"""N-gram Jaccard self-join by universe partition and the pigeonhole principle.

A document's set holds the 64-bit hashes of its distinct word n-grams. Two sets
of sizes r <= s with Jaccard >= t/100 differ in at most
D = (r + s)(100 - t) / (100 + t) elements, and r >= s t/100.

*Size bands* grow by 100/t, so partners lie in the same band or in neighbours.
Each band cuts the universe of hashes into m segments, m a little over the
largest D of any pair whose smaller set lies in the band. *Index*: a set writes a
key for each non-empty segment subset of its own band. *Probe*: as the larger
set it looks up the band below; by the pigeonhole D + 1 segments are enough, and
*cost-based allocation* takes those with most elements, the rarest subsets
(empty segments would match half the corpus and are never used). In small bands,
where non-empty segments may run short, sets also write the keys of all
*one-deletion neighbours* of a segment, and a probe raises segments to one
allowed difference until the allocation reaches D + 1. The rare set whose
segments still do not reach it is an *exception*: it is compared with every set
of its size range, so nothing is lost.

Keys are exchanged as sorted, delta-coded blocks per (chunk of documents,
bucket of keys). A block names each node it uses once, so a bucket is wide (few
keys a node would make most of a block node names) and is read piece by piece. Equal
sets share one node (a 64-bit digest of the set), so exact
copies meet nowhere. In a piece, each key held by two nodes or more is a group:

* round 1 compares every node with one pivot only, the one it shares most keys
  with: linear in the size of a group;
* round 2 looks at groups whose nodes are still in different components. A
  node drops its most expensive keys, those of the largest groups, as long as
  D + 1 of its keys remain (keys that it shares with no node of another component
  count as kept). In groups of up to ``HOT`` nodes the pairs left are joined; a
  parity bitmap of each set, which never overstates a difference, discards most
  before the sets are fetched. Larger groups that share nodes form a cell; its
  nodes are compared block by block inside tasks, which return links that join
  components, not pairs.

Every link is verified on the whole sets; every pair of similar sets is either
verified or already in one component. Components are those of all links.

Defined results: null, empty or wordless texts have size 0, link with nothing and
are their own component; texts of fewer words than n have one element, the whole
sequence; rows with equal ids are one document (its texts' links together), one
row each; a null doc_id links with nothing and has a null component; an empty
table gives no rows; other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedrec.llm.blocks import ODD, U, bucket_cuts, hashes, key_packed, key_unpacked, mix, packed, unpacked, word_hashes
from feedrec.llm.common import free_name, release, releasing, store, words
from feedrec.llm.graph import components
from feedrec.session import joins_broadcast_up_to

HOT = 24
SMALL_BAND = 48  # bands that begin below this also write one-deletion neighbours
CHUNK_KEYS = 800_000  # keys held by a task before they are written out
PIECES, PIECE_KEYS = 16, 250_000  # of a bucket; keys of a piece, read at once
CELL_ELEMENTS, CELL_NODES = 1_000_000, 1500  # of a block of a cell
BROADCAST_IDS = 100_000  # rows of two or three ids: the most that is broadcast, a few MB of the driver whatever the input
BROADCAST_BYTES = 1 << 20  # of a stored table that the planner broadcasts uncounted: some 170,000 ids
STRIP, COLUMNS = 256, 1024  # rows of a cell's comparison and elements of its product held at once
SLICE = 250_000  # elements of a cell's sets that are sorted at once


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct word n-grams of the whole text."""
    w = words(text)
    if not w:
        return np.empty(0, U)
    h = word_hashes(w)
    k = min(n, len(h))
    if k < n:  # the whole sequence is one element, apart from true n-grams
        acc = np.full(1, k, U)
        for x in h:
            acc = mix(acc * ODD[2] + x)
        return acc
    acc = np.zeros(len(h) - n + 1, U)
    for j in range(n):
        acc = acc * ODD[2] + h[j: len(h) - n + 1 + j]
    return np.unique(mix(acc))


def digest(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


class Bands:
    def __init__(self, percent: int = 80, largest: int = 1 << 31):
        self.t = percent
        self.low = [1]
        while self.low[-1] <= largest:
            self.low.append(max(self.low[-1] + 1, -(-self.low[-1] * 100 // percent)))
        self.segments = []
        for a, b in zip(self.low, self.low[1:]):
            worst = self.apart(b - 1, (b - 1) * 100 // percent)
            self.segments.append(-(-worst * 115 // 100) + 3)

    def apart(self, r: int, s: int) -> int:
        """The most elements in which sets of these sizes may differ."""
        return (r + s) * (100 - self.t) // (100 + self.t)

    def of(self, n: int) -> int:
        return int(np.searchsorted(self.low, n, "right")) - 1

    def keys(self, s: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the non-empty segments, their sizes, and the keys of all
        one-deletion neighbours that are not empty (small bands)."""
        seg = ((s >> U(32)) * U(self.segments[band])) >> U(32)  # rises with s: segments are slices
        first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
        size = np.diff(np.append(first, len(s)))
        m = mix(s + ODD[4])
        content = np.add.reduceat(m, first)
        salt = seg[first] * ODD[3] + U((band + 1) * int(ODD[4]) % (1 << 64))
        own = mix(content + salt)
        deleted = np.empty(0, U)
        if self.low[band] < SMALL_BAND:
            of = np.repeat(np.arange(len(first)), size)
            many = size[of] >= 2
            deleted = mix(content[of[many]] - m[many] + salt[of[many]])
        return own, size, deleted

    def fails(self, s: np.ndarray) -> bool:
        """Whether the segments of a set, at one difference each in small bands,
        fall short of what the pigeonhole needs."""
        def short(band: int, need: int) -> bool:
            seg = ((s >> U(32)) * U(self.segments[band])) >> U(32)
            first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
            got = len(first)
            if got < need and self.low[band] < SMALL_BAND:
                got += int((np.diff(np.append(first, len(s))) >= 2).sum())
            return got < need

        n, band = len(s), self.of(len(s))
        probes = band and -(-n * self.t // 100) < self.low[band]
        return short(band, self.apart(n, n) + 1) or bool(probes and short(band - 1, self.apart(self.low[band] - 1, n) + 1))

    def written(self, s: np.ndarray) -> list[tuple[np.ndarray, int, int]]:
        """[(keys, role, slack)]. Role 0: index of the own band, role 1: probe
        of the band below. Slack: keys beyond those needed, -1 where any hot key
        matters."""
        n, band = len(s), self.of(len(s))
        own, size, deleted = self.keys(s, band)
        if self.low[band] < SMALL_BAND:
            out = [(np.concatenate([own, deleted]), 0, -1)]
        else:
            out = [(own, 0, len(own) - self.apart(n, n) - 1)]
        least = -(-n * self.t // 100)
        if band and least < self.low[band]:
            own, size, deleted = self.keys(s, band - 1)
            need = self.apart(self.low[band] - 1, n) + 1
            if len(own) >= need:
                # the rarest half more than needed, so that expensive ones can be dropped
                out.append((own[np.argsort(-size, kind="stable")[:need + need // 2]], 1, min(len(own), need + need // 2) - need))
            else:
                out.append((np.concatenate([own, deleted]), 1, -1))
        return out


def sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, node, exception) of every row."""
    @releasing
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = Bands(percent)
        for pdf in batches:
            rows = []
            for t in pdf.text:
                s = shingles(t, n)
                rows.append((len(s), digest(s), bool(len(s)) and bands.fails(s)))
            out = pd.DataFrame(rows, columns=["n_shingles", "node", "exception"])
            out.insert(0, "doc_id", pdf.doc_id.array)
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_shingles long, node long, exception boolean")


def _blocks(docs: DataFrame, n: int, percent: int, buckets: int) -> DataFrame:
    """Key blocks: by piece the sorted keys and their entry numbers, and the entries
    (node, size, role, slack) that the block uses."""
    @releasing
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = Bands(percent)
        keys, entries, seen, held = [], [], set(), 0

        def flush() -> pd.DataFrame:
            nonlocal held
            k, e = np.concatenate(keys), np.repeat(np.arange(len(entries), dtype=np.int32), [len(x) for x in keys])
            keys.clear()
            order = np.argsort(k, kind="stable")
            k, e = k[order], e[order]
            del order
            cut = bucket_cuts(k, buckets * PIECES)
            table = np.array(entries, dtype=np.int64).reshape(-1, 4)
            rows = []
            for b in np.flatnonzero(cut[PIECES::PIECES] > cut[:-1:PIECES]).tolist():
                at = cut[b * PIECES:(b + 1) * PIECES + 1].tolist()
                eb = e[at[0]:at[-1]]
                flag = np.zeros(len(table), bool)
                flag[eb] = True
                local = (np.cumsum(flag) - 1).astype("<u4")[eb]
                node, size, role, slack = table[flag].T
                parts = [(i, j) for i, j in zip(at, at[1:])]
                rows.append((b, [key_packed(k[i:j]) if j > i else b"" for i, j in parts],
                             [packed(local[i - at[0]:j - at[0]]) if j > i else b"" for i, j in parts],
                             packed(node.view("<u8")), packed(size.view("<u8")), packed(role.view("<u8")), packed((slack + 1).view("<u8"))))
            entries.clear(), seen.clear()
            held = 0
            return pd.DataFrame(rows, columns=["bucket", "keys", "entry", "node", "size", "role", "slack"])

        for pdf in batches:
            for doc_id, t in zip(pdf.doc_id.array, pdf.text):
                s = shingles(t, n)
                if not len(s) or pd.isna(doc_id):
                    continue
                node = digest(s)
                if node in seen:  # a copy within the chunk
                    continue
                seen.add(node)
                for k, role, slack in bands.written(s):
                    keys.append(k)
                    entries.append((node, len(s), role, slack))
                    held += len(k)
                if held >= CHUNK_KEYS:
                    yield flush()
        if entries:
            yield flush()
        hashes.clear()  # the next stage runs in the same workers and reads no words

    return docs.select("doc_id", "text").mapInPandas(
        run, "bucket int, keys array<binary>, entry array<binary>, node binary, size binary, role binary, slack binary")


def bucket_count(elements: int) -> int:
    return max(8, -(-elements // (2 * PIECES * PIECE_KEYS)))  # about half a key per element


GROUPS = "pivot boolean, grp long, node long, size int, role int, slack int, held int, times int"


def _groups(blocks: DataFrame, buckets: int, percent: int) -> DataFrame:
    """Groups of nodes that share a key. Rows with pivot = true: (grp: pivot,
    node, times: shared keys) for round 1. Others: members of a group (grp: its
    number, held: its size, times: the keys with just these members)."""
    def collect(rows: list, piece: int) -> list[pd.DataFrame]:
        key, node, size, role, slack = [], [], [], [], []
        for keys, entry, *of in rows:
            if keys[piece]:
                e = unpacked(entry[piece], "<u4")
                key.append(key_unpacked(keys[piece]))
                for to, values in zip((node, size, role, slack), of):
                    to.append(values[e])
                keys[piece] = entry[piece] = None
        if not key:
            return []
        key, node, size, role, slack = map(np.concatenate, (key, node, size, role, slack))
        order = np.lexsort((role, node, key))
        key, node = key[order], node[order]
        # one entry per key and node; a node that is index and probe of one band counts as index
        once = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
        order, key, node = order[once], key[once], node[once]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(first, len(key)))
        role = role[order]
        several = (count >= 2) & (np.minimum.reduceat(role, first) == 0)  # someone must have indexed it
        if not several.any():
            return []
        size, slack = size[order], slack[order]
        del order, once
        mask = np.repeat(several, count)
        first, count = first[several], count[several]
        # groups with the same members are one group with a multiplicity
        mark = np.add.reduceat(mix(node[mask].view(U) + role[mask].astype(U) * ODD[2]), np.cumsum(count) - count)
        _, keep, times = np.unique(mark, return_index=True, return_counts=True)
        first, count = first[keep], count[keep]
        at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        grp = np.repeat(key[first].view(np.int64), count)
        times, held = np.repeat(times.astype(np.int32), count), np.repeat(count.astype(np.int32), count)
        node, size, role, slack = node[at], size[at], role[at], slack[at]
        del key, mask, mark, at
        members = pd.DataFrame({"pivot": False, "grp": grp, "node": node, "size": size, "role": role,
                                "slack": slack, "held": held, "times": times})
        # the pivot of a group: its least node that has indexed the key
        start = np.cumsum(count) - count
        least = np.minimum.reduceat(np.where(role == 0, node, np.iinfo(np.int64).max), start)
        stars = pd.DataFrame({"grp": np.repeat(least, count), "node": node, "times": times})
        stars = stars[stars.grp != stars.node].groupby(["grp", "node"], as_index=False).times.sum()
        stars = stars.assign(pivot=True, size=0, role=0, slack=0, held=0)
        return [members, stars[members.columns]]

    @releasing
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                rows.append((list(r.keys), list(r.entry), unpacked(r.node, "<i8"), unpacked(r.size, "<i8").astype(np.int32),
                             unpacked(r.role, "<i8").astype(np.int8), (unpacked(r.slack, "<i8") - 1).astype(np.int32)))
        for piece in range(PIECES):
            yield from collect(rows, piece)

    # a partition is a bucket, so nothing is sorted
    return blocks.repartitionById(buckets, "bucket").mapInPandas(run, GROUPS)


def _fits(r: Column | str, s: Column | str, percent: int) -> Column:
    """Sizes that can reach the similarity at all."""
    r, s = (F.col(x) if isinstance(x, str) else x for x in (r, s))
    return (F.least(r, s) * 100 >= F.greatest(r, s) * percent)


def _small(ids: DataFrame) -> DataFrame:
    """Broadcast a stored list of ids or pairs behind its count; beyond the
    bound the join shuffles."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("merge")


def _contents(docs: DataFrame, nodes: DataFrame, rows: DataFrame, n: int, repeats: bool) -> DataFrame:
    """(node, size, bitmap, elements) of the given nodes, read again from one
    document each. ``repeats``: ids may be given to several rows."""
    first = store(rows.join(nodes, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "jaccard-wanted")
    wanted = docs.select("doc_id", "text").join(_small(first), "doc_id")

    @releasing
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for node, t in zip(pdf.node, pdf.text):
                s = shingles(t, n)
                if digest(s) != node:  # another text under the same id
                    continue
                bits = 1 << max(6, int(len(s) - 1).bit_length())
                parity = np.bincount((s & U(bits - 1)).astype(np.int64), minlength=bits) & 1
                out.append((node, len(s), np.packbits(parity.astype(np.uint8), bitorder="little").tobytes(), s.tobytes()))
            if out:
                yield pd.DataFrame(out, columns=["node", "size", "bitmap", "elements"])
        hashes.clear()  # the last texts that are read: the workers go on without the memo

    found = wanted.mapInPandas(run, "node long, size long, bitmap binary, elements binary")
    return store(found.dropDuplicates(["node"]) if repeats else found, "jaccard-sets")


def _joined(pairs: DataFrame, contents: DataFrame, col: str) -> DataFrame:
    # the pairs are narrow: the wide sets are filtered and tagged before they are shuffled, once each
    one = contents.select(F.col("node").alias("a"), F.col("size").alias("na"), F.col(col).alias("xa"))
    two = contents.select(F.col("node").alias("b"), F.col("size").alias("nb"), F.col(col).alias("xb"))
    pairs = store(pairs.select("a", "b"), "jaccard-pairs")
    left = one.join(_small(store(pairs.select("a").distinct(), "jaccard-left")), "a", "left_semi")
    return two.join(_small(pairs), "b").join(left, "a")


def _near(pairs: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """Pairs whose parity bitmaps leave the similarity possible."""
    @releasing
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            for na, xa, nb, xb in zip(pdf.na, pdf.xa, pdf.nb, pdf.xb):
                size = min(len(xa), len(xb))
                x, y = (np.bitwise_xor.reduce(np.frombuffer(v, np.uint8).reshape(-1, size), axis=0) for v in (xa, xb))
                keep.append(int(np.bitwise_count(x ^ y).sum()) <= (na + nb) * (100 - percent) // (100 + percent))
            yield pdf.loc[keep, ["a", "b"]]

    return _joined(pairs, contents, "bitmap").mapInPandas(run, "a long, b long")


def _links(pairs: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets reach the similarity, verified on all elements."""
    @releasing
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            for xa, xb in zip(pdf.xa, pdf.xb):
                a, b = np.frombuffer(xa, U), np.frombuffer(xb, U)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[at] == a).sum())
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pdf.loc[keep, ["a", "b"]]

    return _joined(pairs, contents, "elements").mapInPandas(run, "a long, b long")


def _mixed(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the groups that hold different components, with ``c`` (their
    component) and ``probe``: whether the node keeps the key after dropping its
    most expensive ones."""
    members = (groups.where("not pivot").join(labels, "node", "left").withColumn("c", F.coalesce("component", "node"))
               .select("grp", "node", "size", "role", "slack", "held", "times", "c"))
    mixed = members.groupBy("grp").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("grp")
    costly = Window.partitionBy("node", "role").orderBy(F.col("held").desc(), "grp").rowsBetween(Window.unboundedPreceding, 0)
    return (members.join(mixed, "grp", "left_semi")
            .withColumn("probe", F.sum("times").over(costly) > F.col("slack")).drop("times", "slack"))


def _pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a group of up to HOT nodes, the
    larger set being the probe."""
    cold = members.where(F.col("held") <= HOT)
    a = cold.where("role = 0").select("grp", F.col("node").alias("a"), F.col("size").alias("na"), F.col("c").alias("ca"))
    b = cold.where("probe").select("grp", F.col("node").alias("b"), F.col("size").alias("nb"), F.col("c").alias("cb"))
    pairs = a.join(b, "grp").where((F.col("ca") != F.col("cb")) & (F.col("na") <= F.col("nb")) & _fits("na", "nb", percent))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _intersections(sets: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all pairs, above the diagonal. The sorted sets
    are read slice by slice of the universe, so that little is held beside them and
    the result."""
    n = len(sets)
    both = np.zeros((n, n), dtype=np.uint16 if size.max() < 1 << 16 else np.uint32)
    slices = int(-(-size.sum() // SLICE))
    cuts = np.array([(i << 64) // slices for i in range(1, slices)], dtype=U)
    at = np.array([[0, *np.searchsorted(s, cuts), len(s)] for s in sets])
    for i, j in zip(at.T, at.T[1:]):
        of, element = np.repeat(np.arange(n, dtype=np.int32), j - i), np.concatenate([s[x:y] for s, x, y in zip(sets, i, j)])
        if not len(element):
            continue
        order = np.argsort(element, kind="stable")
        of, element = of[order], element[order]
        first = np.flatnonzero(np.concatenate([[True], element[1:] != element[:-1]]))
        count = np.diff(np.append(first, len(element)))
        often = count[count >= 16]
        have, ends = of[np.repeat(count >= 16, count)], np.concatenate([[0], np.cumsum(often)])
        for c in range(0, len(often), COLUMNS):
            held = often[c:c + COLUMNS]
            x = np.zeros((n, len(held)), dtype=np.float32)
            x[have[ends[c]:ends[c + len(held)]], np.repeat(np.arange(len(held)), held)] = 1
            for r in range(0, n, STRIP):
                both[r:r + STRIP] += (x[r:r + STRIP] @ x.T).astype(both.dtype)
        rare = np.repeat((count >= 2) & (count < 16), count)
        of, element = of[rare], element[rare]
        for step in range(1, 16):
            same = np.flatnonzero(element[step:] == element[:-step])
            if not len(same):
                break
            np.add.at(both, (of[same], of[same + step]), 1)
    return both


def _compare(percent: int):
    """Links of a block pair of a cell that join different components."""
    def compared(pdf: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": [], "b": []}, dtype="int64")
        if not pdf.probe.any() or pdf.c.nunique() < 2:
            return none
        n, node = len(pdf), pdf.node.to_numpy()
        sets = [np.frombuffer(x, U) for x in pdf.elements]
        size = np.array([len(x) for x in sets])
        both = _intersections(sets, size)
        c, block, probe = pdf.c.to_numpy(), pdf.block.to_numpy(), pdf.probe.to_numpy(bool)
        across = pdf.lo.iloc[0] != pdf.hi.iloc[0]  # pairs within a block have their own task
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for at in range(0, n, STRIP):
            i = np.arange(at, min(at + STRIP, n))
            shared = both[i].astype(np.float64)
            near = 100 * shared >= percent * (size[i, None] + size[None, :] - shared)
            near &= (c[i, None] != c[None, :]) & (probe[i, None] | probe[None, :]) & (np.arange(n)[None, :] > i[:, None])
            if across:
                near &= block[i, None] != block[None, :]
            for k, j in np.argwhere(near).tolist():
                p, q = find(c[at + k]), find(c[j])
                if p != q:
                    root[max(p, q)] = min(p, q)
                    out.append((node[at + k], node[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64") if out else none

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = compared(pdf)
        if len(pdf) >= STRIP:  # not for the many small ones
            release()
        return out

    return run


def _cell_links(members: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """Links within groups of more than HOT nodes, block pair by block pair."""
    hot = members.where(F.col("held") > HOT)
    asked = hot.groupBy("grp").agg(F.max("probe").alias("any"), F.min("node").alias("a")).where("any")
    hot = store(hot.join(asked.select("grp", "a"), "grp"), "jaccard-hot")
    cells = components(hot.select("a", F.col("node").alias("b")).distinct())
    nodes = hot.groupBy("node").agg(F.max("probe").alias("probe"), F.first("c").alias("c"))
    nodes = nodes.join(cells.withColumnRenamed("component", "cell"), "node").join(contents.select("node", "size"), "node")
    totals = nodes.groupBy("cell").agg(F.greatest(F.ceil(F.sum("size") / CELL_ELEMENTS), F.ceil(F.count(F.lit(1)) / CELL_NODES)).cast("int").alias("blocks"))
    nodes = (nodes.join(totals, "cell").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    nodes = store(nodes, "jaccard-cells")
    dealt = contents.select("node", "elements").join(_small(nodes), "node").select(
        "cell", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "c", "probe", "elements")
    return dealt.groupBy("cell", "lo", "hi").applyInPandas(_compare(percent), "a long, b long")


def _exceptions(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of the sets without enough keys with all sets of their size range:
    an equi-join on the size band. One such set in a billion is expected."""
    bands = Bands(percent)
    # the band: how many band starts lie at or below the size
    band = F.size(F.filter(F.lit(bands.low), lambda a: a <= F.col("n_shingles"))) - 1
    nodes = (rows.where("n_shingles > 0 and doc_id is not null").select("node", "n_shingles", "exception").distinct()
             .withColumn("band", band))
    e = (nodes.where("exception").select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("band"))
         .withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))))
    pairs = e.join(nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), "band"), "band")
    pairs = pairs.where((F.col("a") != F.col("b")) & _fits("na", "nb", percent))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def node_links(docs: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """Verified links (a, b) between nodes that join all similar sets."""
    with joins_broadcast_up_to(docs.sparkSession, BROADCAST_BYTES):
        return _node_links(docs, rows, n, percent)


def _node_links(docs: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = bucket_count(total)
    groups = store(_groups(_blocks(docs, n, percent, buckets), buckets, percent), "jaccard-groups")
    # round 1: one pivot a node, the one with most shared keys
    stars = (groups.where("pivot").groupBy("node", "grp").agg(F.sum("times").alias("times"))
             .groupBy("node").agg(F.max(F.struct("times", "grp")).alias("best")))
    pairs = stars.select(F.col("best.grp").alias("a"), F.col("node").alias("b"))
    odd = _exceptions(rows, percent)
    named = groups.where("not pivot").select("node").distinct()
    if rows.where("exception").limit(1).count():
        odd = store(odd, "jaccard-odd")
        named = named.unionByName(odd.select(F.col("a").alias("node"))).unionByName(odd.select(F.col("b").alias("node"))).distinct()
    else:
        odd = None
    contents = _contents(docs, named, rows.where("doc_id is not null"), n, docs_repeat(rows.where("doc_id is not null")))
    one = store(_links(_near(pairs, contents, percent), contents, percent), "jaccard-links")
    labels = components(one)
    members = store(_mixed(groups, labels), "jaccard-mixed")
    later = _pairs(members, percent)
    if odd is not None:
        later = later.unionByName(odd).distinct()
    two = _links(_near(later, contents, percent), contents, percent)
    return one.unionByName(store(two.unionByName(_cell_links(members, contents, percent)), "jaccard-links"))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    rows = store(sets(docs, n, percent), "jaccard-rows")
    links = node_links(docs, rows, n, percent)
    with joins_broadcast_up_to(docs.sparkSession, BROADCAST_BYTES):
        of_node = store(_components_of(rows, links), "jaccard-classes")
    out = rows.join(_small(of_node), "node", "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))


def _components_of(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component_id) of every node, the least document of its class."""
    named = rows.where("doc_id is not null")
    filled = named.where("n_shingles > 0")
    if docs_repeat(named):  # one id with several texts joins their nodes
        links = links.unionByName(filled.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
                                  .where("a <> b").select("a", "b"))
        links = links.unionByName(filled.select("doc_id", F.col("node").alias("b"))
                                  .join(filled.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").select("a", "b"))
    labels = components(links)
    of_node = filled.groupBy("node").agg(F.min("doc_id").alias("least"))
    classes = of_node.join(labels, "node", "left").withColumn("class", F.coalesce("component", "node"))
    least = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    # nodes alone in their class need no second look-up: their least document is the class's
    return classes.join(least, "class").select("node", "component_id")


def docs_repeat(named: DataFrame) -> bool:
    return bool(named.groupBy("doc_id").count().where("count > 1").limit(1).count())


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, the one of
    the smallest id (of rows with equal ids and texts, one); all columns kept.
    Documents without words and rows without an id are no duplicates and stay.
    An id with several texts does not make these near duplicates."""
    if docs_repeat(docs.where("doc_id is not null").select("doc_id")):
        return _keep_one_text(docs, n, percent)
    found = near_duplicates(docs, n, percent)
    gone = found.where("doc_id is not null and component_id <> doc_id").select("doc_id").distinct()
    return docs.join(_small(store(gone, "jaccard-gone")), "doc_id", "left_anti")


def _keep_one_text(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """As ``keep_one``, where ids repeat: by id and node."""
    @F.pandas_udf("long")
    def node(texts: pd.Series) -> pd.Series:
        return pd.Series([digest(shingles(t, n)) for t in texts], dtype="int64")

    rows = store(sets(docs, n, percent), "jaccard-rows")
    links = node_links(docs, rows, n, percent)
    with joins_broadcast_up_to(docs.sparkSession, BROADCAST_BYTES):
        labels = components(links)
        filled = rows.where("doc_id is not null and n_shingles > 0").select("doc_id", "node").distinct()
        classes = filled.join(labels, "node", "left").withColumn("class", F.coalesce("component", "node"))
        first = classes.groupBy("class").agg(F.min(F.struct("doc_id", "node")).alias("first"))
        gone = classes.join(first, "class").where("doc_id <> first.doc_id or node <> first.node").select("doc_id", "node")
        gone = store(gone, "jaccard-gone")
    name = free_name(docs, "_node")
    kept = docs.withColumn(name, node("text")).join(_small(gone.withColumnRenamed("node", name)), ["doc_id", name], "left_anti")
    kept = kept.where("doc_id is not null").dropDuplicates(["doc_id", name]).unionByName(kept.where("doc_id is null"))
    return kept.select(docs.columns)
