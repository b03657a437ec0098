"""LM scores from a weighted backoff automaton.

Model: bigrams with absolute discounting over additively smoothed unigrams.
With c the training counts, N all training tokens, V the distinct ones, K(h) the
followers of h, those seen once among them:

    P(w)     = (c(w) + 0.1) / (N + 0.1 (V + 1))
    P(w | h) = [w in K(h)] (c(hw) - D) / c(h) + b(h) P(w)
    b(h)     = 1 - sum over K(h) of (c(hw) - D) / c(h) = D |K(h)| / c(h),  1 if c(h) = 0

As an automaton: the root is the empty context, every context with an arc in
K(h) is a state, a failure arc of weight b(h) leads from it to the root, and
reading w leads to the state of w. ``traverse`` is that walk for one text; the
tasks do the same walk, left to right, for all texts of a chunk at once (the
state after a token depends on the token alone).

The model grows with the corpus, so no task holds it whole. Three passes over
the texts, in chunks of ``chunk_chars`` characters:

1. every chunk writes its distinct bigrams with their training counts as sorted
   key blocks; a bucket adds them up and sends back, per chunk, the sums that the
   chunk cannot know: a bigram whose training occurrences all lie in one chunk has
   the count that this chunk found, and goes to the other chunks that hold it;
2. every chunk writes its distinct words with their counts and, for the bigrams
   it owns (one chunk each), how many follow a word; buckets of words add
   up and send back c and b;
3. every chunk builds the part of the automaton that its texts can reach and
   walks them through it.

What is sent back lies in the shared folder, one directory per chunk, and is
read by the task that holds the chunk; the texts are never shuffled. A chunk's
name is a digest of its rows and its task, so a task that finds other rows than
in an earlier pass fails instead of scoring with a wrong table. Words and bigrams
are known by 64-bit hashes.

Defined results: null text is the empty text (the end token alone); a null
doc_id counts as held out; repeated rows are learned from and scored each; with
nothing to learn from every probability is 1; an empty table gives no rows;
other columns are ignored."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedrec.llm.blocks import ODD, U, bucket_cuts, key_planes, key_unplanes, mix, planes, unplanes, word_hashes
from feedrec.llm.common import fold, shared_folder, store, words

DISCOUNT = 0.75
BOS, END = U(0x5EED0001), U(0x5EED0002)  # the contexts and tokens that are no words
BUCKET_KEYS = 700_000


def traverse(tokens: list[str], bigrams: dict, count: dict, total: int, distinct: int) -> float:
    """log10 probability of ``tokens`` (words, then the end token "") by the
    automaton of counts, one token at a time."""
    state, out = None, 0.0
    for w in tokens:
        low = (count.get(w, 0) + 0.1) / (total + 0.1 * (distinct + 1))
        arcs = {k[1]: n for k, n in bigrams.items() if k[0] == state and n > 0}
        c = sum(n for k, n in bigrams.items() if k[0] == state)
        fail = 1 - sum(n - DISCOUNT for n in arcs.values()) / c if c else 1.0
        out += math.log10(((arcs[w] - DISCOUNT) / c if w in arcs else 0.0) + fail * low)
        state = w
    return out


class Chunk:
    """Texts of one task, side by side: ``token`` (words, then the end) and
    ``before`` each; ``start`` of each document."""

    def __init__(self, rows: list[tuple], task: int):
        self.doc_id = [r[0] for r in rows]
        self.held_out = np.array([r[1] for r in rows], dtype=bool)
        h = [r[2] for r in rows]
        size = np.array([len(x) + 1 for x in h])
        self.size, self.start = size, np.cumsum(size) - size
        end = self.start + size - 1
        self.token = np.empty(int(size.sum()), U)
        body = np.ones(len(self.token), dtype=bool)
        body[end] = False
        self.token[body] = np.concatenate(h)
        self.token[end] = END
        self.before = np.empty_like(self.token)
        self.before[1:] = self.token[:-1]
        self.before[self.start] = BOS
        self.learn = np.repeat(~self.held_out, size)
        d = hashlib.blake2b(repr((task, self.doc_id)).encode() + size.tobytes(), digest_size=8)
        self.name = int.from_bytes(d.digest(), "little") >> 1

    def pairs(self) -> np.ndarray:
        return mix(self.before * ODD[2] + self.token)


def _chunks(batches: Iterator[pd.DataFrame], chunk_chars: int) -> Iterator[Chunk]:
    task, rows, chars = TaskContext.get().partitionId(), [], 0
    for pdf in batches:
        for doc_id, held_out, text in zip(pdf.doc_id.array, pdf.held_out, pdf.text):
            rows.append((None if pd.isna(doc_id) else int(doc_id), bool(held_out), word_hashes(words(text))))
            chars += len(text or "") + 200  # a row costs something whatever its text
            if chars >= chunk_chars:
                yield Chunk(rows, task)
                rows, chars = [], 0
    if rows:
        yield Chunk(rows, task)


def _counted(keys: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their training counts, the keys' order, and where in it
    each distinct key starts."""
    order = np.argsort(keys)
    key = keys[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[start], np.add.reduceat(learn[order], start, dtype=np.int64), order, start


def _cut(chunk: int, u: np.ndarray, buckets: int, *values: np.ndarray) -> pd.DataFrame:
    cut = bucket_cuts(u, buckets)
    rows = [(b, chunk, key_planes(u[i:j]), *(planes(v[i:j].astype("<i8")) for v in values))
            for b, (i, j) in enumerate(zip(cut.tolist(), cut[1:].tolist())) if i < j]
    return pd.DataFrame(rows, columns=["bucket", "chunk", "keys", *("vwx"[:len(values)])])


def _by_bucket(batches: Iterator[pd.DataFrame]) -> Iterator[list]:
    rows, bucket = [], None
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            if rows and r.bucket != bucket:
                yield rows
                rows = []
            bucket = r.bucket
            rows.append(r)
    if rows:
        yield rows


def _added(rows: list, names: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """All keys of a bucket in order of (key, chunk): the row each came from,
    whether it is the first of its key, and per value its own and the sum over
    its key."""
    keys = [key_unplanes(r.keys) for r in rows]
    origin = np.repeat(np.arange(len(rows)), [len(k) for k in keys])
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    key, origin = key[order], origin[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(key)))
    own = [np.concatenate([unplanes(getattr(r, c), "<i8") for r in rows])[order] for c in names]
    return key, origin, new, own, [np.repeat(np.add.reduceat(v, first), count) for v in own]


def _dealt(df: DataFrame, buckets: int) -> DataFrame:
    return df.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk")


def _load(folder: str, chunk: int, names: str) -> list[np.ndarray] | None:
    """Keys and values that were sent back to a chunk, sorted by key."""
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSelector, FileSystem

    fs, at = FileSystem.from_uri(folder)
    found = fs.get_file_info(FileSelector(f"{at}/chunk={chunk}", allow_not_found=True))
    files = [f.path for f in found if f.path.endswith(".parquet") and not f.base_name.startswith((".", "_"))]
    if not files:
        return None
    rows = [r for f in sorted(files) for r in pq.ParquetFile(f, filesystem=fs).read().to_pylist()]
    out = [np.concatenate([key_unplanes(r["keys"]) for r in rows])]
    out += [np.concatenate([unplanes(r[c], "<i8") for r in rows]) for c in names]
    order = np.argsort(out[0], kind="stable")
    return [x[order] for x in out]


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def _bigrams(folder: str, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct bigrams of a chunk: their training counts in all chunks,
    whether the chunk owns them, the tokens' order by bigram, and where in it
    each bigram starts."""
    pair, total, order, start = _counted(chunk.pairs(), chunk.learn)
    owner = total > 0
    if (sent := _load(folder, chunk.name, "vw")) is not None:
        at, hit = _find(pair, sent[0])
        if not hit.all():
            raise RuntimeError("the rows of a task changed between two passes")
        total[at], owner[at] = sent[1], sent[2] == 1
    return total, owner, order, start


def _send_back(df: DataFrame, name: str) -> str:
    """Write one directory per chunk in the shared folder."""
    folder = shared_folder(df.sparkSession, name)
    df.repartition("chunk").write.partitionBy("chunk").parquet(folder)
    return folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "file://", 1)


def scores(docs: DataFrame, folds: int = 10, chunk_chars: int = 8_000_000, staged: bool = False) -> DataFrame:
    """Scores of every row of ``docs``. ``staged``: docs is read straight from
    files, so every pass sees the same partitions; otherwise it is written to
    the shared folder first."""
    docs = docs.select("doc_id", "text")
    docs = (docs if staged else store(docs, "lm-docs"))
    docs = docs.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "text")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(8, -(-chars // (9 * BUCKET_KEYS)))  # a key for about nine characters

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(batches, chunk_chars):
            u, n, _, _ = _counted(chunk.pairs(), chunk.learn)
            yield _cut(chunk.name, u, buckets, n)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_bucket(batches):
            key, origin, new, (own,), (total,) = _added(rows, "v")
            whole = (total > 0) & (own == total)  # the chunk knows it all, and owns it
            first = np.flatnonzero(new)
            other = np.repeat(np.logical_or.reduceat(whole, first), np.diff(np.append(first, len(key))))
            kept = (total > 0) & ~whole
            key, origin, total, owner = key[kept], origin[kept], total[kept], (new & ~other)[kept]
            order = np.argsort(origin, kind="stable")
            cut = np.searchsorted(origin[order], np.arange(len(rows) + 1))
            out = [(rows[i].chunk, key_planes(key[at]), planes(total[at].astype("<i8")), planes(owner[at].astype("<i8")))
                   for i in range(len(rows)) if len(at := order[cut[i]:cut[i + 1]])]
            yield pd.DataFrame(out, columns=["chunk", "keys", "v", "w"])

    block = "bucket int, chunk long, keys binary, v binary"
    asked = _dealt(docs.mapInPandas(ask, block), buckets)
    bigrams = _send_back(asked.mapInPandas(add, "chunk long, keys binary, v binary, w binary"), "lm-bigrams")

    def ask_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(batches, chunk_chars):
            u, n, _, _ = _counted(np.append(chunk.token, BOS), np.append(chunk.learn, False))
            n[u == BOS] = int((~chunk.held_out).sum())
            _, owner, order, start = _bigrams(bigrams, chunk)
            h = np.searchsorted(u, chunk.before[order[start[owner]]])
            yield _cut(chunk.name, u, buckets, n, np.bincount(h, minlength=len(u)))

    def add_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _by_bucket(batches):
            key, origin, new, _, sums = _added(rows, "vw")
            word = new & (key != BOS) & (sums[0] > 0)
            order = np.argsort(origin, kind="stable")
            cut = np.searchsorted(origin[order], np.arange(len(rows) + 1))
            out = [(r.chunk, key_planes(key[at]), *(planes(s[at].astype("<i8")) for s in sums), 0, 0)
                   for i, r in enumerate(rows) for at in [order[cut[i]:cut[i + 1]]]]
            out.append((-1, b"", b"", b"", int(sums[0][word].sum()), int(word.sum())))
            yield pd.DataFrame(out, columns=["chunk", "keys", "v", "w", "total", "distinct"])

    asked = _dealt(docs.mapInPandas(ask_words, block + ", w binary"), buckets)
    folder = _send_back(asked.mapInPandas(
        add_words, "chunk long, keys binary, v binary, w binary, total long, distinct long"), "lm-words")
    spark = docs.sparkSession
    stats = (spark.read.schema("total long, distinct long, chunk long").parquet(folder).where("chunk = -1")
             .agg(F.sum("total"), F.sum("distinct")).first()) if chars or docs.limit(1).count() else (0, 0)
    n_all, n_distinct = int(stats[0] or 0), int(stats[1] or 0)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(batches, chunk_chars):
            sent = _load(folder, chunk.name, "vw")
            if sent is None:
                raise RuntimeError("the rows of a task changed between two passes")
            word, count, arcs = sent
            t, known = _find(word, chunk.token)
            h = np.empty_like(t)
            h[1:] = t[:-1]
            h[chunk.start] = np.searchsorted(word, BOS)
            if not known.all():
                raise RuntimeError("the rows of a task changed between two passes")
            low = (count[t] + 0.1) / (n_all + 0.1 * (n_distinct + 1))
            context = np.maximum(count[h], 1)
            of_pair, _, order, start = _bigrams(bigrams, chunk)
            n = np.empty_like(of_pair, shape=len(order))
            n[order] = np.repeat(of_pair, np.diff(np.append(start, len(order))))
            p = np.where(count[h] > 0, DISCOUNT * arcs[h] / context, 1.0) * low + np.where(n > 0, (n - DISCOUNT) / context, 0.0)
            total = lambda x: np.add.reduceat(x, chunk.start)
            out = pd.DataFrame({"held_out": chunk.held_out, "n_tokens": chunk.size, "n_known": total((count[t] > 0).astype(np.int64)),
                                "train_tokens": n_all, "base_score": total(np.log10(low)), "score": total(np.log10(p))})
            out.insert(0, "doc_id", pd.array(chunk.doc_id, "Int64"))
            yield out

    return docs.mapInPandas(walk, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                  "base_score double, score double")
