"""Exact top-k inner products: every query row against all rows.

Rows are sparse integer vectors: component x of a vector becomes the weight
floor(256 x) of the term with its position; terms of weight zero are not kept.
Term at a time: a task turns its rows, a block at a time, into postings (for
each term the rows that hold it and their weights); a query then walks its
terms and scatters query weight times posting weights into one dense array of
scores, one cell a row of the block. No row is skipped and nothing is bounded
away, so the result is exact. The k best cells of a block are taken by
partition selection, and the blocks' lists are merged by a limited window.

The candidates are read where they lie and never shuffled. Queries go to the
tasks in blocks of at most about ``query_cells`` terms (a stated bound for the
broadcast), one pass over the candidates each; a pass's result is a written
table, so a lost executor repeats tasks of one pass only.

Defined results: a vector that is null or holds a null or non-finite component
is neither query nor candidate. Vectors of different lengths meet in the terms
that both have; an empty vector scores 0. A null id is never a query; as a
candidate it comes after all other ids in a tie. All rows with the query's id
are its own rows. Query rows equal in id and components are one query, and rows
of one id with different components are queries of their own. Candidate rows that
repeat are rows of their own. Scores are exact whatever the components' size; one
beyond 64 bits counts as the nearest 64-bit number.
With fewer than k other rows all are returned. Other columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedrec.llm.common import store

SCALE = 256
EXACT = float(2 ** 53)  # integers up to here, and sums that stay below it, are exact in doubles
LONG = np.iinfo(np.int64)


class Rows:
    """Vectors side by side, in the order of their ids, null ones (``ids``
    beyond ``known``) last: for each kept term its row, position and component."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, lengths: np.ndarray, x: np.ndarray):
        order = np.lexsort((ids, null))  # ties between scores go to the smaller id
        self.known = len(ids) - int(null.sum())
        start = np.cumsum(lengths) - lengths
        take = np.repeat(start[order] - (np.cumsum(lengths[order]) - lengths[order]), lengths[order]) + np.arange(len(x))
        self.ids, lengths, self.x = ids[order], lengths[order], x[take]
        with np.errstate(over="ignore"):
            self.weight = np.floor(SCALE * self.x)
        self.row = np.repeat(np.arange(len(ids)), lengths)
        self.term = np.arange(len(x)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        kept = self.weight != 0
        self.row, self.term, self.x, self.weight = self.row[kept], self.term[kept], self.x[kept], self.weight[kept]


def whole(x: float) -> int:
    """floor(256 x) as a Python integer, exact for any finite x."""
    return int(x) * SCALE if abs(x) >= 2.0 ** 52 else math.floor(SCALE * x)


class Postings:
    """The term lists of one block of candidates."""

    def __init__(self, rows: Rows):
        self.ids, self.known, self.n = rows.ids, rows.known, len(rows.ids)
        self.most = float(np.abs(rows.weight).max(initial=0.0))
        order = np.argsort(rows.term, kind="stable")
        terms, start = np.unique(rows.term[order], return_index=True)
        end = [*start[1:].tolist(), len(order)]
        self.lists = {t: (rows.row[order[a:b]], rows.weight[order[a:b]], rows.x[order[a:b]])
                      for t, a, b in zip(terms.tolist(), start.tolist(), end)}

    def scores(self, terms: list[int], weights: list[float], x: list[float]) -> np.ndarray:
        """One query's scores over all rows of the block."""
        if sum(map(abs, weights)) * self.most < EXACT:
            score, part = np.zeros(self.n), np.empty(self.n)
            for t, w in zip(terms, weights):
                if (found := self.lists.get(t)) is not None:
                    if len(found[0]) == self.n:  # every row has the term: its cells are the array itself
                        score += np.multiply(found[1], w, out=part)
                    else:
                        score[found[0]] += found[1] * w
            return score
        score = np.zeros(self.n, dtype=object)  # Python integers
        for t, v in zip(terms, x):
            if (found := self.lists.get(t)) is not None:
                score[found[0]] += np.array([whole(c) * whole(v) for c in found[2].tolist()], dtype=object)
        return np.array([min(max(s, LONG.min), LONG.max) for s in score], dtype=np.int64)

    def best(self, own: int, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best, leaving out the query's own rows."""
        ids = self.ids[:self.known]
        lo, hi = np.searchsorted(ids, own), np.searchsorted(ids, own, side="right")
        if hi > lo:
            rest = np.concatenate([np.arange(lo), np.arange(hi, self.n)])
            score = score[rest]
        else:
            rest = None
        if len(score) > k:
            cut = np.partition(score, len(score) - k)[len(score) - k]
            above = np.flatnonzero(score > cut)
            found = np.concatenate([above, np.flatnonzero(score == cut)[:k - len(above)]])
        else:
            found = np.arange(len(score))
        return (found if rest is None else rest[found]), score[found]


def _blocks(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[Rows]:
    """Rows in blocks of at most about ``cells`` components (a row costs some too)."""
    parts, size = [], 0
    for batch in batches:
        null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
        lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends, a, at = np.cumsum(lengths + 1), 0, 0
        while a < len(ids):  # a batch can be larger than a block
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + cells - size, side="right")))
            n = int(lengths[a:b].sum())
            parts.append((ids[a:b], null[a:b], lengths[a:b], x[at:at + n]))
            size, a, at = size + n + b - a, b, at + n
            if size >= cells:
                yield Rows(*map(np.concatenate, zip(*parts)))
                parts, size = [], 0
    if parts:
        yield Rows(*map(np.concatenate, zip(*parts)))


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    sound = ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
            .where(F.col("x").isNotNull() & sound))


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          query_cells: int = 4_000_000, block_cells: int = 2_000_000) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of ``candidates``
    for every row of ``queries``, best first, ties to the smaller id."""
    spark = queries.sparkSession
    asked = store(_vectors(queries, id_col, vector_col).where("id is not null").distinct(), "queries")
    cells = asked.agg(F.sum(F.size("x") + 1)).first()[0] or 0
    n_blocks = -(-cells // query_cells)
    rows = _vectors(candidates, id_col, vector_col)
    passes = [_pass(asked.where(F.pmod(F.xxhash64("id", "x"), F.lit(n_blocks)) == b), rows, k, block_cells)
              for b in range(n_blocks)]
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for p in passes:
        out = out.unionByName(p) if p is not None else out
    return out


def _pass(block: DataFrame, rows: DataFrame, k: int, block_cells: int) -> DataFrame | None:
    """One block of queries against all rows; None for a block without any."""
    asked = block.toArrow()  # at most about query_cells numbers
    n = len(asked)
    if not n:
        return None
    lengths = np.array([len(v) for v in asked.column("x")], dtype=np.int64)
    flat = np.concatenate([np.asarray(c.flatten(), dtype=np.float64) for c in asked.column("x").chunks] or [np.empty(0)])
    q = Rows(asked.column("id").to_numpy(), np.zeros(n, dtype=bool), lengths, flat)
    cut = np.searchsorted(q.row, np.arange(n + 1)).tolist()
    shared = block.sparkSession.sparkContext.broadcast((q.ids.tolist(), cut, q.term, q.weight, q.x))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cut, term, weight, x = shared.value
        for found in _blocks(batches, block_cells):
            postings = Postings(found)
            no, at, scores = [], [], []
            for i, own_id in enumerate(own):
                part = slice(cut[i], cut[i + 1])
                best, score = postings.best(own_id, postings.scores(term[part].tolist(), weight[part].tolist(), x[part].tolist()), k)
                no.append(np.full(len(best), i))
                at.append(best)
                scores.append(score.astype(np.int64))
            no, at = np.concatenate(no), np.concatenate(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(no), pa.array(np.array(own, dtype=np.int64)[no]),
                 pa.array(found.ids[at], mask=at >= found.known), pa.array(np.concatenate(scores))],
                names=["query_no", "query_id", "vec_id", "score"])

    best = Window.partitionBy("query_no").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    found = (rows.mapInArrow(search, "query_no long, query_id long, vec_id long, score long").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
             .select("query_id", "rank", "vec_id", "score"))
    out = store(found, "top-k")
    shared.destroy()
    return out


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``top_k`` of the rows whose id ``every`` divides against all rows."""
    return top_k(vectors.where(F.col(id_col) % every == 0), vectors, k, id_col, vector_col)
