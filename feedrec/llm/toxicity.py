"""Toxicity by class-conditional Kneser-Ney models.

Two models, toxic and ordinary, are counted over a bounded sample of labelled
rows. Counts are continuation counts (distinct left contexts), so a passage
copied a thousand times counts once. Per class y:

    P_y(w | h) = max(n_y(h, w) - D2, 0) / n_y(h) + b_y(h) P_y(w)
    P_y(w)     = max(n_y(w) - D1, 0) / n_y       + l_y P(w)

n_y(h, w): distinct words before the pair, n_y(w): distinct words before w, P:
the continuation distribution of both classes together, the shared backoff by
which rare expressions cost both classes the same. Words seen once in the sample
share one token per five-letter stem. The discounts (D2 = 4 D1) are large, so
that only words and pairs found in many contexts can tell the classes apart.

A text is read in windows of ``window`` words; a window's value is the toxic
minus the ordinary log-likelihood divided by its length, a text's value the
largest of its windows (the text itself if shorter). D1 is chosen and the value
is turned into a score between 0 and 1 by a logistic fit on the sample's fold 1,
which is not counted.

Defined results: null text is the empty text; a text without letters has value
0; without labelled rows of both classes every score is 0; repeated rows are
scored each; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedrec.llm.common import fold, releasing, sample_labelled, store

LETTERS = re.compile(r"[^\W\d_]+")
STEM = 5


@dataclass(frozen=True)
class ToxicityParams:
    max_toxic: int = 3000  # labelled rows read per class: the bound of the training sample
    max_ordinary: int = 6000
    discounts: tuple[float, ...] = (1.0, 2.0, 4.0, 8.0, 12.0, 16.0)
    window: int = 4
    threshold: float = 0.5


class Tokens(dict):
    """word -> id; a word not in the table takes its stem's id or the last id."""

    def __init__(self, names: list[str]):
        super().__init__((t, i) for i, t in enumerate(names))
        self.unknown = len(names)
        self.known = len(names)

    def __missing__(self, w: str) -> int:
        i = self.get(w[:STEM] + "*", self.unknown)
        if len(self) < self.known + 100_000:  # a memory bound of the memo
            self[w] = i
        return i


class Model:
    """Arrays over token ids; pairs as sorted keys ``h * size + w``."""

    def __init__(self, names, n_uni, n_shared, n_ctx, pairs, d1: float):
        """n_uni, n_ctx: [2, tokens] counts; pairs: (key, n0, n1) arrays."""
        d2, size = 4 * d1, len(names) + 1
        pad = lambda a: np.append(a, 0.0)
        self.names, self.size = names, size
        shared = (pad(n_shared) + 0.5) / (n_shared.sum() + 0.5 * size)
        key, *n = pairs
        heavy = (n[0] > d2) | (n[1] > d2)
        self.key = key[heavy]
        h = self.key // size
        self.uni, self.back, self.extra = [], [], []
        for y in (0, 1):
            total = max(n_uni[y].sum(), 1.0)
            lam = np.minimum(n_uni[y], d1).sum() / total if n_uni[y].sum() else 1.0
            self.uni.append(pad(np.maximum(n_uni[y] - d1, 0)) / total + lam * shared)
            ctx = pad(n_ctx[y])
            gain = np.maximum(n[y][heavy] - d2, 0)
            rest = ctx - np.bincount(h, weights=gain, minlength=size)
            self.back.append(np.where(ctx > 0, rest / np.maximum(ctx, 1), 1.0))
            self.extra.append(gain / np.maximum(ctx[h], 1))

    def ratios(self, ids: np.ndarray) -> np.ndarray:
        """Toxic minus ordinary log-probability of each token."""
        p = [u[ids] for u in self.uni]
        if len(ids) > 1:
            h, w = ids[:-1], ids[1:]
            for y in (0, 1):
                p[y][1:] *= self.back[y][h]
            if len(self.key):
                k = h * self.size + w
                at = np.minimum(np.searchsorted(self.key, k), len(self.key) - 1)
                hit = self.key[at] == k
                for y in (0, 1):
                    p[y][1:][hit] += self.extra[y][at[hit]]
        return np.log(p[1] / p[0])

    def value(self, ids: np.ndarray, window: int) -> float:
        if not len(ids):
            return 0.0
        sums = np.concatenate([[0.0], np.cumsum(self.ratios(ids))])
        k = min(window, len(ids))
        return float((sums[k:] - sums[:-k]).max() / k)


def _ids(tokens: Tokens, text: str | None) -> np.ndarray:
    return np.array(list(map(tokens.__getitem__, LETTERS.findall(text.lower()))) if text else [], dtype=np.int64)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps with a small ridge."""
    m, s = x.mean(), x.std() or 1.0
    z = np.stack([(x - m) / s, np.ones_like(x)], axis=1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, z.T @ (y - p) - 1e-2 * b)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0] / s), float(b[1] - b[0] * m / s)


def _counts(sample: DataFrame):
    """Token names and their counts over the sample, by Spark aggregates; what
    reaches the driver is bounded by the sample."""
    spark = sample.sparkSession

    @releasing
    def word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            c = Counter()
            for t in pdf.text:
                c.update(LETTERS.findall(t.lower()))
            if c:
                yield pd.DataFrame({"w": list(c), "n": np.fromiter(c.values(), np.int64, len(c))})

    token = F.when(F.col("n") >= 2, F.col("w")).otherwise(F.concat(F.substring("w", 1, STEM), F.lit("*")))
    names = sorted(r.t for r in sample.mapInPandas(word_counts, "w string, n long")
                   .groupBy("w").agg(F.sum("n").alias("n")).select(token.alias("t")).distinct().collect())
    size = len(names) + 1
    table = spark.sparkContext.broadcast(names)

    @releasing
    def types(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = Tokens(table.value)
        for pdf in batches:
            for y, part in pdf.groupby("y"):
                before, pair = [], []
                for t in part.text:
                    ids = _ids(tokens, t)
                    if len(ids):
                        a = np.concatenate([[size, size], ids])
                        before.append(a[:-2])
                        pair.append(a[1:-1] * size + a[2:])
                if pair:
                    u = np.unique(np.stack([np.concatenate(pair), np.concatenate(before)]), axis=1)
                    yield pd.DataFrame({"y": y, "pair": u[0], "before": u[1]})

    pairs = store(sample.mapInPandas(types, "y int, pair long, before long").distinct()
                  .groupBy("y", "pair").agg(F.count(F.lit(1)).alias("n")), "toxicity-pairs")
    w, h = F.pmod("pair", F.lit(size)).alias("w"), F.floor(F.col("pair") / size).alias("h")

    def column(df: DataFrame, key: str, val: str, y: int | None) -> np.ndarray:
        pdf = (df if y is None else df.where(F.col("y") == y)).select(key, val).toPandas()
        out = np.zeros(size + 1)
        out[pdf[key].to_numpy(np.int64)] = pdf[val].to_numpy(np.float64)
        return out[:size - 1]

    uni = pairs.groupBy("y", w).agg(F.count(F.lit(1)).alias("n"))
    ctx = pairs.groupBy("y", h).agg(F.sum("n").alias("n"))
    shared = pairs.select("pair").distinct().groupBy(w).agg(F.count(F.lit(1)).alias("n"))
    heavy = (pairs.groupBy("pair").agg(F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("n0"),
                                       F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("n1"))
             .where((F.greatest("n0", "n1") > 4) & (F.col("pair") < size * size)).toPandas().sort_values("pair"))
    return (names, np.stack([column(uni, "w", "n", y) for y in (0, 1)]), column(shared, "w", "n", None),
            np.stack([column(ctx, "h", "n", y) for y in (0, 1)]),
            (heavy["pair"].to_numpy(np.int64), heavy.n0.to_numpy(np.float64), heavy.n1.to_numpy(np.float64)))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5,
          p: ToxicityParams = ToxicityParams()) -> tuple[Model, float, float] | None:
    """(model, slope, offset), or None without rows of both classes to count
    and to fit."""
    sample = store(sample_labelled(docs, labels, "toxic", folds, {1: p.max_toxic, 0: p.max_ordinary}), "toxicity-sample")
    tuning = fold(F.col("doc_id"), folds) == 1
    counts = _counts(sample.where(~tuning))
    held = sample.where(tuning)
    if {r.y for r in held.select("y").distinct().collect()} != {0, 1} or not counts[1].sum(axis=1).all():
        return None
    best = None
    spark = docs.sparkSession
    models = [Model(*counts, d) for d in p.discounts]
    shipped = spark.sparkContext.broadcast(models)

    @releasing
    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = Tokens(shipped.value[0].names)
        for pdf in batches:
            ids = [_ids(tokens, t) for t in pdf.text]
            yield pd.DataFrame({"y": pdf.y, "v": [[m.value(x, p.window) for m in shipped.value] for x in ids]})

    pdf = held.mapInPandas(values, "y int, v array<double>").toPandas()
    y, v = pdf.y.to_numpy(np.float64), np.array(pdf.v.tolist())
    for i, m in enumerate(models):
        a, b = _logistic(v[:, i], y)
        q = np.clip(1 / (1 + np.exp(-np.clip(a * v[:, i] + b, -30, 30))), 1e-6, 1 - 1e-6)
        loss = -np.mean(y * np.log(q) + (1 - y) * np.log(1 - q))
        if a > 0 and (best is None or loss < best[0]):
            best = (loss, m, a, b)
    shipped.unpersist()
    return best and best[1:]


def score(docs: DataFrame, fitted: tuple[Model, float, float] | None, p: ToxicityParams = ToxicityParams()) -> Column:
    """The score of the column ``text``; other columns stay where they are."""
    model = docs.sparkSession.sparkContext.broadcast(fitted)  # bounded by the sample

    @F.pandas_udf("double")
    @releasing
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = Tokens(model.value[0].names) if model.value else None
        for texts in batches:
            out = np.zeros(len(texts))
            if model.value:
                m, a, b = model.value
                v = np.array([m.value(_ids(tokens, t), p.window) for t in texts], dtype=np.float64)
                out = 1 / (1 + np.exp(-np.clip(a * v + b, -30, 30)))
            yield pd.Series(out)

    return run("text")


def accepted(docs: DataFrame, labels: DataFrame, folds: int = 5, p: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold."""
    return docs.where(score(docs, train(docs, labels, folds, p), p) < p.threshold)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, p: ToxicityParams = ToxicityParams()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    scored = docs.select("doc_id", score(docs, train(docs, labels, folds, p), p).alias("score"))
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
                         (F.col("score") >= p.threshold).cast("int").alias("predicted"))
