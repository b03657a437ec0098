"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader (FTRL-proximal) updates, scored as sparse dot
products.

Tokens are lower-cased words and punctuation runs; a token that equals the one
before it is the token ``<same>``. Features are unigrams and bigrams hashed to
2^bits slots; a document's feature value is its share of the n-grams, times
``SCALE``. Training reads a bounded sample of labelled rows (``max_rows`` per
class), split by id hash over ``replicas`` learners whose weights are averaged;
each learner reshuffles its rows in a fixed order per epoch.

Defined results: null text scores as the empty text, which scores as the bias
alone; repeated rows are scored each; without labelled rows (or with one class
only) every score is 0.5; an empty table gives no rows; other columns of the
input are ignored."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedrec.llm.common import fold, sample_labelled

TOKEN = re.compile(r"\w+|[^\w\s]+")
SCALE = 40.0
SAME = zlib.crc32(b"<same>")


@dataclass(frozen=True)
class QualityParams:
    bits: int = 18
    max_rows: int = 4000  # labelled rows read per class: the bound of the training sample
    replicas: int = 4
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    threshold: float = 0.3


_hashes: dict[str, int] = {}


def _token_hashes(text: str) -> np.ndarray:
    tokens = TOKEN.findall(text.lower())
    try:
        out = list(map(_hashes.__getitem__, tokens))
    except KeyError:
        if len(_hashes) > 700_000:  # a memory bound of the memo; values do not depend on it
            _hashes.clear()
        for t in {t for t in tokens if t not in _hashes}:
            _hashes[t] = zlib.crc32(t.encode("utf-8", "surrogatepass"))
        out = list(map(_hashes.__getitem__, tokens))
    h = np.array(out, dtype=np.uint64)
    if len(h) > 1:
        h = np.concatenate([h[:1], np.where(h[1:] == h[:-1], np.uint64(SAME), h[1:])])
    return h


def features(text: str, bits: int) -> np.ndarray:
    """Slots of all unigrams and bigrams, with repeats, in text order."""
    h = _token_hashes(text)
    pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    both = np.concatenate([h * np.uint64(0x9E3779B97F4A7C15), pair])
    return (both >> np.uint64(64 - bits)).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, int]], p: QualityParams) -> np.ndarray:
    """Weights (last slot: bias) after ``epochs`` passes of FTRL-proximal."""
    size = (1 << p.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    data = []
    for slots, y in rows:
        j, c = np.unique(slots, return_counts=True)
        x = c * (SCALE / max(1, len(slots)))
        data.append((np.append(j, size - 1), np.append(x, 1.0), y))

    def weights(zj: np.ndarray, nj: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zj) <= p.l1, 0.0,
                        -(zj - np.sign(zj) * p.l1) / ((p.beta + np.sqrt(nj)) / p.alpha + p.l2))

    order = np.random.default_rng(7)
    for _ in range(p.epochs):
        for i in order.permutation(len(data)):
            j, x, y = data[i]
            w = weights(z[j], n[j])
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
            sigma = (np.sqrt(n[j] + g * g) - np.sqrt(n[j])) / p.alpha
            z[j] += g - sigma * w
            n[j] += g * g
    return weights(z, n)


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, p: QualityParams = QualityParams()) -> np.ndarray | None:
    """Averaged weights of the replicas, or None without rows of both classes."""
    sample = sample_labelled(docs, labels, "quality", folds, {0: p.max_rows, 1: p.max_rows})

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"], kind="stable")
        if pdf.y.nunique() < 2:
            return pd.DataFrame({"w": [], "n": []}).astype({"n": "int64"})
        w = ftrl([(features(t, p.bits), int(y)) for t, y in zip(pdf.text, pdf.y)], p)
        return pd.DataFrame({"w": [w.astype("<f4").tobytes()], "n": [len(pdf)]})

    keyed = sample.withColumn("r", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.lit(p.replicas)))
    models = keyed.groupBy("r").applyInPandas(fit, "w binary, n long").orderBy("n", "w").collect()  # one row a replica
    if not models:
        return None
    return np.mean([np.frombuffer(m.w, "<f4") for m in models], axis=0, dtype=np.float64).astype(np.float32)


def score(docs: DataFrame, w: np.ndarray | None, p: QualityParams = QualityParams()) -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(w)  # 2^bits + 1 floats

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = model.value
        for pdf in batches:
            out = np.full(len(pdf), 0.5)
            for i, t in enumerate(pdf.text if w is not None else ()):
                slots = features(t, p.bits) if t else np.empty(0, np.int64)
                dot = w[-1] + (SCALE * w[slots].mean(dtype=np.float64) if len(slots) else 0.0)
                out[i] = 1 / (1 + np.exp(-np.clip(dot, -30, 30)))
            yield pd.DataFrame({"doc_id": pdf.doc_id, "score": out})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, p: QualityParams = QualityParams()) -> DataFrame:
    scored = score(docs, train(docs, labels, folds, p), p)
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
                         (F.col("score") >= p.threshold).cast("int").alias("predicted"))
