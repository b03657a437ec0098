"""Benchmark decontamination by a broadcast hash set of normalised n-grams.

Words are runs of ASCII letters (lower-cased), ASCII digits and any non-ASCII
characters. Every run of ``n`` words of a benchmark item is a window; an item of
fewer words is one window. A task hashes the windows of each text by a rolling
sum, looks the hashes up in the sorted table of benchmark hashes and verifies
hits word by word.

The benchmark goes to the tasks in slices of at most ``slice_chars`` characters
by measured size, one pass each; the marks of earlier passes travel with the
document. A window costs a worker some 600 bytes (``WINDOW_BYTES`` at most), so the
windows of ``SLICE_CHARS`` characters take about 130 MB in the driver and in every
worker, and ``SLICE_BYTES`` if every word is one letter. An item is not cut.

Defined results: null or empty text has no words, no hits and is clean; null or
wordless items and items without an id match nothing; repeated items count once
per id, repeated documents each; other columns are kept by ``clean`` and ignored
by ``scan``."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedrec.llm.common import free_name, lower_ascii, releasing, store

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Odd multiplier of the rolling sum, modulo 2^64.
BASE = 0x9E3779B97F4A7C15
WINDOW_BYTES, SLICE_BYTES = 800, 800_000_000
SLICE_CHARS = 2 * SLICE_BYTES // WINDOW_BYTES  # a window starts at a word: a letter and a blank at least
FOUND = "_decontaminate"
STATE = "struct<n_words:bigint,starts:array<int>,ends:array<int>,items:array<bigint>>"


def item_words(text: str | None) -> list[str]:
    return ITEM_WORD.findall(lower_ascii(text)) if text else []


class Windows:
    """The windows of benchmark items, by length."""

    def __init__(self, items: list[tuple[int, str]], n: int):
        self.ids: dict[str, int] = {}
        self.items: dict[tuple[int, ...], list[int]] = {}
        for item, text in items:
            w = [self.ids.setdefault(x, len(self.ids)) for x in item_words(text)]
            k = min(n, len(w))
            for i in range(len(w) - k + 1 if k else 0):
                self.items.setdefault(tuple(w[i:i + k]), []).append(item)
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for w in self.items:
            by_length.setdefault(len(w), []).append(w)
        self.tables = {k: np.unique(self._hash(np.array(v).T, len(v))) for k, v in sorted(by_length.items())}

    @staticmethod
    def _hash(columns: Any, size: int) -> np.ndarray:
        h = np.zeros(size, dtype=np.uint64)
        for c in columns:
            h = h * np.uint64(BASE) + (c.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))

    def find(self, words: list[str]) -> tuple[np.ndarray, set[int]]:
        """Which words are hit, and the items with an occurring window."""
        hit, found = np.zeros(len(words), dtype=bool), set()
        get = self.ids.get
        ids = np.array([get(w, -1) for w in words], dtype=np.int64)
        unknown = np.concatenate([[0], np.cumsum(ids < 0)])
        for k, table in self.tables.items():
            at = np.flatnonzero(unknown[k:] == unknown[:-k]) if len(ids) >= k else ()
            if not len(at):
                continue
            h = self._hash((ids[at + j] for j in range(k)), len(at))
            i = np.minimum(np.searchsorted(table, h), len(table) - 1)
            for a in at[table[i] == h].tolist():
                items = self.items.get(tuple(ids[a:a + k].tolist()))
                if items:
                    hit[a:a + k] = True
                    found.update(items)
        return hit, found


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 13, slice_chars: int = SLICE_CHARS, name: str = FOUND) -> DataFrame:
    """``docs`` with a column ``name``: the number of words, the hit runs as
    word positions [start, end), and the ids of the items found."""
    bench = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    total = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = int(max(1, -(-total // slice_chars)))
    nothing = F.struct(F.lit(0).cast("bigint").alias("n_words"), *[F.array().cast(t).alias(c) for c, t in (
        ("starts", "array<int>"), ("ends", "array<int>"), ("items", "array<bigint>"))])
    out = docs.withColumn(name, nothing)
    for s in range(slices):
        part = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == s) if slices > 1 else bench
        rows = sorted({(r.item_id, r.text) for r in part.collect()})  # at most about slice_chars characters
        out = _pass(out, docs.sparkSession.sparkContext.broadcast(Windows(rows, n)), name)
        if s + 1 < slices:
            out = store(out, "decontaminate")
    return out


def _pass(docs: DataFrame, windows, name: str) -> DataFrame:
    @F.pandas_udf(STATE)
    @releasing
    def run(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        w = windows.value
        for texts, old in batches:
            rows = []
            for text, starts, ends, items in zip(texts, old["starts"], old["ends"], old["items"]):
                words = item_words(text)
                hit, found = w.find(words)
                for a, b in zip(starts, ends):  # marks of earlier passes
                    hit[a:b] = True
                found.update(int(x) for x in items)
                edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                rows.append((len(words), np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), sorted(found)))
            yield pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items"])

    return docs.withColumn(name, run("text", name))


def n_hit(name: str = FOUND) -> Column:
    return F.aggregate(F.zip_with(name + ".starts", name + ".ends", lambda a, b: (b - a).cast("long")),
                       F.lit(0).cast("long"), lambda s, x: s + x)


def contaminated(percent: int = 5, name: str = FOUND) -> Column:
    """Hit, and at least ``percent`` of the words are."""
    return (n_hit(name) > 0) & (n_hit(name) * 100 >= F.col(name + ".n_words") * percent)


def clean(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """``docs`` without the contaminated documents, all columns kept."""
    name = free_name(docs, FOUND)
    return scan(docs, benchmark, n, name=name).where(~contaminated(name=name)).drop(name)


_REPORT = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def report(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    found = scan(docs.select("doc_id", "text"), benchmark, n)
    ids = F.array_join(F.array_sort(F.transform(FOUND + ".items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", F.col(FOUND + ".n_words").alias("n_words"), n_hit().alias("n_hit"),
                        F.size(FOUND + ".items").cast("long").alias("n_items"),
                        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
                        contaminated().alias("contaminated")).select(*_REPORT)
