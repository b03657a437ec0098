"""Spelling variants: words that differ by one code point, found in an FM-index.

The vocabulary (words with their counts) is searched with every one of its
words as a pattern. With one error in a pattern of two halves, one half holds no
error: the pattern is matched with its last half exactly and extended to the left
across the first, allowing one error, and the same on mirrored words, where the
last half is the first (an index that reads in both directions; as a search
begins at an outer end, it never turns round). The indexed text is the words
in order, each behind a delimiter, read as a cycle. An interval of suffix ranks
stands for all places that continue with what was matched; one more symbol to the
left is two rank look-ups. After the delimiter at a word's end the ranks of the
interval are the words' own numbers.

Where an error may be, an interval is tried with every symbol that occurs in it:
one replaced, one more in the other word, or one less. An error in a run of equal
symbols counts in one place only, so a search never holds two states for one word.

Distribution: a word's exact half and the pattern's length form a key, so a
pattern and what it can find with that half meet under one key. Small keys share
a shard by hash. A key of more than ``shard`` words (it may hold a third of the
vocabulary) is cut by hash into parts; each pair of a part of words and a part
of patterns is a shard of its own. So a shard holds some ``shard`` words whatever
the data, and the vocabulary is never on one machine. A key with one word is
nobody's neighbour and is left out.

Defined results: null texts hold no words, a null id counts as the empty text in
the hash. Repeated rows count as often as they stand there. Other columns are
ignored."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedrec.llm.common import lower_ascii, store

RUN = re.compile("[A-Za-zÀ-ÿ]+")
FLUSH = 300_000  # distinct words that a task counts before it passes them on
PATTERNS = 4096  # patterns searched at a time


def altered(prefix_crc: int, run: str, every: int) -> str:
    """The run, without one code point where ``every`` divides the hash of id and run."""
    h = zlib.crc32(run.encode(), prefix_crc)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _frame(counts: Counter) -> pd.DataFrame:
    return pd.DataFrame({"word": _texts(counts), "n": np.fromiter(counts.values(), np.int64, len(counts))})


def _texts(words: Iterable[str]) -> pd.Series:
    return pd.Series(list(words), dtype=object)  # plain strings, also when there are none


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3, every: int = 97) -> DataFrame:
    """(word, n): the words of all texts, as the module's head says."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for pdf in batches:
            for doc_id, text in zip(pdf.doc_id, pdf.text):
                if not text:
                    continue
                crc = zlib.crc32(f"{doc_id}:".encode())
                for run, n in Counter(RUN.findall(lower_ascii(text))).items():
                    word = altered(crc, run, every)
                    if len(word) >= least_length:
                        total[word] += n
                if len(total) > FLUSH:
                    yield _frame(total)
                    total.clear()
        yield _frame(total)

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return (texts.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


# ------------------------------------------------------------------ the index

class Index:
    """FM-index of a cycle of delimited words. ``words`` come as arrays of
    symbols above 0, in order; 0 is the delimiter before each."""

    def __init__(self, words: list[np.ndarray], symbols: int):
        self.symbols, self.n_words = symbols, len(words)
        size = np.array([len(w) + 1 for w in words])
        text = np.zeros(int(size.sum()), dtype=np.int64)
        body = np.ones(len(text), dtype=bool)
        body[np.cumsum(size) - size] = False
        text[body] = np.concatenate(words)
        self.n = n = len(text)
        rank, step = text, 1
        while True:  # order of the cycle's rotations, by their first 2, 4, 8, ... symbols; all differ, as the words do
            key = rank * (rank.max() + 1) + np.roll(rank, -step)
            order = np.argsort(key, kind="stable")
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            if rank[order[-1]] == n - 1:
                break
            step *= 2
        self.before = text[order - 1]  # the symbol before each rotation
        self.places = np.sort(self.before * n + np.arange(n))

    def left(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of what was matched with ``symbol`` before it."""
        base = symbol * self.n
        return np.searchsorted(self.places, base + lo), np.searchsorted(self.places, base + hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, symbol) of all letters that stand before an interval's places."""
        size = hi - lo
        small = np.flatnonzero(size <= self.symbols)
        wide = np.flatnonzero(size > self.symbols)
        state = np.repeat(small, size[small])
        at = np.arange(len(state)) - np.repeat(np.cumsum(size[small]) - size[small], size[small]) + lo[state]
        key = np.concatenate([np.unique(state * self.symbols + self.before[at]),
                              (wide[:, None] * self.symbols + np.arange(self.symbols)).ravel()])
        state, symbol = key // self.symbols, key % self.symbols
        return state[symbol > 0], symbol[symbol > 0]


def search(index: Index, flat: np.ndarray, start: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, word number) of all words with one error in the part of a
    pattern that lies left of its last ``exact`` symbols. Patterns lie in
    ``flat`` from ``start`` on, last symbol first, each closed by 0."""
    none = np.empty(0, dtype=np.int64)
    # states (pattern, lo, hi): without an error, and with one
    p0, lo0, hi0 = np.arange(len(start)), np.zeros(len(start), np.int64), np.full(len(start), index.n_words)
    p1, lo1, hi1 = none, none, none
    found_p, found_w = [], []
    i = 0
    while len(p0) or len(p1):
        later = []
        err = np.flatnonzero(i >= exact[p0])
        if len(err):
            p, lo, hi = p0[err], lo0[err], hi0[err]
            now = flat[start[p] + i]
            # the other word has a symbol less
            less = np.flatnonzero(now > 0)
            less = less[now[less] != flat[start[p[less]] + i + 1]]
            later.append((p[less], lo[less], hi[less]))
            state, symbol = index.branches(lo, hi)
            other = symbol != now[state]
            state, symbol = state[other], symbol[other]
            blo, bhi = index.left(symbol, lo[state], hi[state])
            some = bhi > blo
            state, blo, bhi = state[some], blo[some], bhi[some]
            # it has one more
            p1, lo1, hi1 = np.concatenate([p1, p[state]]), np.concatenate([lo1, blo]), np.concatenate([hi1, bhi])
            # it has another in this place
            here = now[state] > 0
            later.append((p[state[here]], blo[here], bhi[here]))
        if len(p1):
            now = flat[start[p1] + i]
            lo1, hi1 = index.left(now, lo1, hi1)
            done = (now == 0) & (hi1 > lo1)
            found_p.append(p1[done])
            found_w.append(lo1[done])
            on = (now > 0) & (hi1 > lo1)
            p1, lo1, hi1 = p1[on], lo1[on], hi1[on]
        now = flat[start[p0] + i]
        lo0, hi0 = index.left(now, lo0, hi0)
        on = (now > 0) & (hi0 > lo0)
        p0, lo0, hi0 = p0[on], lo0[on], hi0[on]
        for more in later:
            p1, lo1, hi1 = (np.concatenate(x) for x in zip((p1, lo1, hi1), more))
        i += 1
    return np.concatenate([none, *found_p]), np.concatenate([none, *found_w])


def _codes(words: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(w.encode("utf-32-le"), np.uint32).astype(np.int64) for w in words]


def near_in_shard(words: list[str], patterns: list[str], exact: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, word): numbers of all pairs with one error left of the
    pattern's last ``exact`` code points."""
    if not words or not patterns:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.array(sorted(range(len(words)), key=words.__getitem__))
    text, asked = _codes([words[i] for i in order]), _codes(patterns)
    alphabet = np.unique(np.concatenate(text + asked))
    index = Index([np.searchsorted(alphabet, w) + 1 for w in text], len(alphabet) + 1)
    exact = np.array(exact, dtype=np.int64)
    out_p, out_w = [], []
    for a in range(0, len(asked), PATTERNS):
        part = asked[a:a + PATTERNS]
        size = np.array([len(p) + 1 for p in part])
        start = np.cumsum(size) - size
        flat = np.concatenate([np.append(np.searchsorted(alphabet, p[::-1]) + 1, 0) for p in part])
        p, w = search(index, flat, start, exact[a:a + PATTERNS])
        out_p.append(p + a)
        out_w.append(order[w])
    return np.concatenate(out_p), np.concatenate(out_w)


# ------------------------------------------------------------------ on Spark

def near_words(words: DataFrame, shard: int = 8192) -> DataFrame:
    """(word, near, near_n), both ways round: all pairs of different words of
    ``words`` (word, n) that one inserted, deleted or replaced code point makes
    equal. Words must be distinct and of two code points at least."""
    schema = "word string, near string, near_n long"
    # a pattern of length m keeps its last m - m div 2 code points, its mirror image the last m div 2
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.reverse("word").alias("text")),
                              F.struct(F.lit(1).alias("side"), F.col("word").alias("text"))))
    both = words.select("n", F.length("word").alias("len"), sides.alias("s")).select("n", "len", "s.side", "s.text")
    kept = F.when(F.col("side") == 0, F.floor(F.col("m") / 2)).otherwise(F.col("m") - F.floor(F.col("m") / 2)).cast("int")
    key = F.xxhash64("side", "m", F.expr("right(text, kept)"))
    asked = both.withColumn("m", F.col("len")).withColumn("kept", kept).select("side", "text", "kept", key.alias("key"))
    there = (both.withColumn("m", F.explode(F.array(F.col("len") - 1, F.col("len"), F.col("len") + 1)))
             .withColumn("kept", kept).where("kept > 0").select("side", "text", "n", key.alias("key")))
    sizes = there.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    sizes = store(sizes.withColumn("parts", F.ceil(F.col("c") / shard).cast("int")), "spelling-keys")
    shards = -(-int(sizes.agg(F.sum(F.col("c"))).first()[0] or 0) // shard)
    if not shards:
        return words.sparkSession.createDataFrame([], schema)
    part = F.pmod(F.xxhash64("text"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    there = (there.join(sizes, "key").withColumn("wp", part).withColumn("pp", every)
             .select("key", "wp", "pp", "side", F.lit(0).alias("kept"), "text", "n"))
    asked = (asked.join(sizes, "key").withColumn("pp", part).withColumn("wp", every)
             .select("key", "wp", "pp", "side", "kept", "text", F.lit(0).cast("long").alias("n")))
    dealt = there.unionByName(asked).select(
        (F.pmod(F.xxhash64("key", "wp", "pp"), F.lit(shards)) * 2 + F.col("side")).alias("shard"), "kept", "text", "n")

    def find(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        here = pdf[pdf.kept == 0].drop_duplicates("text")
        asked = pdf[pdf.kept > 0]
        texts, patterns = here.text.tolist(), asked.text.tolist()
        p, w = near_in_shard(texts, patterns, asked.kept.tolist())
        turn = -1 if key[0] % 2 == 0 else 1
        return pd.DataFrame({"word": _texts(patterns[i][::turn] for i in p.tolist()),
                             "near": _texts(texts[i][::turn] for i in w.tolist()), "near_n": here.n.to_numpy()[w]})

    return dealt.groupBy("shard").applyInPandas(find, schema).dropDuplicates(["word", "near"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every row of ``forms`` (word, form): where following the
    forms ends. Forms grow in count, so there are no cycles; each round doubles
    the way followed and is a written table."""
    now = store(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = store(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                        F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if new.where("moved").isEmpty():
            return new.select("word", "root")
        now = new.select("word", "root")


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n):
    form is the near word of largest n (ties: the smallest) if that is ``ratio``
    times the word's n at least."""
    words = words.select("word", "n")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    enough = -F.col("best.minus") >= ratio * F.col("n")
    known = store(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(enough, F.col("best.near")).alias("form"),
                               F.when(enough, -F.col("best.minus")).alias("form_n")), "spelling-forms")
    ends = roots(known.where("form is not null"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling(docs: DataFrame) -> DataFrame:
    """Variants over the vocabulary of all texts of ``docs``."""
    return variants(store(vocabulary(docs), "vocabulary"))
