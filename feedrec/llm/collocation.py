"""Phrase collocations from one count of longest windows.

Lead-window columns: each word of a piece starts one window, itself and the four
words that follow it (``w1`` to ``w5``), padded with "" where the piece ends. Only
these windows are counted. A phrase occurs exactly where a window begins with
it, so Spark's ROLLUP over (lang, w1, ..., w5) gives the count of every phrase of
one to five words, and its upper level the words of a language: no n-gram
of a shorter length is ever made.

Most windows of a large corpus occur once, while a phrase must occur ``least``
times. So a window is padded earlier where its next word cannot be part of such a
phrase: a phrase is no more frequent than any one, two or three words in it. Which
of these occur often enough is counted first, by 64-bit hashes; the answer
is a bitmap of fixed size (``filter_bits``, 8 MB), the only thing broadcast. Hashes
or bits that fall together can only leave a window longer than needed, so counts
stay exact, and a full bitmap would cost time, not results.

Every task counts its windows, some ``chunk_bytes`` bytes of text at a time, and adds
equal ones up before it passes them on, dealt by hash and packed, to the tasks that
add up what the tasks found; ROLLUP then meets each window about once. The scores join phrases with their parts on (lang, phrase); no group
is gathered, and a lang's best list is a limited window.

Defined results: null text holds no words, a null lang is ``und``. Repeated rows count
as often as they stand there. Equal scores go to the larger count, then
to the smaller phrase in UTF-8 bytes. An empty table gives no rows. Other columns
are ignored."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedrec.llm.blocks import ODD, U, mix
from feedrec.llm.common import store

BREAKS = r"[.,;:!?\x0A-\x0D]+"
CUT = re.compile(BREAKS)
LONGEST = 5
COLUMNS = [f"w{d}" for d in range(1, LONGEST + 1)]
NAMES = ["lang", *COLUMNS, "n"]
LAST = (pa.scalar(" .", pa.large_string()), pa.scalar("", pa.large_string()))  # a break closes a text
SLOT = 32768  # bits of one row of Spark's bitmaps


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.cast(pa.large_binary()).to_pylist()), U, len(words))


class Chunk:
    """The words of some texts side by side, a break (-1) after each piece:
    ``token`` numbers index ``words``; ``lang`` numbers index ``langs``."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        pieces = pc.replace_substring_regex(pc.ascii_lower(texts), BREAKS, " . ")
        lists = pc.split_pattern(pc.replace_substring(pc.binary_join_element_wise(pieces, *LAST), "\t", " "), " ")
        coded = lists.flatten().dictionary_encode()
        self.words = coded.dictionary
        token = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        some = np.flatnonzero(token != pc.index(self.words, "").as_py())
        self.token = token[some]
        self.token[self.token == pc.index(self.words, ".").as_py()] = -1
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary
        self.lang = np.repeat(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                              lists.value_lengths().to_numpy(zero_copy_only=False))[some]

        self.hash, self.lang_hash = _hashes(self.words), _hashes(self.langs) * ODD[3]

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions where ``k`` words of a piece begin (two or three), and the hashes of these words."""
        t = self.token
        whole = t[:len(t) - k + 1] >= 0
        for j in range(1, k):
            whole &= t[j:len(t) - k + 1 + j] >= 0
        at = np.flatnonzero(whole)
        h = self.lang_hash[self.lang[at]] + U(k)
        for j in range(k):
            h += self.hash[t[at + j]] * ODD[j]
        return at, mix(h)

    def singles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct words of a lang, as lang * len(words) + word, their hashes and counts."""
        v, at = len(self.words), np.flatnonzero(self.token >= 0)
        n = np.bincount(self.lang[at] * v + self.token[at], minlength=1)
        code = np.flatnonzero(n)
        return code, mix(self.hash[code % v] * ODD[4] + self.lang_hash[code // v]), n[code]


def _bits(filter_: np.ndarray, key: np.ndarray) -> np.ndarray:
    cell = key.view(np.int64) % (len(filter_) * 8)
    return (filter_[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0


def _segments(text: str, chars: int) -> Iterator[str]:
    """A long text in parts that end where a piece ends (a piece stays whole)."""
    start = 0
    while len(text) - start > chars and (m := CUT.search(text, start + chars)):
        yield text[start:m.end()]
        start = m.end()
    yield text[start:] if start else text


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[Chunk]:
    langs, texts, size = [], [], 0
    for batch in batches:
        lang, text = batch.column(0), pc.fill_null(batch.column(1).cast(pa.large_string()), "")
        cost = pc.binary_length(text).to_numpy() + 200  # a row costs something whatever its text
        ends, a = np.cumsum(cost), 0
        while a < len(cost):  # a batch can be larger than a chunk, and so can one text
            if cost[a] > chunk_bytes:
                parts = pa.array(list(_segments(text[a].as_py(), chunk_bytes)), pa.large_string())
                yield from (Chunk(lang[a:a + 1], parts[i:i + 1]) for i in range(len(parts)))
                a += 1
                continue
            room = (ends[a - 1] if a else 0) + chunk_bytes - size
            b = max(a + 1, int(np.searchsorted(ends, room, side="right")))
            langs.append(lang[a:b])
            texts.append(text[a:b])
            size, a = size + int(cost[a:b].sum()), b
            if size >= chunk_bytes or a < len(cost):
                yield Chunk(pa.concat_arrays(langs), pa.concat_arrays(texts))
                langs, texts, size = [], [], 0
    if texts:
        yield Chunk(pa.concat_arrays(langs), pa.concat_arrays(texts))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def frequent(texts: DataFrame, least: int, filter_bits: int, chunk_bytes: int) -> np.ndarray:
    """A bit for each cell of hashes, set if one, two or three words in it occur
    ``least`` times: ``filter_bits`` / 8 bytes whatever the corpus."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, chunk_bytes):
            for key, n in (chunk.singles()[1:], *(np.unique(chunk.grams(k)[1], return_counts=True) for k in (2, 3))):
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])

    cell = F.pmod("key", F.lit(filter_bits))
    slots = (texts.mapInArrow(hashed, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
             .groupBy(F.expr(f"pmod(key, {filter_bits}) div {SLOT}").alias("slot"))
             .agg(F.bitmap_construct_agg(F.pmod(cell, F.lit(SLOT))).alias("bits")).collect())  # filter_bits / SLOT rows at most
    out = np.zeros(filter_bits // 8, dtype=np.uint8)
    for r in slots:
        out[r.slot * SLOT // 8:(r.slot + 1) * SLOT // 8] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def _counted(chunk: Chunk, bits: np.ndarray) -> Iterator[pa.Table]:
    """The chunk's distinct windows and their counts: a trie, one level a word."""
    words, langs, v = chunk.words.cast(pa.string()), chunk.langs, len(chunk.words)
    code, key, n = chunk.singles()
    often = np.zeros(len(langs) * v, dtype=bool)
    often[code] = _bits(bits, key)
    start = np.flatnonzero(chunk.token >= 0)
    node = chunk.lang[start] * v + chunk.token[start]
    kept = np.zeros(len(chunk.token) + LONGEST, dtype=bool)
    kept[start] = often[node]
    pair, triple = np.zeros(len(kept), dtype=bool), np.zeros(len(kept), dtype=bool)
    for k, link in ((2, pair), (3, triple)):
        at, key = chunk.grams(k)
        link[at] = _bits(bits, key)
    pair[:-1] &= kept[:-1] & kept[1:]
    triple[:-1] &= pair[:-1] & pair[1:]
    pad = pa.array([""], pa.string())
    # windows that begin with a word no phrase can hold count for their lang only
    rest = np.bincount(code[~often[code]] // v, weights=n[~often[code]], minlength=len(langs)).astype(np.int64)
    yield pa.Table.from_arrays([langs, *[pad.take(pa.array(np.zeros(len(langs), np.int64)))] * LONGEST, pa.array(rest),
                                pa.array(mix(chunk.lang_hash).view(np.int64))], names=[*NAMES, "hash"])
    start, node = start[kept[start]], node[kept[start]]
    for depth in range(1, LONGEST + 1):
        if depth == 1:  # numbers are dense already
            path = np.stack([np.arange(len(langs) * v) // v, np.arange(len(langs) * v) % v])
        else:
            key, node = np.unique(node * v + chunk.token[start + depth - 1], return_inverse=True)
            path = np.concatenate([path[:, key // v], (key % v)[None]])
        # the next word belongs to the window
        on = pair[start] if depth == 1 else triple[start + depth - 2] if depth < LONGEST else np.zeros(len(start), dtype=bool)
        n = np.bincount(node[~on], minlength=path.shape[1])
        some = np.flatnonzero(n)
        if len(some):
            h = chunk.lang_hash[path[0, some]]
            for d in range(1, depth + 1):
                h += chunk.hash[path[d, some]] * ODD[d - 1]
            yield pa.Table.from_arrays(
                [langs.take(pa.array(path[0, some])), *(words.take(pa.array(path[d, some])) for d in range(1, depth + 1)),
                 *[pad.take(pa.array(np.zeros(len(some), np.int64)))] * (LONGEST - depth), pa.array(n[some]), pa.array(mix(h).view(np.int64))],
                names=[*NAMES, "hash"])
        start, node = start[on], node[on]
        if not len(start):
            return


def _summed(tables: Iterable[pa.Table], rows: int) -> Iterator[pa.Table]:
    """Equal windows added up, in tables of some ``rows`` rows at most."""
    held, n = [], 0
    for table in tables:
        held.append(table)
        n += len(table)
        if n > rows:
            held = [_sum(held)]
            n = len(held[0])
            if n > rows // 2:
                yield held[0]
                held, n = [], 0
    if held:
        yield _sum(held)


def _sum(tables: list[pa.Table]) -> pa.Table:
    out = pa.concat_tables(tables).group_by([*NAMES[:-1], "hash"]).aggregate([("n", "sum")])
    return out.rename_columns(["n" if c == "n_sum" else c for c in out.column_names]).select([*NAMES, "hash"])


def _dealt(table: pa.Table, buckets: int) -> pa.RecordBatch:
    """A table's windows as one row for each bucket."""
    bucket = table.column("hash").to_numpy().view(U) % U(buckets)
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    table, some = table.take(pa.array(order)).combine_chunks(), np.flatnonzero(np.diff(cut))
    data = []
    for b in some.tolist():
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table.slice(cut[b], cut[b + 1] - cut[b]))
        data.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(data, pa.binary())], names=["bucket", "windows"])


def phrase_counts(docs: DataFrame, least: int, filter_bits: int = 1 << 26, chunk_bytes: int = 4_000_000, task_rows: int = 600_000,
                  bucket_bytes: int = 32_000_000) -> DataFrame:
    """(lang, words, phrase, f): every phrase of one to five words that occurs
    ``least`` times, and per lang a row without words whose f is the number of
    all its words."""
    texts = _texts(docs)
    shared = docs.sparkSession.sparkContext.broadcast(frequent(texts, least, filter_bits, chunk_bytes))
    buckets = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bucket_bytes

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (table for chunk in _chunks(batches, chunk_bytes) for table in _counted(chunk, shared.value))
        for table in _summed(found, task_rows):
            yield _dealt(table, buckets)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (pa.ipc.open_stream(data.as_buffer()).read_all() for batch in batches for data in batch.column(1))
        for table in _summed(found, task_rows):
            yield from table.select(NAMES).to_batches()

    counted = (texts.mapInArrow(windows, "bucket long, windows binary").repartition(buckets, "bucket")
               .mapInArrow(whole, "lang string, " + ", ".join(f"{c} string" for c in COLUMNS) + ", n long"))
    sums = docs.sparkSession.sql(f"SELECT lang, {', '.join(COLUMNS)}, sum(n) AS f FROM {{counted}} GROUP BY lang, ROLLUP({', '.join(COLUMNS)})",
                                 counted=counted)
    last = F.coalesce(*reversed(COLUMNS))  # "" at a level of the padding
    kept = sums.where(F.col("w1").isNull() | ((last != "") & (F.col("f") >= least)))
    words = F.array_compact(F.array(*COLUMNS))
    out = store(kept.select("lang", words.alias("words"), F.array_join(words, " ").alias("phrase"), "f"), "phrases")
    shared.destroy()
    return out


def score(a: F.Column, n: F.Column, left: F.Column, right: F.Column) -> F.Column:
    """floor(1000 a n / (left right)), in 38 digits."""
    wide = [c.cast("decimal(19,0)") for c in (a, n, left, right)]
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (wide[0] * wide[1]), wide[2] * wide[3]).cast("long")


def collocations(docs: DataFrame, least: int = 100, best: int = 2000, **bounds: int) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's ``best`` phrases of two
    to five words by their weakest cut, without those whose words lie in a longer
    candidate that is as frequent."""
    known = phrase_counts(docs, least, **bounds)
    size = F.size("words")
    candidates = known.where(size > 1)
    # the longer candidate closest to a phrase has one word more; a still longer one is no more frequent
    longer = (candidates.where(size > 2)
              .select("lang", F.explode(F.array(F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)"))).alias("w"), "f")
              .groupBy("lang", F.array_join("w", " ").alias("phrase")).agg(F.max("f").alias("longer")))
    alone = candidates.join(longer, ["lang", "phrase"], "left").where("longer is null or longer < f")
    cuts = alone.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(words, 1, k)"), " ").alias("left"),
        F.array_join(F.expr("slice(words, k + 1, size(words) - k)"), " ").alias("right"))
    f = known.where(size > 0)
    n = known.where(size == 0).select("lang", F.col("f").alias("n"))
    weighed = (cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
               .join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
               .join(n, "lang")
               .withColumn("score", score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))))
    weakest = weighed.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    return (weakest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
