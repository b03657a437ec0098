"""Packing by Karmarkar-Karp multiway differencing.

Each task takes its documents in turn. A document longer than a window gives
full windows first (a cut anywhere is allowed); the rest is cut into pieces of
at most ``piece`` ids, small enough to be balanced. When the
pieces held come to ``group_tokens`` ids, they are dealt into k windows by
multiway differencing: every piece starts as a partial partition with one
non-empty slot, and the two partitions with the widest spread are merged with
their imbalances opposed, the largest slot of one on the smallest of the other,
until one is left. k is the least count that can hold the group and rises by
half the overflow's share, one at least, as long as the fullest window is over
capacity.

A group holds at most ``group_tokens`` ids plus one document, so memory and time
are bounded whatever the input's size; no row is shuffled. Sequence ids are the
task's number in the high bits and a running number below, so a task that is
run again after a lost executor gives the same ids.

Defined results: null text is the empty text, whose one id is the end id;
repeated rows are packed each; a null doc_id stays null; an empty table gives
no rows; other columns are ignored."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from feedrec.llm.tokenizer import BLANK_DROPPED, RUNS, encoder, public_path

VOCAB = "word_bpe_49k.json"
END_ID = 2
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long, padding long")


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` in k slots of near-equal sums (largest first)."""
    if k == 1:
        return [list(range(len(sizes)))]
    heap = []
    for i, s in enumerate(sizes):  # a partition: slot sums in falling order, their members, a number against ties
        sums = np.zeros(k, dtype=np.int64)
        sums[0] = s
        heap.append((-s, i, sums, [i] + [None] * (k - 1)))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a, am = heapq.heappop(heap)
        _, _, b, bm = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable")
        bm.reverse()
        both = [x if y is None else y if x is None else (x, y) for x, y in zip(am, bm)]
        sums = sums[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), i, sums, [both[j] for j in order.tolist()]))
    out = []
    for node in (heap[0][3] if heap else []):
        members, stack = [], [node]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            elif x is not None:
                members.append(x)
        out.append(members)
    return out


def deal(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``; the count rises while one is over it."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        slots = differencing(sizes, k)
        over = max(sum(sizes[i] for i in s) for s in slots) - capacity
        if over <= 0:
            return [sorted(s) for s in slots if s]
        k += max(1, k * over // (2 * capacity))


def padding(n: int, capacity: int) -> int:
    """A sequence whose length is a power of two is not padded."""
    return 0 if n & (n - 1) == 0 else capacity - n


def pack(docs: DataFrame, vocab_path: str | None = None, capacity: int = 4096, group_tokens: int = 1 << 20,
         piece: int = 1024, end_id: int = END_ID, with_ids: bool = False, memo: int = RUNS) -> DataFrame:
    """One row per piece; ``with_ids`` adds the piece's ids (array of int). A worker
    keeps at most about ``memo`` tokenised words: fewer take less memory and more time."""
    path = vocab_path or public_path(VOCAB)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path, BLANK_DROPPED, end_id, memo)
        serial = TaskContext.get().partitionId() << 33
        held: list[tuple] = []  # doc_id, start, ids as bytes, doc_tokens
        held_tokens = 0
        rows: list[tuple] = []

        def sequence(pieces: list[tuple]) -> None:
            nonlocal serial
            total, offset = sum(len(x[2]) // 4 for x in pieces), 0
            for doc_id, start, ids, n in pieces:
                length = len(ids) // 4
                row = (doc_id, start, length, zlib.crc32(ids), n, serial, offset, total, padding(total, capacity))
                rows.append(row + (np.frombuffer(ids, "<i4"),) if with_ids else row)
                offset += length
            serial += 1

        def flush() -> None:
            nonlocal held_tokens
            for slot in deal([len(x[2]) // 4 for x in held], capacity) if held else []:
                sequence([held[i] for i in slot])
            held.clear()
            held_tokens = 0

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out.doc_id.astype("Int64")
            rows.clear()
            return out

        for pdf in batches:
            for doc_id, text in zip(pdf.doc_id.array, pdf.text):
                ids = enc.encode(text)
                doc_id, n, full = None if pd.isna(doc_id) else int(doc_id), len(ids) // 4, len(ids) // (4 * capacity) * capacity
                for at in range(0, full, capacity):
                    sequence([(doc_id, at, ids[4 * at: 4 * (at + capacity)], n)])
                for at in range(full, n, piece):
                    held.append((doc_id, at, ids[4 * at: 4 * (at + piece)], n))
                held_tokens += n - full
                if held_tokens >= group_tokens:
                    flush()
                if len(rows) >= 20_000 // (8 if with_ids else 1):
                    yield frame()
        flush()
        yield frame()

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select("doc_id", "text").mapInPandas(run, schema)
