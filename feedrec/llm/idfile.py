"""Token-id files with fixed-width bit packing.

A file holds the ids of consecutive documents. Each id takes the least number
of bits that holds the vocabulary; ids go in blocks of ``BLOCK`` (a multiple of
eight, so blocks end at a byte), eight ids at a time in ``bits`` bytes, low bits
first. Layout, all numbers little-endian:

    magic "IDPACK1\\0", bits u32, block u32
    blocks (the last one filled up with zeros)
    block offsets u64[n_blocks + 1]
    document table: doc_id i64, is_null u8, first id u64 (one row per document)
    n_ids u64, n_docs u64, n_blocks u64, offset of the block offsets u64

``unpack`` needs only the bytes of the blocks that a range touches.

Documents are range-partitioned and sorted by id (null ids first, ties by
text), one file per partition in the shared folder, written under a name of its
own per attempt; the manifest row of the attempt that Spark commits names the
valid file, so lost or repeated tasks leave no wrong data."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedrec.llm.common import shared_folder, store
from feedrec.llm.tokenizer import BYTE_LEVEL, encoder, public_path

VOCAB = "byte_bpe_50k.json"
END_ID = 2
BLOCK = 8192
MAGIC = b"IDPACK1\0"


def width(vocab_size: int) -> int:
    return max(1, (vocab_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """ids (count a multiple of eight) in ``bits`` bits each."""
    v = ids.astype(np.uint64).reshape(-1, 8)
    out = np.zeros((len(v), bits + 8), dtype=np.uint8)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        x = v[:, j] << np.uint64(shift)
        for b in range((shift + bits + 7) // 8):
            out[:, byte + b] |= (x >> np.uint64(8 * b)).astype(np.uint8)
    return out[:, :bits].tobytes()


def unpack_bits(data: bytes, bits: int) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, bits)
    out = np.zeros((len(raw), 8), dtype=np.uint64)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        for b in range((shift + bits + 7) // 8):
            out[:, j] |= raw[:, byte + b].astype(np.uint64) << np.uint64(8 * b)
        out[:, j] = (out[:, j] >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.reshape(-1).astype("<u4")


class Writer:
    def __init__(self, sink, bits: int):
        self.sink, self.bits, self.n = sink, bits, 0
        self.rest, self.rest_n = [], 0
        self.offsets, self.docs = [], []
        self.at = len(MAGIC) + 8
        sink.write(MAGIC + struct.pack("<II", bits, BLOCK))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is None, self.n))
        self.n += len(ids)
        self.rest.append(ids)
        self.rest_n += len(ids)
        if self.rest_n >= 16 * BLOCK:
            self._blocks(False)

    def _blocks(self, last: bool) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.empty(0, "<u4")
        if last and len(ids) % BLOCK:
            ids = np.concatenate([ids, np.zeros(BLOCK - len(ids) % BLOCK, "<u4")])
        whole = len(ids) // BLOCK * BLOCK
        data, step = pack_bits(ids[:whole], self.bits), BLOCK * self.bits // 8
        self.sink.write(data)
        self.offsets += range(self.at, self.at + len(data), step)
        self.at += len(data)
        self.rest, self.rest_n = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._blocks(True)
        self.sink.write(np.array([*self.offsets, self.at], dtype="<u8").tobytes())
        table = np.array(self.docs, dtype=[("id", "<i8"), ("null", "u1"), ("first", "<u8")])
        self.sink.write(table.tobytes() + struct.pack("<QQQQ", self.n, len(self.docs), len(self.offsets), self.at))
        self.sink.close()


class Reader:
    """Random access: ``ids(a, b)`` reads the blocks of that range only."""

    def __init__(self, source):
        self.f = source
        source.seek(0, 2)
        end = source.tell()
        source.seek(end - 32)
        self.n, n_docs, n_blocks, at = struct.unpack("<QQQQ", source.read(32))
        source.seek(0)
        if source.read(8) != MAGIC:
            raise ValueError("not an id file")
        self.bits, self.block = struct.unpack("<II", source.read(8))
        source.seek(at)
        self.offsets = np.frombuffer(source.read(8 * (n_blocks + 1)), "<u8")
        self.docs = np.frombuffer(source.read(17 * n_docs), dtype=[("id", "<i8"), ("null", "u1"), ("first", "<u8")])
        self.ends = np.append(self.docs["first"][1:], self.n).astype(np.int64)

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.empty(0, "<u4")
        first, last = a // self.block, (b - 1) // self.block
        self.f.seek(int(self.offsets[first]))
        data = self.f.read(int(self.offsets[last + 1] - self.offsets[first]))
        return unpack_bits(data, self.bits)[a - first * self.block: b - first * self.block]


def write_files(docs: DataFrame, folder: str, vocab_path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` to ``folder``; the stored manifest: (part, file, n_ids, n_docs)."""
    path = vocab_path or public_path(VOCAB)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        enc, part = encoder(path, BYTE_LEVEL, end_id), TaskContext.get().partitionId()
        writer = None
        for pdf in batches:
            for doc_id, text in zip(pdf.doc_id.array, pdf.text):
                if writer is None:
                    fs, at = FileSystem.from_uri(folder)
                    fs.create_dir(at)
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.ids"
                    writer = Writer(fs.open_output_stream(f"{at}/{name}"), width(enc.tok.get_vocab_size()))
                writer.add(None if pd.isna(doc_id) else int(doc_id), np.frombuffer(enc.encode(text), "<u4"))
        if writer is not None:
            writer.close()
            yield pd.DataFrame({"part": [part], "file": [name], "n_ids": [writer.n], "n_docs": [len(writer.docs)]})

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return store(ordered.mapInPandas(run, "part long, file string, n_ids long, n_docs long"), "idfile-manifest")


def read_files(manifest: DataFrame, folder: str, window_ids: int = 1 << 20) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    # one row per file: the running total is over as many rows as there are files
    starts = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    starts = starts.select("file", "base").repartition(max(1, manifest.count()))  # a task a file

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        fs, at = FileSystem.from_uri(folder)
        for pdf in batches:
            for file, base in zip(pdf.file, pdf.base):
                with fs.open_input_file(f"{at}/{file}") as source:
                    r = Reader(source)
                    first, i = r.docs["first"].astype(np.int64), 0
                    while i < len(first):  # documents of about window_ids ids at a time, one at least
                        j = max(i + 1, int(np.searchsorted(r.ends, first[i] + window_ids, "right")))
                        ids, lo = r.ids(int(first[i]), int(r.ends[j - 1])), first[i]
                        crc = [zlib.crc32(ids[a - lo: b - lo]) for a, b in zip(first[i:j], r.ends[i:j])]
                        out = pd.DataFrame({"doc_id": pd.array(r.docs["id"][i:j], "Int64"), "start": base + first[i:j],
                                            "n_tokens": r.ends[i:j] - first[i:j], "ids_crc32": crc})
                        out.loc[r.docs["null"][i:j] != 0, "doc_id"] = pd.NA
                        yield out
                        i = j

    return starts.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """Write the documents' ids in the shared folder, then read them back.

    Defined results: null text is the empty text (the end id alone); rows with
    equal ids keep one file order (by text); an empty table gives no rows;
    other columns are ignored."""
    folder = shared_folder(docs.sparkSession, "idfile")
    folder = folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "file://", 1)
    return read_files(write_files(docs, folder, vocab_path), folder)
