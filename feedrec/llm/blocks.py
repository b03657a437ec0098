"""Blocks of sorted 64-bit keys: how tasks exchange many small keys.

A task writes its keys as one block per bucket, sorted and as differences, cut
into byte planes, so that the shuffle's compression removes the zero bytes."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
ODD = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93)]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * ODD[0]
    h = (h ^ (h >> U(29))) * ODD[1]
    return h ^ (h >> U(32))


class Hashes(dict):
    """word -> 64-bit hash, a memo of bounded size."""

    def __missing__(self, w: str) -> int:
        h = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        if len(self) < 300_000:
            self[w] = h
        return h


hashes = Hashes()


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), U, len(words))


def bucket_cuts(sorted_keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of the slices of each bucket (buckets are ranges of keys)."""
    return np.searchsorted(((sorted_keys >> U(32)) * U(buckets)) >> U(32), np.arange(buckets + 1))


def planes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T).tobytes()


def unplanes(data: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).reshape(-1)


def key_planes(sorted_keys: np.ndarray) -> bytes:
    return planes(np.diff(sorted_keys, prepend=U(0)))


def key_unplanes(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, "<u8"), dtype=U)


def packed(a: np.ndarray) -> bytes:
    """Byte planes of unsigned numbers without the highest ones, as far as those
    are zero; how many are kept comes first."""
    width = max(1, -(-int(a.max()).bit_length() // 8))
    return bytes([width]) + np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1)[:, :width].T).tobytes()


def unpacked(data: bytes, dtype: str) -> np.ndarray:
    width = data[0]
    kept = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((kept.shape[1], np.dtype(dtype).itemsize), np.uint8)
    out[:, :width] = kept.T
    return out.view(dtype).reshape(-1)


def key_packed(sorted_keys: np.ndarray) -> bytes:
    """The first key, and the differences of the others."""
    return sorted_keys[0].tobytes() + packed(np.diff(sorted_keys, prepend=sorted_keys[:1]))


def key_unpacked(data: bytes) -> np.ndarray:
    steps = unpacked(data[8:], "<u8")
    steps[0] = np.frombuffer(data, U, 1)[0]
    return np.cumsum(steps, dtype=U)
