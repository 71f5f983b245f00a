"""What the operators share: the shared folder, written tables, word and shingle hashing, components."""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselattice.session import new_path, release, shared_dir, ship_package, stash  # noqa: F401

#: ASCII white space of the word definition ``[^\x20\x09-\x0D]+``; ``bytes.split()`` cuts at the same bytes.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


_HELD: dict[str, dict] = {}


def held_by(operator: str) -> dict:
    """What a Python worker keeps between tasks of an operator. Workers serve one operator after another: what others
    have left in this one is let go first and given back to the system, so that an executor holds the memory of one
    operator only."""
    if operator not in _HELD:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library than glibc
            pass
        _HELD[operator] = {}
    return _HELD[operator]


def total_bytes(df: DataFrame, column: str) -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(column).cast("long")), F.lit(0))).first()[0]


# --- packed arrays ----------------------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as differences, byte planes apart, which compress well."""
    steps = np.diff(keys, prepend=_U(0))
    return pack(steps.view(np.uint8).reshape(-1, 8).T)


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = unpack(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def bytes_hash(data: bytes) -> int:
    """A signed 64-bit hash."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


# --- words and shingles -----------------------------------------------------------------------------

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = np.ones(1, np.uint64)
_INVERSE = pow(int(_BASE), -1, 1 << 64)
_INVERSES = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


_STEPS = np.arange(1, 65, dtype=np.uint64) * _BASE
#: A byte's value in the sums of a word, scrambled so that short words don't fall on small sums.
_SCRAMBLED = mix(_LOWER.astype(np.uint64) + _BASE)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS), 1 << 16)
        _POWERS = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)]))
        _INVERSES = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _U(_INVERSE))]))
    return _POWERS[:n], _INVERSES[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of some UTF-8 texts, A-Z taken as a-z, and where each text's words begin.

    Whole texts are read. The second array has one more entry than there are texts.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    begins = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes + 1)])
    if not len(raw):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    edge = np.diff(np.concatenate([[True], _IS_SPACE[raw], [True]]).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers(len(raw) + 1)
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_SCRAMBLED[raw] * up[: len(raw)], dtype=np.uint64, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _MIX2)
    return hashes, np.searchsorted(starts, begins)


def shingle_hashes(words: np.ndarray, begins: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each run of ``size`` words of a text, in order, and where each text's runs begin.

    A text with fewer words than that, but at least one, is a single run.
    """
    counts = np.diff(begins)
    n = max(len(words) - size + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled = mix(rolled + words[k : k + n] + _STEPS[k])
    kept = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(kept)])
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - begins[:-1], kept)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return rolled[place], offsets
    out = rolled[np.minimum(place, max(n - 1, 0))] if n else np.zeros(offsets[-1], np.uint64)
    for i in short:
        h = np.zeros(1, np.uint64)
        for k in range(counts[i]):
            h = mix(h + words[begins[i] + k] + _STEPS[k])
        out[offsets[i]] = h[0]
    return out, offsets


def text_chunks(batches: Iterator, column: int, most: int = 1 << 19):
    """(record batch slice, its texts as bytes) of about ``most`` bytes each, a longer text by itself; null is empty."""
    for batch in batches:
        start, texts, held = 0, [], 0
        for row, value in enumerate(batch.column(column)):
            text = (value.as_py() or "").encode()
            if texts and held + len(text) > most:
                yield batch.slice(start, len(texts)), texts
                start, texts, held = row, [], 0
            texts.append(text)
            held += len(text)
        if texts:
            yield batch.slice(start, len(texts)), texts


# --- components -------------------------------------------------------------------------------------


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs to ``(node, component)``, component the least node of it.

    Each node is hooked to the least node near it and paths are halved, until nothing changes; every round is
    written, and all rows stay on the executors. Only the number of changes comes to the driver.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    both = stash(both, "component-arcs")
    while True:
        # large star: larger neighbours of u go to the least node near u
        arcs = both.select("u", "v").union(both.select(F.col("v"), F.col("u")))
        low = stash(arcs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "component-least")
        large = arcs.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node and its smaller neighbours go to the least of these
        low = stash(large.groupBy("u").agg(F.min("v").alias("m")), "component-least")
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small = stash(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "component-arcs")
        same = small.join(both, ["u", "v"], "left_anti").isEmpty() and both.join(small, ["u", "v"], "left_anti").isEmpty()
        both = small
        if same:
            break
    member = both.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return member.union(both.select(F.col("v"), F.col("v")).distinct())
