"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are parted by the size of their shingle sets into classes of a factor of two. For each class a document is cut
into windows of four times the class's least size, each overlapping the next by half, so that an item's occurrence lies
in one window whose size is close to its own: there a MinHash collision is likely, however long the document. A window
that shares a minimum with an item makes a candidate; the item's shingles are then looked up among all of the
document's. The search reads whole documents where they lie, without a shuffle.

Shingles are five words, A-Z taken as a-z. A null or empty text has none and matches nothing; an item or document of
fewer than five words is one shingle. Repeated items and rows are all reported; extra columns are not read. Identifiers
are whole numbers or null.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def minhash_rounds(threshold: float, miss: float) -> int:
    """Minima needed to miss an item at the threshold with at most probability ``miss``.

    At worst the item has the least size of its class and a window is four times as large.
    """
    likeness = threshold / (4 + 1 - threshold)
    return math.ceil(math.log(miss) / math.log(1 - likeness))


class ItemIndex:
    """Minima of some items by size class, with their shingles."""

    def __init__(self, items: list[tuple[int, str | None]], rounds: int, size: int):
        texts = [(t or "").encode() for _, t in items]
        hashes, offsets = common.shingle_hashes(*common.word_hashes(texts), size)
        self.ids = [i for i, _ in items]
        self.shingles = [np.unique(hashes[offsets[k] : offsets[k + 1]]) for k in range(len(items))]
        self.factors = common.mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
        #: class -> (items of the class, per round the sorted minima and their items)
        self.classes: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        by_class: dict[int, list[int]] = {}
        for k, s in enumerate(self.shingles):
            if len(s):
                by_class.setdefault(len(s).bit_length() - 1, []).append(k)
        for c, members in by_class.items():
            tables = []
            joint = np.concatenate([self.shingles[k] for k in members])
            starts = np.cumsum([0, *(len(self.shingles[k]) for k in members[:-1])])
            for factor in self.factors:
                minima = np.minimum.reduceat(permuted(joint, factor), starts)
                order = np.argsort(minima, kind="stable")
                tables.append((minima[order], np.array(members)[order]))
            self.classes[c] = tables

    def candidates(self, hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Distinct (document, item) rows of the batch that share a minimum in some window."""
        counts = np.diff(offsets)
        full = np.flatnonzero(counts)
        cuts = {}
        for c in self.classes:
            step = 2 << c
            blocks = -(-counts[full] // step)
            owner = np.repeat(full, blocks)
            first = np.concatenate([np.zeros(1, np.int64), np.cumsum(blocks)])[:-1]
            within = np.arange(len(owner)) - np.repeat(first, blocks)
            cuts[c] = (offsets[owner] + within * step, owner)
        pairs = []
        for r, factor in enumerate(self.factors):
            values = permuted(hashes, factor)
            for c, tables in self.classes.items():
                starts, owner = cuts[c]
                minima, members = tables[r]
                least = np.minimum.reduceat(values, starts)
                # the last block of a document has no successor: it is its own window, within the one before
                joint = np.where(owner[:-1] == owner[1:], np.minimum(least[:-1], least[1:]), least[:-1])
                window = np.concatenate([joint, least[-1:]])
                at = np.searchsorted(minima, window)
                hit = np.flatnonzero(minima[np.minimum(at, len(minima) - 1)] == window)
                if len(hit):
                    ends = np.searchsorted(minima, window[hit], "right")
                    n = ends - at[hit]
                    place = np.repeat(at[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    pairs.append(np.stack([np.repeat(owner[hit], n), members[place]], axis=1))
        return np.unique(np.concatenate(pairs), axis=0) if pairs else np.empty((0, 2), np.int64)


def permuted(hashes: np.ndarray, factor: np.uint64) -> np.ndarray:
    return (hashes ^ (hashes >> np.uint64(29))) * factor


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = 0.8, size: int = 5, miss: float = 1e-4, block_bytes: int = 32 << 20) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared): documents that hold ``threshold`` or more of an item's distinct shingles.

    The index of the items is broadcast in blocks of at most about ``block_bytes`` of text, one pass over the
    documents for each, so what is broadcast is bounded whatever the benchmark's size.
    """
    spark = docs.sparkSession
    common.ship_package(spark)
    blocks = max(1, math.ceil(common.total_bytes(benchmark, item_text) / block_bytes))
    rounds = minhash_rounds(threshold, miss)
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for block in range(blocks):
        part = benchmark.where(F.pmod(F.xxhash64(item_id), F.lit(blocks)) == block)
        items = [(r[0], r[1]) for r in part.select(F.col(item_id).cast("long"), item_text).collect()]
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, name=uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            from caselattice.llm import decontaminate

            held_index = common.held_by("decontaminate")
            if name not in held_index:  # a worker builds each block's index once and holds one
                held_index.clear()
                held_index[name] = decontaminate.ItemIndex(shared.value, rounds, size)
            index = held_index[name]
            for rows, texts in common.text_chunks(batches, 1):
                hashes, offsets = common.shingle_hashes(*common.word_hashes(texts), size)
                out: list[tuple] = []
                held, own = -1, None
                for d, k in index.candidates(hashes, offsets) if len(hashes) and index.classes else ():
                    if d != held:
                        held, own = d, np.unique(hashes[offsets[d] : offsets[d + 1]])
                    wanted = index.shingles[k]
                    n = int((own[np.minimum(np.searchsorted(own, wanted), len(own) - 1)] == wanted).sum())
                    if n >= threshold * len(wanted):
                        out.append((rows.column(0)[int(d)].as_py(), index.ids[k], len(wanted), n))
                columns = list(zip(*out, strict=True)) if out else [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "item_id", "n_item", "n_shared"])

        leaks = named.mapInArrow(run, "doc_id long, item_id long, n_item long, n_shared long")
        found = leaks if found is None else found.unionByName(leaks)
    return found
