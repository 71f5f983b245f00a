"""Scoring by context-tree weighting over bytes, beside a word-count base.

A byte is eight binary decisions; each decision has a context tree over the ``depth`` bytes before it. Every node of a
tree holds the counts of its decision and a Krichevsky-Trofimov estimate; a node's weighted probability mixes its own
estimate with that of its children, so each decision is predicted by all depths, weighted by how well they coded the
training texts. Contexts not met in training leave the prediction to the deepest one that was met.

Counts come from every training text, in full. Texts are kept in shards; a shard's distinct contexts and words are
sent to tasks that own a share of them, and only what it asked for comes back, so no task holds the whole model and
nothing that grows with the corpus is broadcast. Trees are parted by the last two bytes of context; what joins them,
two bytes deep, is bounded by the alphabet. An owner's trees are read once for the questions of about a thousand shards,
which pass by in order. A shard has ``shard_bytes`` of text, or one longer text, which bounds its distinct contexts, too.

Null texts are empty. A text ends with one end mark, which is scored. That mark and what stands before a text are bytes
that UTF-8 never has, so the code of a text is that of no other's beginning, whatever bytes it has. Repeated rows are
scored and learnt as often as they occur; an empty table or no training row gives uniform predictions. A-Z count as a-z.
Identifiers are whole numbers or null.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import pack, pack_sorted, unpack, unpack_sorted

_U = np.uint64
_LOWER = bytes(range(256)).lower()
#: Bytes that no UTF-8 text has.
BEFORE, END = b"\xfe", b"\xff"
CHUNK_BYTES = 1 << 20


# --- counts of contexts -----------------------------------------------------------------------------


def byte_grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte and end mark of some lower-cased texts the byte with its ``depth`` predecessors, and the lengths.

    Before a text stand ``depth`` times BEFORE, and behind it END.
    """
    pad = BEFORE * depth
    raw = np.frombuffer(b"".join([x for t in texts for x in (pad, t, END)]), np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    n = len(raw) - depth
    grams = np.zeros(max(n, 0), np.uint64)
    for k in range(depth + 1):
        grams = (grams << _U(8)) | raw[k : k + n]
    inside = np.ones(n, bool)
    ends = np.cumsum(lengths + depth)[:-1] - depth  # the pads between texts are no positions
    for k in range(depth):
        inside[ends + k] = False
    return grams[inside], lengths


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(sorted_keys)), bool), sorted_keys[1:] != sorted_keys[:-1]]))


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    starts = _runs(k)
    return k[starts], np.add.reduceat(c, starts) if len(starts) else c


# --- context trees ----------------------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log gamma by Stirling's series, shifted up where it is small."""
    shift = np.where(x < 16, 1.0, 0.0)
    low, out = x.copy(), np.zeros_like(x)
    for _ in range(16):
        step = (low < 16) & (shift > 0)
        out -= np.where(step, np.log(np.where(step, low, 1.0)), 0.0)
        low = low + step
    return out + (low - 0.5) * np.log(low) - low + 0.9189385332046727 + 1 / (12 * low) - 1 / (360 * low**3) + 1 / (1260 * low**5)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability of a sequence of n0 zeros and n1 ones under the Krichevsky-Trofimov estimate."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


class Level:
    """The nodes of one depth: key (context << 8 | bits of the byte so far), counts, and the own estimate's share."""

    def __init__(self, nodes: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: tuple[np.ndarray, np.ndarray] | None):
        self.nodes, self.n0, self.n1 = nodes, n0, n1
        own = log_kt(n0, n1)
        if below is None:
            self.share, self.weighted = np.ones(len(nodes)), own
        else:
            rest = np.bincount(np.searchsorted(nodes, below[0]), weights=below[1], minlength=len(nodes))
            self.share = 1 / (1 + np.exp(np.clip(rest - own, -700, 700)))
            self.weighted = np.logaddexp(own, rest) - math.log(2)

    def parents(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of these nodes, ``depth`` deep, one byte of context shorter, with their weighted probabilities."""
        context = (self.nodes >> _U(8)) & _U((1 << (8 * (depth - 1))) - 1)
        return (context << _U(8)) | (self.nodes & _U(255)), self.weighted


def _prefix(byte: np.ndarray, k: int) -> np.ndarray:
    return (byte >> _U(8 - k)) | _U(1 << k)


def decisions(grams: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of ``depth`` with their zeros and ones, from counted bytes with at least that much context."""
    keys = grams & _U((1 << (8 * (depth + 1))) - 1)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(float)
    starts = _runs(keys)
    keys, counts = keys[starts], np.add.reduceat(counts, starts)
    byte, context = keys & _U(255), (keys >> _U(8)) << _U(8)
    nodes, place = np.unique(np.concatenate([context | _prefix(byte, k) for k in range(8)]), return_inverse=True)
    ones = np.concatenate([((byte >> _U(7 - k)) & _U(1)).astype(bool) for k in range(8)])
    weights = np.tile(counts, 8)
    return nodes, np.bincount(place, weights * ~ones, len(nodes)), np.bincount(place, weights * ones, len(nodes))


def build_levels(grams: np.ndarray, counts: np.ndarray, deepest: int, least: int) -> dict[int, Level]:
    """Levels from ``deepest`` up to ``least`` of the trees that some training counts make."""
    met = counts > 0
    levels: dict[int, Level] = {}
    for depth in range(deepest, least - 1, -1):
        below = levels[depth + 1].parents(depth + 1) if depth < deepest else None
        levels[depth] = Level(*decisions(grams[met], counts[met], depth), below)
    return levels


def log10_bytes(grams: np.ndarray, levels: dict[int, Level]) -> np.ndarray:
    """log10 probability of each gram's byte after its context; ``levels`` has all depths from 0."""
    total, byte = np.zeros(len(grams)), grams & _U(255)
    for k in range(8):
        node, one = _prefix(byte, k), ((byte >> _U(7 - k)) & _U(1)).astype(bool)
        mixed = np.full(len(grams), np.nan)
        for depth in sorted(levels, reverse=True):
            level = levels[depth]
            if not len(level.nodes):
                continue
            key = (((grams >> _U(8)) & _U((1 << (8 * depth)) - 1)) << _U(8)) | node
            at = np.minimum(np.searchsorted(level.nodes, key), len(level.nodes) - 1)
            n0, n1 = level.n0[at], level.n1[at]
            own = (np.where(one, n1, n0) + 0.5) / (n0 + n1 + 1)
            share = level.share[at]
            value = np.where(np.isnan(mixed), own, share * own + (1 - share) * np.nan_to_num(mixed))
            mixed = np.where(level.nodes[at] == key, value, np.nan)
        total += np.log10(np.where(np.isnan(mixed), 0.5, mixed))
    return total


# --- shards -----------------------------------------------------------------------------------------


def _shards(docs: DataFrame, shard_bytes: int) -> DataFrame:
    """(shard, ids, held, texts): rows of about CHUNK_BYTES of lower-cased text; shards in the order of the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from caselattice.llm import lm_score
        common.held_by("lm_score")

        squeeze = zstandard.ZstdCompressor(level=3).compress
        part, seen = TaskContext.get().partitionId(), 0
        for rows, texts in common.text_chunks(batches, 2, CHUNK_BYTES):
            texts = [t.translate(lm_score._LOWER) for t in texts]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            record = {
                "shard": pa.array([(part << 32) + seen // shard_bytes], pa.int64()), "ids": pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())), "held": pa.array([rows.column(1).to_pylist()], pa.list_(pa.bool_())),
                "sizes": pa.array([lm_score.pack(sizes)], pa.binary()), "texts": pa.array([squeeze(b"".join(texts))], pa.binary()),
            }
            seen += int(sizes.sum())
            yield pa.RecordBatch.from_pydict(record)

    return common.stash(docs.mapInArrow(run, "shard long, ids array<long>, held array<boolean>, sizes binary, texts binary"), "lm-shards")


def _texts(sizes: bytes, texts: bytes) -> list[bytes]:
    whole, out, at = zstandard.ZstdDecompressor().decompress(texts), [], 0
    for n in unpack(sizes, np.int64).tolist():
        out.append(whole[at : at + n])
        at += n
    return out


_REQUESTS = "kind int, owner long, shard long, keys binary, counts binary"


def _requests(shards: DataFrame, depth: int, owners: int) -> DataFrame:
    """What each shard has: kind 0, words with their training counts by owner; kind 1, grams by two bytes of context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import lm_score
        common.held_by("lm_score")

        state: dict = {}

        def begin(shard) -> None:
            state.update(shard=shard, words=Counter(), others=set(), keys=[], counts=[], held=0)

        def fold() -> None:
            if len(state["keys"]) > 1:
                k, c = lm_score.merge_counts(state["keys"], state["counts"])
                state.update(keys=[k], counts=[c])

        def drain() -> Iterator[pa.RecordBatch]:
            parts: dict[int, list[bytes]] = {}
            words = state["words"]
            for w in words:
                parts.setdefault(zlib.crc32(w) % owners, []).append(w)
            for w in state["others"]:
                if w not in words:
                    parts.setdefault(zlib.crc32(w) % owners, []).append(w)
            squeeze = zstandard.ZstdCompressor(level=3).compress
            rows = [(0, p, state["shard"], squeeze(b" ".join(ws)), lm_score.pack(np.fromiter((words[w] for w in ws), np.int64, len(ws)))) for p, ws in parts.items()]
            fold()
            if state["keys"]:
                keys, counts = state["keys"][0], state["counts"][0]
                owner = (keys >> _U(8)) & _U(0xFFFF)
                order = np.argsort(owner, kind="stable")
                starts = np.append(_runs(owner[order]), len(order))
                for a, b in zip(starts[:-1], starts[1:], strict=True):
                    own = order[a:b]
                    rows.append((1, int(owner[own[0]]), state["shard"], lm_score.pack_sorted(keys[own]), lm_score.pack(counts[own])))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["kind", "owner", "shard", "keys", "counts"])

        for batch in batches:
            for i in range(batch.num_rows):
                shard, held, sizes, texts = (batch.column(k)[i].as_py() for k in (0, 2, 3, 4))
                if state.get("shard") != shard:
                    if state:
                        yield from drain()
                    begin(shard)
                own = lm_score._texts(sizes, texts)
                for text, out in zip(own, held, strict=True):
                    if out:
                        state["others"].update(text.split())
                    else:
                        state["words"].update(text.split())
                grams, lengths = lm_score.byte_grams(own, depth)
                # the lowest bit tells training bytes from the others
                marked = (grams << _U(1)) | np.repeat(~np.array(held, bool), lengths).astype(np.uint64)
                marked.sort()
                starts = _runs(marked >> _U(1))
                state["keys"].append(marked[starts] >> _U(1))
                state["counts"].append(np.add.reduceat((marked & _U(1)).astype(np.int64), starts))
                if len(state["keys"]) >= 4:
                    fold()
        if state:
            yield from drain()

    return common.stash(shards.mapInArrow(run, _REQUESTS), "lm-requests")


def _word_counts(requests: DataFrame) -> DataFrame:
    """(shard, words, counts, n, v): totals over all training texts for the words each shard asked for."""

    def total(table: pa.Table) -> pa.Table:
        from caselattice.llm import lm_score
        common.held_by("lm_score")

        unzip = zstandard.ZstdDecompressor().decompress
        asked = [unzip(k).split(b" ") for k in table.column("keys").to_pylist()]
        given = [lm_score.unpack(c, np.int64) for c in table.column("counts").to_pylist()]
        totals: dict[bytes, int] = {}
        get = totals.get
        for words, counts in zip(asked, given, strict=True):
            for w, c in zip(words, counts.tolist(), strict=True):
                totals[w] = get(w, 0) + c
        answers = [lm_score.pack(np.fromiter(map(totals.__getitem__, ws), np.int64, len(ws))) for ws in asked]
        n, v = sum(totals.values()), sum(c > 0 for c in totals.values())
        first = [i == 0 for i in range(len(asked))]
        return pa.table({"shard": table.column("shard"), "words": table.column("keys"), "counts": pa.array(answers, pa.binary()), "n": pa.array([n if f else 0 for f in first], pa.int64()), "v": pa.array([v if f else 0 for f in first], pa.int64())})

    return common.stash(requests.where("kind = 0").groupBy("owner").applyInArrow(total, "shard long, words binary, counts binary, n long, v long"), "lm-words")


def _tree_counts(requests: DataFrame, n_shards: int, fan_in: int = 64) -> DataFrame:
    """(owner, keys, counts), one row an owner: grams summed over shards by a tree of sums of ``fan_in`` rows each."""

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        from caselattice.llm import lm_score
        common.held_by("lm_score")

        keys, counts = lm_score.merge_counts([lm_score.unpack_sorted(k) for k in table.column("keys").to_pylist()], [lm_score.unpack(c, np.int64) for c in table.column("counts").to_pylist()])
        return pa.table({"owner": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([key[1].as_py() // fan_in], pa.int64()), "keys": pa.array([lm_score.pack_sorted(keys)], pa.binary()), "counts": pa.array([lm_score.pack(counts)], pa.binary())})

    rows = requests.where("kind = 1")
    # shards are dealt over the first layer's parts by a hash
    parts = max(1, math.ceil(n_shards / fan_in))
    rows = rows.select("owner", F.pmod(F.xxhash64("shard"), F.lit(parts)).alias("part"), "keys", "counts")
    while True:
        rows = rows.groupBy("owner", "part").applyInArrow(merge, "owner long, part long, keys binary, counts binary")
        if parts == 1:
            return common.stash(rows.select("owner", "keys", "counts"), "lm-grams")
        parts = math.ceil(parts / fan_in)


class _Top:
    """Levels 0 and 1, whose size the alphabet bounds: at most 257 contexts of 255 decisions."""

    def __init__(self, one: tuple[np.ndarray, ...]):
        nodes, n0, n1, rest = one
        order = np.argsort(nodes)
        nodes, n0, n1, rest = nodes[order], n0[order], n1[order], rest[order]
        level = Level(nodes, n0, n1, (nodes, rest)) if len(nodes) else Level(nodes, n0, n1, None)
        up, weighted = level.parents(1)
        root, place = np.unique(up, return_inverse=True)
        level0 = Level(root, np.bincount(place, n0, len(root)), np.bincount(place, n1, len(root)), (up, weighted))
        self.levels = {1: level, 0: level0}


def _top(counts: DataFrame, depth: int) -> _Top:
    """The two upper levels. Owners give their nodes two bytes deep, these are summed by the last byte of context."""

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import lm_score
        common.held_by("lm_score")

        for batch in batches:
            for i in range(batch.num_rows):
                grams, n = lm_score.unpack_sorted(batch.column(1)[i].as_py()), lm_score.unpack(batch.column(2)[i].as_py(), np.int64)
                level = lm_score.build_levels(grams, n, depth, 2)[2]
                nodes, weighted = level.parents(2)
                packed = [pa.array([lm_score.pack(x)], pa.binary()) for x in (nodes, level.n0, level.n1, weighted)]
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[i].as_py() & 255], pa.int64()), *packed], names=["last", "nodes", "n0", "n1", "rest"])

    def first(table: pa.Table) -> pa.Table:
        from caselattice.llm import lm_score
        common.held_by("lm_score")

        columns = [np.concatenate([lm_score.unpack(x, k) for x in table.column(c).to_pylist()]) for c, k in (("nodes", np.uint64), ("n0", float), ("n1", float), ("rest", float))]
        nodes, place = np.unique(columns[0], return_inverse=True)
        summed = [np.bincount(place, c, len(nodes)) for c in columns[1:]]
        return pa.table({c: pa.array([lm_score.pack(x)], pa.binary()) for c, x in zip(("nodes", "n0", "n1", "rest"), (nodes, *summed), strict=True)})

    schema = "nodes binary, n0 binary, n1 binary, rest binary"
    rows = counts.mapInArrow(second, f"last long, {schema}").groupBy("last").applyInArrow(first, schema).collect()  # at most 256 rows
    kinds = (np.uint64, float, float, float)
    return _Top(tuple(np.concatenate([unpack(bytes(r[j]), kinds[j]) for r in rows]) if rows else np.empty(0, kinds[j]) for j in range(4)))


def _model(counts: DataFrame, top: _Top, depth: int) -> DataFrame:
    """(owner, keys, logs): log10 probability of every gram that any text has."""
    shared = counts.sparkSession.sparkContext.broadcast(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import lm_score
        common.held_by("lm_score")

        for batch in batches:
            for i in range(batch.num_rows):
                grams, n = lm_score.unpack_sorted(batch.column(1)[i].as_py()), lm_score.unpack(batch.column(2)[i].as_py(), np.int64)
                levels = lm_score.build_levels(grams, n, depth, 2) | shared.value.levels if n.any() else shared.value.levels
                logs = lm_score.log10_bytes(grams, levels)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([lm_score.pack(logs.astype(np.float32))], pa.binary())], names=["owner", "keys", "logs"])

    return common.stash(counts.mapInArrow(run, "owner long, keys binary, logs binary"), "lm-model")


def _answers(requests: DataFrame, model: DataFrame, n_shards: int, fan_in: int = 1024) -> DataFrame:
    """(shard, keys, logs) for what each shard asked: an owner's row stands before the requests of ``fan_in`` shards, which
    are answered one after the other. No task holds more than an owner's row and a batch of requests."""
    parts = max(1, math.ceil(n_shards / fan_in))
    nothing = F.lit(None).cast("binary")
    asked = requests.where("kind = 1").select("owner", F.pmod(F.xxhash64("shard"), F.lit(parts)).alias("part"), F.lit(1).alias("kind"), "shard", "keys", nothing.alias("logs"))
    known = model.select("owner", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("shard"), "keys", "logs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import lm_score
        common.held_by("lm_score")

        keys, logs = np.empty(0, np.uint64), np.empty(0, np.float32)
        for batch in batches:
            out: list[tuple] = []
            for i, kind in enumerate(batch.column(2).to_pylist()):
                own = lm_score.unpack_sorted(batch.column(4)[i].as_py())
                if kind:
                    out.append((batch.column(3)[i].as_py(), batch.column(4)[i].as_py(), lm_score.pack(logs[np.searchsorted(keys, own)])))
                else:
                    keys, logs = own, lm_score.unpack(batch.column(5)[i].as_py(), np.float32)
            columns = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["shard", "keys", "logs"])

    met = known.unionByName(asked).repartition("owner", "part").sortWithinPartitions("owner", "part", "kind")
    return met.mapInArrow(run, "shard long, keys binary, logs binary")


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, n_bytes long, score double"


def score(docs: DataFrame, held: Column, *, doc_id: str = "doc_id", text: str = "text", depth: int = 5, shard_bytes: int = 32 << 20, owner_bytes: int = 16 << 20) -> DataFrame:
    """Scores of every whole text by trees and by word counts learnt from the rows where ``held`` is false or null.

    score: log10 probability of the bytes and the end mark; base_score: of the words and the end under counts plus one.
    -score / log10(2) / n_bytes is the code length in bits per byte. ``depth`` is from 2 to 6.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth is from 2 to 6: trees are parted by two bytes, and a key holds seven")
    common.ship_package(docs.sparkSession)
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held"), F.col(text).alias("text"))
    shards = _shards(named, shard_bytes)
    size = shards.select(F.countDistinct("shard"), F.coalesce(F.sum(F.octet_length("texts").cast("long")), F.lit(0)), F.coalesce(F.sum(F.size(F.filter("held", lambda h: ~h))), F.lit(0))).first()
    n_shards, squeezed, n_train = size
    requests = _requests(shards, depth, max(8, math.ceil(3 * squeezed / owner_bytes)))
    words = _word_counts(requests)
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    n, v = n + n_train, v + (n_train > 0)
    counts = _tree_counts(requests, n_shards)
    model = _model(counts, _top(counts, depth), depth)
    nothing = F.lit(None).cast("binary")
    answers = words.select("shard", "words", "counts", nothing.alias("keys"), nothing.alias("logs")).unionByName(_answers(requests, model, n_shards).select("shard", nothing.alias("words"), nothing.alias("counts"), "keys", "logs"))

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        from caselattice.llm import lm_score
        common.held_by("lm_score")

        logs, unknown = {}, set()
        unzip = zstandard.ZstdDecompressor().decompress
        keys, values = [], []
        whole = math.log10(n + v + 1)
        for w, c, k, g in zip(*(answers.column(x).to_pylist() for x in ("words", "counts", "keys", "logs")), strict=True):
            if w is not None:
                own, totals = unzip(w).split(b" "), lm_score.unpack(c, np.int64)
                logs.update(zip(own, (np.log10(totals + 1.0) - whole).tolist(), strict=True))
                unknown.update(x for x, t in zip(own, totals.tolist(), strict=True) if not t)
            else:
                keys.append(lm_score.unpack_sorted(k))
                values.append(lm_score.unpack(g, np.float32))
        key = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        order = np.argsort(key)
        key, value = key[order], np.concatenate(values)[order].astype(float) if values else np.empty(0)
        end = math.log10(n_train + 1) - whole
        out: dict[str, list] = {c: [] for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "n_bytes", "score")}
        for ids, held, sizes, blob in zip(*(texts.column(x).to_pylist() for x in ("ids", "held", "sizes", "texts")), strict=True):
            own = lm_score._texts(sizes, blob)
            out["doc_id"] += ids
            out["held_out"] += held
            for t in own:
                ws = t.split()
                out["n_tokens"].append(len(ws) + 1)
                out["n_known"].append(len(ws) - sum(map(unknown.__contains__, ws)) + (n_train > 0))
                out["base_score"].append(math.fsum(map(logs.__getitem__, ws)) + end)
                out["n_bytes"].append(len(t))
            for a in range(0, len(own), 1 << 15):
                grams, lengths = lm_score.byte_grams(own[a : a + (1 << 15)], depth)
                if depth <= 5:  # a text's number fits above the gram: sorted keys are looked up in order
                    tagged = (np.repeat(np.arange(len(lengths)), lengths).astype(np.uint64)) | (grams << _U(16))
                    tagged.sort()
                    at = np.searchsorted(key, tagged >> _U(16))
                    sums = np.bincount((tagged & _U(0xFFFF)).astype(np.int64), value[at], len(lengths))
                else:
                    sums = np.bincount(np.repeat(np.arange(len(lengths)), lengths), value[np.searchsorted(key, grams)], len(lengths))
                out["score"] += sums.tolist()
        out["train_tokens"] = [n] * len(out["doc_id"])
        kinds = {"doc_id": pa.int64(), "held_out": pa.bool_(), "base_score": pa.float64(), "score": pa.float64()}
        return pa.table({c: pa.array(out[c], kinds.get(c, pa.int64())) for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "n_bytes", "score")})

    return shards.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(run, _SCORES)
