"""Jaccard similarity join of word n-gram sets by the chosen-path method.

Equal sets are one node. Nodes are split, run by run, on the values of sampled MinHash coordinates, that is on shared
tokens: at each bucket two coordinates are drawn, so a pair at the threshold stays together with a probability that
does not fall with depth, and runs repeat until the target recall. Small buckets are compared by brute force on
sketches. In a large one every node is first compared with a leader; nodes alike to it carry its label, and a bucket
whose nodes all have one label needs no more splitting, so groups of near copies end at once.

Sketches only propose components; within each the sets are compared exactly, in blocks, which counts every link and
splits the component where no link holds it. No pair is ever a row: tasks return counts per node and forest edges.

Sets are of ``size`` words, A-Z taken as a-z; a shorter text with words is one n-gram. Null and empty texts have no
set and link to nothing. Rows repeated under one identifier are rows of their own; a row without identifier
gets links only from texts equal to one that has. Identifiers are whole numbers or null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

_U = np.uint64
COORDINATES = 128
BRANCHES = 2
LEAF, DEEPEST, BLOCK = 2048, 8, 256
#: Nodes to verify up to which their identifiers are broadcast (16 bytes each); beyond it they are joined by a shuffle.
BROADCAST_NODES = 500_000

_FACTORS = common.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _U(0xA24BAED4963EE407)) | _U(1)


def runs_needed(threshold: float, recall: float) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``: survival solves f = 1 - (1 - tf)^2."""
    survive = (2 * threshold - 1) / threshold**2
    return math.ceil(math.log(1 - recall) / math.log(1 - survive))


def sets_of(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of each text in ascending order, where each text's begin, and a 64-bit identity of each set."""
    hashes, offsets = common.shingle_hashes(*common.word_hashes(texts), size)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        first = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
        hashes, owner = hashes[first], owner[first]
    begins = np.searchsorted(owner, np.arange(len(texts) + 1))
    identity, full = np.zeros(len(texts), np.uint64), np.diff(begins) > 0
    if full.any():
        one = np.add.reduceat(common.mix(hashes), begins[:-1][full])
        two = np.bitwise_xor.reduceat(common.mix(hashes * _FACTORS[0]), begins[:-1][full])
        identity[full] = common.mix(one ^ common.mix(two + np.diff(begins)[full].astype(np.uint64)))
    return hashes, begins, identity


def root_coordinates(runs: int) -> np.ndarray:
    """The coordinates drawn at the root of each run, BRANCHES of them."""
    return (common.mix(np.arange(1, runs * BRANCHES + 1, dtype=np.uint64) * _FACTORS[0]) % _U(COORDINATES)).astype(np.int64)


def sketches(hashes: np.ndarray, begins: np.ndarray, runs: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each non-empty set: the keys of its buckets below the roots, by whole MinHash values, and COORDINATES of them
    in 8 bits each, which is enough to compare sets and to split buckets further."""
    full = begins[:-1][np.diff(begins) > 0]
    drawn = root_coordinates(runs)
    sig, keys = np.empty((len(full), COORDINATES), np.uint8), np.empty((len(full), len(drawn)), np.int64)
    if len(full):
        folded = hashes ^ (hashes >> _U(29))
        for k, factor in enumerate(_FACTORS):
            least = common.mix(np.minimum.reduceat(folded * factor, full))
            sig[:, k] = least & _U(0xFF)
            for place in np.flatnonzero(drawn == k):
                keys[:, place] = common.mix(least ^ common.mix(_FACTORS[1] + _U(place + 1))).view(np.int64)
    return sig, keys


def alike(sig: np.ndarray, cut: float) -> np.ndarray:
    """Which rows of ``sig`` have ``cut`` or more of their coordinates in common, as a symmetric matrix.

    One bit of each coordinate goes first, in a matrix product: rows as like as that agree in (1 + cut) / 2 of the bits,
    less six standard errors; whole coordinates settle the rows that pass.
    """
    bits = (sig & np.uint8(1)).astype(np.float32) * 2 - 1
    slack = 6 * 2 * math.sqrt((1 + cut) / 2 * (1 - cut) / 2 / COORDINATES)
    out = np.zeros((len(sig), len(sig)), bool)
    for i in range(0, len(sig), 256):
        near = bits[i : i + 256] @ bits[i:].T >= COORDINATES * (cut - slack)
        a, b = np.nonzero(near)
        later = b > a
        a, b = a[later] + i, b[later] + i
        for k in range(0, len(a), 1 << 15):
            x, y = a[k : k + (1 << 15)], b[k : k + (1 << 15)]
            same = (sig[x] == sig[y]).mean(axis=1) >= cut
            out[x[same], y[same]] = True
    return out | out.T


def forest(nodes: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (node, least node of its component) of a symmetric matrix of links."""
    label = np.arange(len(nodes), dtype=np.int32)
    while True:
        low = np.where(linked, label[None, :], np.int32(len(nodes))).min(axis=1)
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return [(int(nodes[i]), int(nodes[label[i]])) for i in range(len(nodes)) if label[i] != i]


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows that agree in the first ``keys`` columns of sorted input; a run may span batches."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        cuts = [0, *change.tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(int(c[a]) for c in columns)
            if held and key != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(a, b - a))
    if held:
        yield held_key, pa.Table.from_batches(held)


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _child_keys(parent: np.ndarray, sig: np.ndarray, branch: int) -> np.ndarray:
    """A child bucket's key: its parent's, the coordinate drawn there, and a node's value of it."""
    draw = common.mix(parent.view(np.uint64) + _FACTORS[branch])
    at = (draw % _U(COORDINATES)).astype(np.int64)
    return common.mix(draw + sig[np.arange(len(sig)), at].astype(np.uint64) * _FACTORS[branch + 2]).view(np.int64)


def _nodes(docs: DataFrame, size: int, runs: int) -> DataFrame:
    """(doc_id, node, n, sig, keys) of every row; node is null where a text has no set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import ngram_join
        common.held_by("ngram_join")

        for rows, texts in common.text_chunks(batches, 1):
            hashes, begins, identity = ngram_join.sets_of(texts, size)
            sig, keys = ngram_join.sketches(hashes, begins, runs)
            full = np.diff(begins) > 0
            packed, listed = iter(sig), iter(keys.tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0), pa.array(identity.view(np.int64), mask=~full), pa.array(np.diff(begins), pa.int64()),
                    pa.array([next(packed).tobytes() if f else None for f in full], pa.binary()), pa.array([next(listed) if f else None for f in full], pa.list_(pa.int64())),
                ],
                names=["doc_id", "node", "n", "sig", "keys"],
            )

    return docs.mapInArrow(run, "doc_id long, node long, n long, sig binary, keys array<long>")


def _split(rows: DataFrame) -> DataFrame:
    """(key, node, label, sig) to the children of each row's bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import ngram_join
        common.held_by("ngram_join")

        for batch in batches:
            if batch.num_rows:
                sig = ngram_join._signatures(batch.column(3))
                for branch in range(BRANCHES):
                    keys = ngram_join._child_keys(batch.column(0).to_numpy(), sig, branch)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), *batch.columns[1:]], names=["key", "node", "label", "sig"])

    return rows.mapInArrow(run, "key long, node long, label long, sig binary")


def _compare_leaves(rows: DataFrame, cut: float) -> DataFrame:
    """Forest edges of the small buckets of (key, node, label, sig): pairs of different labels, by brute force."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import ngram_join
        common.held_by("ngram_join")

        edges: list[tuple[int, int]] = []
        for _, table in ngram_join._groups(batches, 1):
            node, sig = table.column(1).to_numpy(), ngram_join._signatures(table.column(3))
            if len(node) == 2:
                if node[0] != node[1] and (sig[0] == sig[1]).mean() >= cut:
                    edges.append((int(node[0]), int(node[1])))
            elif len(node) > 2:
                edges += ngram_join.forest(node, ngram_join.alike(sig, cut))
            if len(edges) > 20_000:
                yield ngram_join._edge_batch(edges)
                edges = []
        yield ngram_join._edge_batch(edges)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def _compare_blocks(rows: DataFrame, cut: float) -> DataFrame:
    """Forest edges of buckets that stay large: their nodes are dealt into blocks and each two blocks meet in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import ngram_join
        common.held_by("ngram_join")

        for _, table in ngram_join._groups(batches, 3):
            node, sig = table.column(3).to_numpy(), ngram_join._signatures(table.column(4))
            yield ngram_join._edge_batch(ngram_join.forest(node, ngram_join.alike(sig, cut)))

    return _in_blocks(rows, "key", ["node", "sig"]).mapInArrow(run, "a long, b long")


def _in_blocks(rows: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Each row of a group once for every two blocks (one, other) it belongs to, sorted by group and blocks.

    ``rows`` has the group's size as n_rows. Blocks hold BLOCK rows on average, by a hash of the node.
    """
    blocks = F.ceil(F.col("n_rows") / BLOCK).cast("long")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    met = rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = met.select(group, F.least("own", "with").alias("one"), F.greatest("own", "with").alias("other"), *columns)
    return paired.repartition(group, "one", "other").sortWithinPartitions(group, "one", "other")


def candidate_edges(nodes: DataFrame, *, threshold: float) -> DataFrame:
    """Edges whose components hold every pair of nodes at the threshold, but for the recall. ``nodes`` has node,
    sig and keys; there are as many keys as the recall asks for."""
    cut = threshold - 5 * math.sqrt(threshold * (1 - threshold) / COORDINATES)
    first = nodes.select("node", F.explode("keys").alias("key"))
    sizes = first.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    rows = first.join(common.stash(sizes, "join-sizes"), "key")
    rows = common.stash(rows.join(nodes.select("node", "sig"), "node").select("key", "node", F.col("node").alias("label"), "sig", "n_rows"), "join-buckets")
    edges = _compare_leaves(rows.where(F.col("n_rows") <= LEAF).drop("n_rows"), cut)
    large = rows.where(F.col("n_rows") > LEAF)
    for depth in range(1, DEEPEST + 1):
        if large.isEmpty():
            return edges
        # every node meets the leader of its bucket
        order = F.xxhash64("node", F.lit(depth))
        leaders = large.groupBy("key").agg(F.min_by(F.struct("node", "label", "sig"), order).alias("leader"))
        leaders = common.stash(leaders.select("key", F.col("leader.node").alias("to"), F.col("leader.label").alias("to_label"), F.col("leader.sig").alias("to_sig")), "join-leaders")
        judged = common.stash(_against(large.join(leaders, "key"), cut), "join-judged")
        edges = edges.union(judged.where("alike AND node <> to AND label <> to_label").select(F.col("node").alias("a"), F.col("to").alias("b")))
        labelled = judged.select("key", "node", F.when(F.col("alike"), F.col("to_label")).otherwise(F.col("label")).alias("label"), "sig", "n_rows")
        mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
        open_rows = labelled.join(common.stash(mixed, "join-mixed"), "key", "left_semi")
        if depth == DEEPEST:
            return edges.union(_compare_blocks(open_rows, cut))
        children = common.stash(_split(open_rows.select("key", "node", "label", "sig")), "join-children")
        sizes = children.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"), F.min("label").alias("low"), F.max("label").alias("high")).where("n_rows > 1 AND low <> high").select("key", "n_rows")
        rows = common.stash(children.join(common.stash(sizes, "join-sizes"), "key").select("key", "node", "label", "sig", "n_rows"), "join-buckets")
        edges = edges.union(_compare_leaves(rows.where(F.col("n_rows") <= LEAF).drop("n_rows"), cut))
        large = rows.where(F.col("n_rows") > LEAF)
    return edges


def _against(rows: DataFrame, cut: float) -> DataFrame:
    """Adds whether each row's sketch is alike to that of its leader, and drops the latter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import ngram_join
        common.held_by("ngram_join")

        for batch in batches:
            if batch.num_rows:
                like = (ngram_join._signatures(batch.column(3)) == ngram_join._signatures(batch.column(7))).mean(axis=1) >= cut
                yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(like)], names=["key", "node", "label", "sig", "n_rows", "to", "to_label", "alike"])

    ordered = rows.select("key", "node", "label", "sig", "n_rows", "to", "to_label", "to_sig")
    return ordered.mapInArrow(run, "key long, node long, label long, sig binary, n_rows long, to long, to_label long, alike boolean")


def links_of(sets: list[np.ndarray], threshold: float, split: int | None = None) -> np.ndarray:
    """Which sets have a Jaccard similarity at the threshold, exactly; ``split`` compares only sets before it with later ones."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if n == 2:
        shared = np.intersect1d(sets[0], sets[1], assume_unique=True).size
        both = np.array([[0, shared], [shared, 0]])
    else:
        owner = np.repeat(np.arange(n), sizes)
        values, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        useful = counts > 1
        number = np.cumsum(useful) - 1
        keep = useful[column]
        owner, column = owner[keep], number[column[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        both = np.zeros((n, n), np.float64)
        width = max(1024, (1 << 22) // n)
        for a in range(0, int(useful.sum()), width):
            lo, hi = np.searchsorted(column, (a, a + width))
            block = np.zeros((n, min(width, int(useful.sum()) - a)), np.float32)
            block[owner[lo:hi], column[lo:hi] - a] = 1
            both += block @ block.T
        both = np.rint(both).astype(np.int64)
    linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
    np.fill_diagonal(linked, False)
    if split is not None:
        linked[:split, :split] = False
        linked[split:, split:] = False
    return linked


def _verified(members: DataFrame, docs: DataFrame, size: int, threshold: float) -> DataFrame:
    """Rows (node, links, to): a node's links counted in one meeting of blocks, or a forest edge (links null)."""
    spark = docs.sparkSession
    n = members.count()
    chosen = F.broadcast(members) if n <= BROADCAST_NODES else members

    def cut_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import ngram_join
        common.held_by("ngram_join")

        for rows, texts in common.text_chunks(batches, 0):
            hashes, begins, identity = ngram_join.sets_of(texts, size)
            right = identity.view(np.int64) == rows.column(1).to_numpy()
            packed = [hashes[begins[i] : begins[i + 1]].tobytes() if right[i] else None for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([*rows.columns[1:], pa.array(packed, pa.binary())], names=["node", "copies", "part", "n_rows", "grams"])

    found = docs.join(chosen, F.col("doc_id") == F.col("rep")).select("text", "node", "copies", "part", "n_rows")
    sets = found.mapInArrow(cut_sets, "node long, copies long, part long, n_rows long, grams binary").where("grams IS NOT NULL")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import ngram_join
        common.held_by("ngram_join")

        out: list[tuple] = []
        for (_, one, other), table in ngram_join._groups(batches, 3):
            table = table.sort_by([("own", "ascending"), ("node", "ascending")])
            node, keep = np.unique(table.column(3).to_numpy(), return_index=True)  # rows repeated under one identifier
            keep.sort()
            node = table.column(3).to_numpy()[keep]
            copies, own = table.column(4).to_numpy()[keep], table.column(6).to_numpy()[keep]
            grams = table.column(5)
            sets = [np.frombuffer(grams[int(i)].as_py(), np.uint64) for i in keep]
            if len(sets) < 2:
                continue
            split = None if one == other else int(np.searchsorted(own, other))
            linked = ngram_join.links_of(sets, threshold, split)
            counts = linked @ copies
            out += [(int(v), int(c), None) for v, c in zip(node, counts, strict=True) if c]
            out += [(a, None, b) for a, b in ngram_join.forest(node, linked)]
            if len(out) > 20_000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "to"])

    return common.stash(_in_blocks(sets, "part", ["node", "copies", "grams", "own"]).mapInArrow(meet, "node long, links long, to long"), "join-links")


def similarity_classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """(doc_id, class_id, rep_id, n_links) of every row.

    rep_id: the least identifier with the same set; class_id: that of all rows joined by links, directly or through
    others; n_links: how many other rows have a similarity of ``threshold`` or more to this one. Rows without a set are
    classes of their own.
    """
    common.ship_package(docs.sparkSession)
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = common.stash(_nodes(named, size, runs_needed(threshold, recall)), "join-nodes")
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("sig").alias("sig"), F.min("keys").alias("keys"))
    nodes = common.stash(nodes, "join-distinct")
    edges = common.stash(candidate_edges(nodes, threshold=threshold).distinct(), "join-edges")
    parts = common.connected_components(edges)
    sizes = parts.groupBy("component").agg(F.count(F.lit(1)).alias("n_rows"))
    members = parts.join(sizes, "component").select("node", F.col("component").alias("part"), "n_rows").join(nodes.select("node", "rep", "copies"), "node")
    members = common.stash(members.select("node", "rep", "copies", "part", "n_rows"), "join-members")
    verified = _verified(members, named, size, threshold)
    links = verified.where("links IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    parts = common.connected_components(verified.where("to IS NOT NULL").select(F.col("node").alias("a"), F.col("to").alias("b")))
    parts = parts.join(nodes.select("node", "rep"), "node")
    classes = parts.groupBy("component").agg(F.min("rep").alias("class_id"))
    joined = common.stash(parts.join(classes, "component").join(links, "node", "left").select("node", "class_id", "links"), "join-classes")
    known = rows.select("doc_id", "node").join(nodes.select("node", "rep", "copies"), "node", "left").join(joined, "node", "left")
    return known.select(
        "doc_id",
        F.coalesce("class_id", "rep", "doc_id").alias("class_id"),
        F.coalesce("rep", "doc_id").alias("rep_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
    )
