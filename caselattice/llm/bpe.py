"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece of text exactly one last token belongs to the prefix's true encoding: a token that ends
there and that goes with the last token of the prefix before it. Storing that token for each prefix gives the encoding
of every prefix at once, so bytes can be appended exactly, and an edit only touches the pieces around it.

Null texts count as empty; an empty text has no token. Equal rows give equal results and extra columns pass through.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

#: Pieces whose encoding a worker keeps, half of them those met since the other half was full: what is used stays. Bounds
#: memory only.
KEPT_PIECES = 500_000
KEPT_PAIRS = 500_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """The rank file's lines: a token in base 64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class PrefixEncoder:
    """Encodes pieces of bytes; holds a vocabulary and bounded memories of pairs and pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._alone: dict[int, bool] = {}
        self._pairs: dict[int, bool] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def _merged(self, data: bytes) -> list[int]:
        """The tokens of a few bytes by lowest rank first; used to judge single tokens and pairs."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def stands_alone(self, token: int) -> bool:
        """Whether merging a token's own bytes gives that token."""
        known = self._alone.get(token)
        if known is None:
            known = self._alone[token] = self._merged(self.bytes_of[token]) == [token]
        return known

    def goes_together(self, left: int, right: int) -> bool:
        """Whether two adjacent tokens stay as they are when their bytes are merged."""
        known = self._pairs.get(left << 32 | right)
        if known is None:
            known = self._merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            if len(self._pairs) < KEPT_PAIRS:
                self._pairs[left << 32 | right] = known
        return known

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """``last[i]`` is the last token of the prefix of i + 1 bytes; adds those that are missing for ``data``."""
        find, pair, longest = self.ranks.get, self._pairs.get, self.longest
        for end in range(len(last) + 1, len(data) + 1):
            if end <= longest:
                token = find(data[:end])
                if token is not None and self.stands_alone(token):
                    last.append(token)
                    continue
            for start in range(max(1, end - longest), end):
                token = find(data[start:end])
                if token is not None:
                    left = last[start - 1]
                    good = pair(left << 32 | token)
                    if good or good is None and self.goes_together(left, token):
                        last.append(token)
                        break
            else:
                raise ValueError("the vocabulary lacks a single byte")
        return last

    def tokens(self, last: list[int]) -> tuple[int, ...]:
        """The encoding that the prefix tokens spell, read from the end."""
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes_of[out[-1]])
        return tuple(reversed(out))

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        known = self._pieces.get(piece) or self._older.get(piece)
        if known is None:
            data = piece.encode()
            whole = self.ranks.get(data)
            known = (whole,) if whole is not None else self.tokens(self.extend(data, []))
            self.turn_over()
            self._pieces[piece] = known
        return known

    def turn_over(self) -> None:
        """Lets go the pieces not used since the last time, once the others are half of what is kept."""
        if len(self._pieces) >= KEPT_PIECES // 2:
            self._older, self._pieces = self._pieces, {}

    def learn(self, texts: list[list[str]]) -> dict[str, tuple[int, ...]]:
        """The encodings of all pieces of some texts; those that are not known yet are encoded.

        In sorted order each piece begins like the one before, whose prefix tokens hold for as far as the two agree.
        """
        self.turn_over()
        known, older, ranks = self._pieces, self._older, self.ranks
        absent = set().union(*texts).difference(known)
        met = absent.intersection(older)
        known.update(zip(met, map(older.__getitem__, met), strict=True))
        fresh = sorted((p.encode(), p) for p in absent.difference(met))
        before, last = b"", []
        for data, piece in fresh:
            whole = ranks.get(data)
            if whole is not None:
                known[piece] = (whole,)
                continue
            same = 0
            for x, y in zip(before, data):
                if x != y:
                    break
                same += 1
            del last[same:]
            known[piece] = self.tokens(self.extend(data, last))
            before = data
        return known

    def encode(self, pieces: Iterable[str]) -> list[int]:
        return list(chain.from_iterable(map(self.encode_piece, pieces)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class EncodedText:
    """A text with its pieces and tokens that stays exact under appends and edits, re-encoding only what they touch."""

    def __init__(self, encoder: PrefixEncoder, pattern: str, text: str = ""):
        self.encoder, self.pattern = encoder, regex.compile(pattern)
        self.text, self.pieces = "", []
        self.edit(0, 0, text)

    def append(self, more: str) -> int:
        return self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> int:
        """Puts ``new`` for text[start:end]; returns how many pieces were encoded anew.

        A piece depends on its own characters and at most two that follow it, so splitting starts again at the first
        piece that ends within one character of the change, and stops where a boundary of the old split returns.
        """
        at, first = 0, 0
        while first < len(self.pieces) and at + len(self.pieces[first]) < start - 1:
            at += len(self.pieces[first])
            first += 1
        shift = len(new) - (end - start)
        old, position = {}, 0
        for i, piece in enumerate(self.pieces):
            if position >= end:
                old[position + shift] = i
            position += len(piece)
        self.text = self.text[:start] + new + self.text[end:]
        fresh, place = [], at
        while place < len(self.text) and place not in old:
            match = self.pattern.match(self.text, place)
            fresh.append(match.group())
            place = match.end()
        rest = self.pieces[old[place]:] if place in old else []
        self.pieces = self.pieces[:first] + fresh + rest
        return len(fresh)

    def ids(self) -> list[int]:
        return self.encoder.encode(self.pieces)


_OUTPUTS = {
    "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "n_tokens": (T.LongType(), pa.int64()),
    "ids_sha256": (T.StringType(), pa.string()),
    "decoded": (T.BinaryType(), pa.binary()),
    "decoded_sha256": (T.StringType(), pa.string()),
}


def chunks_of(column: pa.Array, most: int = 1 << 20) -> Iterator[list[str]]:
    """The column's texts, null as empty, in lists of about ``most`` characters."""
    held, size = [], 0
    for value in column:
        text = value.as_py() or ""
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def encode(docs: DataFrame, rank_file: str, pattern: str, *, text: str = "text", keep: tuple[str, ...] | None = None, outputs: tuple[str, ...] = ("ids", "n_tokens")) -> DataFrame:
    """Adds the chosen ``outputs`` of every row's whole text; ``keep`` names the columns that stay (all by default).

    ids: the tokens; decoded: the bytes that the ids spell; the digests are of the decimal ids joined by a space and of
    the decoded bytes. An output replaces an input column of its name. No shuffle; the vocabulary is broadcast, whose
    size is that of the rank file and does not grow with the data.
    """
    spark = docs.sparkSession
    common.ship_package(spark)
    kept = [c for c in (keep if keep is not None else docs.columns) if c not in outputs]
    with open(rank_file, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    name = f"{rank_file}:{hashlib.md5(ranks.value).hexdigest()}"
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(o, _OUTPUTS[o][0]) for o in outputs])
    inputs = docs.select(*kept, docs[text].alias("__text"))
    n_kept, wanted = len(kept), tuple(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import bpe

        held = common.held_by("bpe")
        encoder = held.get(name)
        if encoder is None:
            encoder = held[name] = bpe.PrefixEncoder(bpe.read_ranks(ranks.value))
        spelled = {token: str(token) for token in encoder.bytes_of}
        split = regex.compile(pattern).findall
        for batch in batches:
            found: dict[str, list] = {o: [] for o in wanted}
            for texts in chunks_of(batch.column(n_kept)):
                pieces = [split(t) for t in texts]
                known = encoder.learn(pieces).__getitem__
                for own in pieces:
                    ids = list(chain.from_iterable(map(known, own)))
                    if "ids" in found:
                        found["ids"].append(ids)
                    if "n_tokens" in found:
                        found["n_tokens"].append(len(ids))
                    if "ids_sha256" in found:
                        found["ids_sha256"].append(hashlib.sha256(" ".join(map(spelled.__getitem__, ids)).encode()).hexdigest())
                    if "decoded" in found or "decoded_sha256" in found:
                        data = encoder.decode(ids)
                        if "decoded" in found:
                            found["decoded"].append(data)
                        if "decoded_sha256" in found:
                            found["decoded_sha256"].append(hashlib.sha256(data).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n_kept)] + [pa.array(found[o], _OUTPUTS[o][1]) for o in wanted],
                names=[*kept, *wanted],
            )

    return inputs.mapInArrow(run, schema)


def decode(rows: DataFrame, rank_file: str, *, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """Adds the bytes that each row's ids spell (null ids: no bytes)."""
    spark = rows.sparkSession
    with open(rank_file, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    kept = [c for c in rows.columns if c != output]
    place = kept.index(ids)
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(output, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: base64.b64decode(t) for t, rank in ((x.split()[0], int(x.split()[1])) for x in ranks.value.splitlines() if x)}
        for batch in batches:
            spelled = [b"".join(map(token.__getitem__, v.as_py() or ())) for v in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spelled, pa.binary())], names=[*kept, output])

    return rows.select(*kept).mapInArrow(run, schema)
