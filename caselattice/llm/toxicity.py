"""Toxicity by weak supervision.

Lexicon voters (word stems mined from labelled training rows, and a general list) and pattern voters give noisy votes.
A generative label model estimates each voter's accuracy from the votes alone, and how voters are correlated, and turns
the votes into posterior labels; a linear classifier is trained on these and scores every whole text.

What is fitted comes from at most ``max_labelled`` labelled training rows, in the order of a hash of their identifier; near
copies (similarity 0.8 or more of one label) among them teach once. All stems of these rows are tested, on the executors.
Null and empty texts get the score of a text without features. Repeated rows get equal scores. Without labelled rows
only the general list votes. Inputs of a score are the words of the text alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: General insults in four languages, as whole words.
GENERAL_LEXICON = (
    "idiot idiots moron morons stupid loser losers scum trash garbage worthless pathetic disgusting dumb imbecile bastard "
    "connard connasse salaud salope abruti débile crétin ordure "
    "arschloch dummkopf schwachkopf abschaum drecksau vollidiot "
    "imbécil estúpido estúpida cabrón pendejo basura asqueroso"
).split()

_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = range(3, 9)
#: Memory of a worker: words whose features are kept. Bounds memory only.
KEPT_WORDS = 400_000


def _is_training(doc_id: str, modulus: int, held: int):
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(modulus)) != held


def texts_in(column: pa.Array) -> Iterator[str | None]:
    """A column's texts one by one, so that a batch's texts aren't all copied at once."""
    return (value.as_py() for value in column)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def stems(word: str):
    """A word's features: itself with an end mark, and its prefixes."""
    yield word + "$"
    for n in PREFIXES:
        if n > len(word):
            break
        yield word[:n]


#: A stem's features: that one word has it, or two or three different words (marked at the end).
TIMES = {1: "", 2: "\x02", 3: "\x03"}


def features_of(words: set[str]) -> set[str]:
    """The features of a text's distinct words."""
    met = Counter(s for word in words for s in stems(word))
    return {s + mark for s, k in met.items() for times, mark in TIMES.items() if k >= times}


class Features:
    """Finds which of a bounded list of features a text has."""

    def __init__(self, names: list[str]):
        self.at: dict[str, int] = {}
        self.marks: list[list[tuple[int, int]]] = []  # of each stem: (different words needed, feature)
        for i, name in enumerate(names):
            stem = name.rstrip("\x02\x03")
            times = next(k for k, mark in TIMES.items() if name == stem + mark)
            if stem not in self.at:
                self.at[stem] = len(self.marks)
                self.marks.append([])
            self.marks[self.at[stem]].append((times, i))
        self._known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        known = self._known.get(word)
        if known is None:
            known = tuple(self.at[s] for s in stems(word) if s in self.at)
            if len(self._known) < KEPT_WORDS:
                self._known[word] = known
        return known

    def of_text(self, text: str | None) -> tuple[list[int], int, int]:
        """(distinct features, words that bear one, words)"""
        words = words_of(text)
        bearing: list[tuple[tuple[int, ...], int]] = []
        known, get = self._known, self.of_word
        for word, n in Counter(words).items():
            own = known.get(word)
            if own is None:
                own = get(word)
            if own:
                bearing.append((own, n))
        met = Counter(stem for own, _ in bearing for stem in own)
        found = {stem: [i for times, i in self.marks[stem] if k >= times] for stem, k in met.items()}
        hits = sum(n for own, n in bearing if any(found[stem] for stem in own))
        return sorted(i for own in found.values() for i in own), hits, len(words)


def _counts(rows: DataFrame) -> DataFrame:
    """(feature, n): rows that have each feature; summed per task, then over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import toxicity
        common.held_by("toxicity")

        total: Counter = Counter()

        def drain() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["feature", "n"])
            total.clear()
            return out

        for batch in batches:
            for text in texts_in(batch.column(0)):
                total.update(toxicity.features_of(set(toxicity.words_of(text))))
                if len(total) > 200_000:
                    yield drain()
        yield drain()

    return rows.mapInArrow(run, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


SKETCH = 64


def _apart(rows: DataFrame, *, alike: float = 0.8, rounds: int = 4) -> DataFrame:
    """Rows of the sample that are not near copies of others: a row goes if it shares a MinHash value of 5-word shingles
    with an earlier row of its label and ``alike`` of all values with the first such row.

    Otherwise a group of copies of one toxic text would make stems of its rare words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in common.text_chunks(batches, 0):
            hashes, offsets = common.shingle_hashes(*common.word_hashes(texts))
            full = np.diff(offsets) > 0
            sketch = np.zeros((len(texts), SKETCH), np.uint64)
            for k in range(SKETCH if len(hashes) else 0):
                sketch[full, k] = np.minimum.reduceat(common.mix(hashes ^ common._STEPS[k]), offsets[:-1][full])
            yield pa.RecordBatch.from_arrays([*part.columns[1:3], pa.array(list(sketch.view(np.int64)), pa.list_(pa.int64()))], names=["__row", "__y", "sketch"])

    keyed = rows.select("text", "__row", "__y").mapInArrow(run, f"__row long, __y {rows.schema['__y'].dataType.simpleString()}, sketch array<long>")
    for k in range(rounds):
        same = Window.partitionBy("__y", F.get("sketch", F.lit(k))).orderBy("__row")
        keyed = keyed.withColumn("__first", F.first(F.struct("__row", "sketch")).over(same))
        shared = F.size(F.filter(F.zip_with("sketch", "__first.sketch", lambda a, b: a == b), lambda x: x))
        keyed = keyed.where((F.col("__row") == F.col("__first.__row")) | (shared < alike * SKETCH)).drop("__first")
    return keyed.select("__row")


def _own_words(rows: DataFrame, size: int = 5) -> DataFrame:
    """(text) of each row without the runs of ``size`` words that an earlier row has: passages that rows share are no evidence
    but for the first, as what stands in one text is none for a word."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in common.text_chunks(batches, 0):
            hashes, offsets = common.shingle_hashes(*common.word_hashes(texts), size)
            counts = np.diff(offsets)
            place = np.arange(len(hashes)) - np.repeat(offsets[:-1], counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column(1).to_numpy(), counts)), pa.array(place, pa.int64()), pa.array(hashes.view(np.int64))], names=["__row", "place", "h"])

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, places in zip(texts_in(batch.column(0)), batch.column(1), strict=True):
                words = (text or "").encode().split()
                own = np.ones(len(words) + size, bool)
                for p in places.as_py() or ():
                    own[p : p + size] = False
                out.append(b" ".join(w for w, keep in zip(words, own, strict=False) if keep).decode())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["text"])

    pairs = common.stash(rows.select("text", "__row").mapInArrow(cut, "__row long, place long, h long"), "toxic-shingles")
    owned = pairs.groupBy("h").agg(F.min("__row").alias("__owner"), F.max("__row").alias("__last")).where("__owner < __last")
    shared = pairs.join(owned, "h").where("__row > __owner").groupBy("__row").agg(F.collect_list("place").alias("places"))
    return rows.join(shared, "__row", "left").select("text", "places").mapInArrow(drop, "text string")


def mine_stems(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int, *, most: int, precision: float = 0.8) -> list[tuple[str, int, int]]:
    """Stems that toxic training rows have far more often than clean ones: (stem, toxic rows, clean rows).

    A stem counts if ``precision`` of its rows are toxic, if its log likelihood ratio beats what chance would give among all stems that three rows have, and if a shorter one
    doesn't already say the same. Both tests are made where the stems are; what passes comes to the driver, and the ``most`` with the best ratios stay.
    """
    met = common.stash(_counts(toxic).where("n >= 3").select("feature", F.col("n").alias("t")), "toxic-stems")
    mark_of = F.regexp_extract("feature", "([\x02\x03]?)$", 1)
    # chance is that of the best among as many features of the same kind
    bars = {r[0]: 2 * math.log(r[1] + 1) + 2 for r in met.groupBy(mark_of.alias("mark")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not bars:
        return []
    share = n_toxic / max(n_toxic + n_clean, 1)
    mark = lambda name: name[len(name.rstrip("\x02\x03")) :]
    both = met.join(_counts(clean), "feature", "left").select("feature", "t", F.coalesce("n", F.lit(0)).alias("c"))
    p = F.col("t") / (F.col("t") + F.col("c"))
    gain = 2 * (F.col("t") * F.ln(p / share) + F.when(F.col("c") > 0, F.col("c") * F.ln((1 - p) / (1 - share))).otherwise(0.0))
    bar = F.element_at(F.create_map(*[F.lit(x) for item in bars.items() for x in item]), mark_of)
    passed = both.where((p >= max(share, precision)) & (p > share) & (gain >= bar))

    def ratio(t: int, c: int) -> float:
        p = t / (t + c)
        return 2 * (t * math.log(p / share) + (c * math.log((1 - p) / (1 - share)) if c else 0.0))

    fine: dict[str, tuple[int, int]] = {r[0]: (r[1], r[2]) for r in passed.collect()}

    def shorter(name: str) -> list[str]:
        stem = name.rstrip("\x02\x03")
        return [p for p in (stem.rstrip("$")[:n] + mark(name) for n in PREFIXES) if p != name and p in fine]

    # of stems that say the same the longest stays, and none that a more general one with equal precision covers
    covered = {p for name, (t, _) in fine.items() for p in shorter(name) if t >= 0.9 * fine[p][0]}
    kept = {name: v for name, v in fine.items() if name not in covered}
    kept = {name: (t, c) for name, (t, c) in kept.items() if not any(p in kept and kept[p][0] / sum(kept[p]) >= t / (t + c) - 0.01 for p in shorter(name))}
    best = sorted(kept, key=lambda s: (-ratio(*kept[s]), s))[:most]
    return [(s, *kept[s]) for s in best]


class LabelModel:
    """Accuracies of binary voters under a hidden label, by expectation maximisation; correlated voters share a weight."""

    def __init__(self, votes: np.ndarray, counts: np.ndarray, start: np.ndarray, rounds: int = 80):
        post, self.weight = start.astype(float), np.ones(votes.shape[1])
        for k in range(rounds):
            one, zero = counts * post, counts * (1 - post)
            self.prior = (one.sum() + 1) / (counts.sum() + 2)
            # a voter is presumed to be rare in either class, and rarer in the clean one
            self.on1 = (one @ votes + 0.5) / (one.sum() + 2)
            self.on0 = (zero @ votes + 0.02) / (zero.sum() + 2)
            if k % 10 == 9:
                self.weight = self._shares(votes, counts, post)
            post = self.posterior(votes)
        self.post = post

    def _shares(self, votes: np.ndarray, counts: np.ndarray, post: np.ndarray) -> np.ndarray:
        """1 / (1 + the correlations with other voters that the label doesn't explain)."""
        residual = votes - post[:, None] * self.on1 - (1 - post[:, None]) * self.on0
        cover = (residual * counts[:, None]).T @ residual / counts.sum()
        scale = np.sqrt(np.maximum(np.diag(cover), 1e-12))
        self.correlation = cover / scale[:, None] / scale
        strong = np.where(self.correlation > 0.1, self.correlation, 0)
        return 1 / np.maximum(strong.sum(axis=1), 1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes, no = np.log(self.on1 / self.on0), np.log((1 - self.on1) / (1 - self.on0))
        odds = np.log(self.prior / (1 - self.prior)) + votes @ (self.weight * yes) + (1 - votes) @ (self.weight * no)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


class Sparse:
    """Rows of sets of columns, and some dense columns behind them."""

    def __init__(self, sets: list[list[int]], width: int, dense: np.ndarray):
        self.row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        self.column = np.array([c for s in sets for c in s], np.int64)
        self.shape, self.dense = (len(sets), width + dense.shape[1]), dense
        self.width = width

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.shape[0]) + self.dense @ w[self.width :]

    def transposed_times(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.column, r[self.row], self.width), self.dense.T @ r])

    def square_sums(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.shape[0]) + (self.dense**2).sum(axis=1)

    def first_columns(self, n: int) -> np.ndarray:
        out, few = np.zeros((self.shape[0], n)), self.column < n
        out[self.row[few], self.column[few]] = 1
        return out


def fit_linear(x: Sparse, target: np.ndarray, counts: np.ndarray, *, ridge: float = 0.3, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated gradient steps; the last dense column is the intercept's."""
    share = counts / counts.sum()
    bound = 0.25 * float((share * x.square_sums()).sum()) + 1e-3
    penalty = np.full(x.shape[1], ridge / counts.sum())
    penalty[-1] = 0
    w, ahead, t = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x.times(ahead), -30, 30)))
        step = ahead - (x.transposed_times(share * (p - target)) + penalty * ahead) / bound
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = step + (t - 1) / after * (step - w), step, after
    return w[:-1], float(w[-1])


def _numbers(hits: int, distinct: int, words: int) -> list[float]:
    return [float(hits > 0), float(distinct >= 2), min(math.log1p(hits), 4.0), min(50.0 * hits / max(words, 1), 2.0)]


class Model:
    """Stems, their weights and the intercept; what is broadcast is bounded by the number of stems."""

    def __init__(self, names: list[str], weights: np.ndarray, bias: float):
        self.names, self.weights, self.bias = names, weights, bias

    def score(self, features: Features, text: str | None) -> float:
        found, hits, words = features.of_text(text)
        z = self.bias
        if found:
            z += float(self.weights[found].sum()) + float(np.dot(self.weights[len(self.names) :], _numbers(hits, len(found), words)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", modulus: int = 4, held: int = 2, max_labelled: int = 40_000, max_stems: int = 2000, max_voters: int = 200) -> Model:
    """Learns from labelled rows whose crc32 of the identifier, modulo ``modulus``, is not ``held``.

    ``max_stems`` bounds what is broadcast for scoring, and ``max_voters`` the label model's matrix: the general lexicon and
    the mined stems with the best ratios vote by themselves, all other stems through the patterns that count them.
    """
    spark = docs.sparkSession
    common.ship_package(spark)
    usable = labels.where(_is_training(doc_id, modulus, held) & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).alias("__y"))
    chosen = common.stash(usable.orderBy(F.xxhash64("__id"), "__id").limit(max_labelled), "toxic-sample")
    # the sample's identifiers are bounded by max_labelled; a document that is there twice teaches twice
    rows = common.stash(docs.join(F.broadcast(chosen), F.col(doc_id) == F.col("__id")).select(F.col(text).alias("text"), "__y", F.monotonically_increasing_id().alias("__row")), "toxic-training")
    rows = common.stash(rows.join(_apart(rows), "__row", "left_semi"), "toxic-apart")
    toxic, clean = rows.where("__y = 1"), rows.where("__y <> 1").select("text")
    n_toxic, n_clean = toxic.count(), clean.count()
    mined = mine_stems(_own_words(toxic), clean, n_toxic, n_clean, most=max_stems) if n_toxic else []
    general = [w + "$" for w in GENERAL_LEXICON]
    names = general + [m[0] for m in mined if m[0] not in general]
    shared = spark.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import toxicity
        common.held_by("toxicity")

        features = toxicity.Features(shared.value)
        for batch in batches:
            found = [features.of_text(t) for t in texts_in(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())], names=["found", "hits", "words"])

    sample = rows.select("text").mapInArrow(run, "found array<int>, hits long, words long").collect()
    if not sample:
        sample = [([], 0, 0)]
    # rows without a feature are alike and count as one
    with_some = [(list(r[0]), r[1], r[2]) for r in sample if r[0]]
    counts = np.array([1.0] * len(with_some) + [max(len(sample) - len(with_some), 1)])
    numbers = np.zeros((len(counts), 5))
    numbers[:, 4] = 1
    for i, (found, hits, words) in enumerate(with_some):
        numbers[i, :4] = _numbers(hits, len(found), words)
    table = Sparse([*(f for f, _, _ in with_some), []], len(names), numbers)
    # voters: the general lexicon and the best stems, and patterns over all of them
    lexicon = table.first_columns(min(max_voters, len(names)))
    hits = np.array([r[1] for r in with_some] + [0])
    words = np.array([r[2] for r in with_some] + [1])
    distinct = np.array([len(r[0]) for r in with_some] + [0])
    patterns = np.stack([hits >= 1, distinct >= 2, hits >= 3, hits * 200 >= np.maximum(words, 1), hits * 50 >= np.maximum(words, 1)], axis=1).astype(float)
    model = LabelModel(np.hstack([lexicon, patterns]), counts, np.where(hits > 0, 0.9, 0.01))
    weights, bias = fit_linear(table, model.post, counts)
    return Model(names, weights, bias)


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: tuple[str, ...] | None = None, output: str = "score") -> DataFrame:
    """Adds the classifier's probability of toxicity of each whole text, without a shuffle."""
    spark = docs.sparkSession
    common.ship_package(spark)
    kept = [c for c in (keep if keep is not None else docs.columns) if c != output]
    shared = spark.sparkContext.broadcast((model.names, model.weights, model.bias))
    inputs = docs.select(*kept, F.col(text).alias("__text"))
    schema = inputs.drop("__text").schema.add(output, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import toxicity
        common.held_by("toxicity")

        own = toxicity.Model(*shared.value)
        features = toxicity.Features(own.names)
        for batch in batches:
            scores = [own.score(features, t) for t in texts_in(batch.column(len(kept)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), pa.array(scores, pa.float64())], names=[*kept, output])

    return inputs.mapInArrow(run, schema)
