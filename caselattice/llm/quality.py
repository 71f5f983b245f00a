"""Quality rules with adaptive thresholds: mergeable quantile sketches per language and source, then a joined filter.

DataFrame functions only. Words are runs of ``[^\\x20\\x09-\\x0D]``. Null or empty texts have no words and fail the
base rule; a null language or source counts as the group of the empty string. Equal rows get equal verdicts. Extra
input columns are left out unless named in ``keep``. Sketches are counts by logarithmic buckets: they merge by sums, are
within half a per cent of the value at every quantile, and give the same fences in every run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

_SPACES = " \t\n\x0b\f\r"
#: Ratios with an upper fence: what is counted, of how many, and how much of the former one event adds. A repeated window
#: makes 16 repeated words: its own and those of the first one.
RATIOS = {
    "symbol_ratio": ("n_symbols", "n_words", 1),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 1),
    "repeat_ratio": ("n_repeat_words", "n_words", 16),
    "echo_ratio": ("n_echoes", "n_words", 1),
    "upper_ratio": ("n_upper", "word_chars", 1),
    "mark_ratio": ("n_marks", "n_words", 1),
}
#: The one measure with fences on both sides.
MEAN = "mean_word_chars"
MEASURES = (*RATIOS, MEAN)
#: Growth of the sketches' buckets, and the bucket of zeros.
GROWTH, ZEROS = 1.01, -(1 << 20)
#: A quartile's distance from the median, as that of a tenth percentile in a normal distribution.
_QUARTILE = 1.9


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often a lambda reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_measures(docs: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source"), window: int = 8) -> DataFrame:
    """Word, symbol and repetition counts of every whole text, without a shuffle.

    n_words; word_chars: code points in words; n_symbols: characters of ``#*$%&|<>``; n_lines: lines with a word;
    n_dup_lines: of these, equal to an earlier one; n_repeat_words: words in ``window``-word windows that the text has
    twice or more, the first included; n_upper: upper-case letters; n_marks: ``!`` and ``?``; n_echoes: words equal to the word before.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(whole, F.lit(_SPACES))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(_SPACES)) != "")
    counted = docs.select(
        *keep,
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, common.SPACE_CLASS)).alias("__words"),
        F.length(F.translate(whole, _SPACES, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.alias("__lines"),
        (F.length(whole) - F.length(F.regexp_replace(whole, r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        (F.length(whole) - F.length(F.translate(whole, "!?", ""))).cast("long").alias("n_marks"),
    )
    words = F.col("__words")
    windowed = counted.select(
        *keep,
        F.size(words).cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        "n_upper",
        "n_marks",
        F.size(F.filter(words, lambda w, i: F.coalesce(w == F.get(words, i - 1), F.lit(False)))).cast("long").alias("n_echoes"),
        F.when(
            F.size(words) >= window,
            F.transform(F.sequence(F.lit(0), F.size(words) - window), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)])),
        ).alias("__windows"),
    )
    found = F.col("__windows")

    def covered(pairs: Column) -> Column:
        """Words under the windows that occur again, from (hash, place) in the order of the hashes."""
        again = F.filter(
            F.sequence(F.lit(0), F.size(pairs) - 1),
            lambda k: F.coalesce(F.get(pairs, k)["h"] == F.get(pairs, k - 1)["h"], F.lit(False)) | F.coalesce(F.get(pairs, k)["h"] == F.get(pairs, k + 1)["h"], F.lit(False)),
        )
        places = F.sort_array(F.transform(again, lambda k: F.get(pairs, k)["i"]))
        # each window adds what it does not share with the one before
        return _let(places, lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(window), x - F.get(p, k - 1))), F.lit(0), lambda total, x: total + x))

    repeated = F.when(found.isNull() | (F.size(found) == F.size(F.array_distinct(found))), F.lit(0)).otherwise(
        _let(F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)
    )
    return windowed.select(*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", repeated.cast("long").alias("n_repeat_words"), "n_upper", "n_marks", "n_echoes")


def _ratios(counts: DataFrame) -> DataFrame:
    of = lambda c: F.greatest(F.col(c), F.lit(1))
    return counts.withColumns({m: F.col(c) / of(n) for m, (c, n, _) in RATIOS.items()} | {MEAN: F.col("word_chars") / of("n_words")})


def sketches(measures: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the sketch of each measure in each group, summed before its shuffle."""
    bucket = lambda m: F.when(F.col(m) > 0, F.ceil(F.ln(m) / math.log(GROWTH)).cast("int")).otherwise(F.lit(ZEROS))
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(m).alias("bucket")) for m in MEASURES]))
    return measures.select("lang", "source", cells.alias("cell")).groupBy("lang", "source", "cell.measure", "cell.bucket").agg(F.count(F.lit(1)).alias("n"))


def quantiles(cells: DataFrame, keys: list[str], prefix: str, at: tuple[int, ...] = (10, 50, 75)) -> DataFrame:
    """(keys, measure, n, one column a percentile) of sketches merged to ``keys``. A window holds the buckets of one sketch."""
    merged = cells.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys, "measure")
    ranked = merged.withColumn("below", F.sum("n").over(whole.orderBy("bucket"))).withColumn("all", F.sum("n").over(whole))
    value = F.when(F.col("bucket") == ZEROS, 0.0).otherwise(F.pow(F.lit(GROWTH), F.col("bucket")))
    found = [F.min(F.when(100 * F.col("below") >= q * F.col("all"), value)).alias(f"{prefix}q{k}") for k, q in enumerate(at)]
    return ranked.groupBy(*keys, "measure").agg(F.max("all").alias(f"{prefix}n"), *found)


def thresholds(measures: DataFrame, *, prior_rows: float = 100.0, spread: float = 6.0) -> DataFrame:
    """(lang, source, hi_* of every measure, lo_* of the mean): fences ``spread`` widths of the group from its median.

    One sketch per measure and group, merged upward to the language and to all rows. A group's quantiles are drawn to
    those of its language, and these to those of all, as if ``prior_rows`` rows had them, so a small group has nearly
    its parent's fences and a large one its own. The width is the larger one of median less tenth percentile and of 1.9
    times upper quartile less median (equal in a normal distribution): up to a quarter of a group may be junk without
    moving its fences. No fence has a fixed part. Without rows there are no fences.
    """
    cells = common.stash(sketches(measures), "quality-sketches")
    own, lang, top = quantiles(cells, ["lang", "source"], "g_"), quantiles(cells, ["lang"], "l_"), quantiles(cells, [], "a_")
    joined = own.join(lang, ["lang", "measure"]).join(top, "measure")
    drawn = lambda n, near, far: (F.col(n) * near + prior_rows * far) / (F.col(n) + prior_rows)
    low, mid, high = (drawn("g_n", F.col(f"g_q{k}"), drawn("l_n", F.col(f"l_q{k}"), F.col(f"a_q{k}"))) for k in range(3))
    width = spread * F.greatest(mid - low, _QUARTILE * (high - mid))
    fenced = joined.select("lang", "source", "measure", (mid + width).alias("hi"), (mid - width).alias("lo"))
    of = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{c}_{m}")
    return fenced.groupBy("lang", "source").agg(*[of(m, "hi") for m in MEASURES], of(MEAN, "lo"))


def quality_filter(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", min_words: int = 20, repeat_percent: int = 30, prior_rows: float = 100.0, spread: float = 6.0, errors: float = 3.0) -> DataFrame:
    """Verdict per document: the counts, ``base_failed``, the rules that failed, and ``kept``.

    base_failed: fewer than ``min_words`` words, or over ``repeat_percent`` % of them in repeated windows. Rows that
    pass it give the sketches; kept is false for base failures and outside the group's fences. A count strays by
    chance, the more so in a short text: a ratio fails if it is more than ``errors`` standard errors above its fence,
    the error of a count being its square root, and of a mean length that of words whose lengths vary by half their
    mean. An empty table, or one where every row fails the base rule, gives no fences and is a defined result.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), F.col(text).alias("text"))
    counts = common.stash(text_measures(named), "quality-counts")
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    measured = _ratios(counts).withColumn("base_failed", base)
    limits = common.stash(thresholds(measured.where(~F.col("base_failed")), prior_rows=prior_rows, spread=spread), "quality-limits")
    judged = measured.join(limits, ["lang", "source"], "left")
    rules = [F.when(F.col(m) - errors * F.sqrt(F.col(c) * unit) / F.greatest(F.col(n), F.lit(1)) > F.col(f"hi_{m}"), F.lit(f"high_{m}")) for m, (c, n, unit) in RATIOS.items()]
    strays = errors * F.col(MEAN) / (2 * F.sqrt(F.greatest("n_words", F.lit(1))))
    rules += [F.when(F.col(MEAN) - strays > F.col(f"hi_{MEAN}"), F.lit(f"high_{MEAN}")), F.when(F.col(MEAN) + strays < F.col(f"lo_{MEAN}"), F.lit(f"low_{MEAN}"))]
    judged = judged.withColumn("failed_rules", F.array_compact(F.array(*rules)))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"),
        "failed_rules", "lang", "source", *MEASURES,
    )
