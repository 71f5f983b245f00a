"""Cross-site boilerplate lines by distinct-site spread.

A line's sites are counted by a HyperLogLog sketch per line hash, merged by aggregation; lines whose estimate lies near
the threshold get an exact distinct count. Lines are trimmed of ASCII white space; lines of fewer than ``min_words``
words never count, as such lines meet by chance. A null site is the site of the empty string, a null text has no lines;
repeated rows and ties need no rule, since spread is a set size, and rows are told apart by identifier and text, so that
identifiers may be null or repeated. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

_SPACES = " \t\n\x0b\f\r"


def _bare(line):
    return F.btrim(line, F.lit(_SPACES))


def line_table(docs: DataFrame, *, key, text: str, site: str, min_words: int) -> DataFrame:
    """(key, site, line hash) of every line that counts, of whole texts."""
    lines = F.explode(F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), _bare), lambda line: line != ""))
    named = docs.select(key.alias("key"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"), lines.alias("line"))
    return named.where(F.size(F.split("line", common.SPACE_CLASS)) >= min_words).select("key", "site", F.xxhash64("line").alias("h"))


def spread_lines(lines: DataFrame, *, min_sites: int, log2_registers: int = 10, sigmas: float = 4.0) -> DataFrame:
    """Hashes of the lines on ``min_sites`` or more sites.

    The sketch's standard error is 1.04 / sqrt(registers); estimates within ``sigmas`` of those (and one site) of the
    threshold are settled exactly. Both ways are summed before their shuffles, so a line on all pages is no hot key.
    """
    width = sigmas * 1.04 / math.sqrt(2**log2_registers)
    low, high = min_sites * (1 - width) - 1, min_sites * (1 + width) + 1
    # the sketch also takes the place of a distinct(), so no (line, site) pairs are shuffled for the many rare lines
    estimates = lines.groupBy("h").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log2_registers))).alias("sites")).where(F.col("sites") >= low)
    estimates = common.stash(estimates, "line-estimates")
    near = estimates.where(F.col("sites") <= high).select("h")
    exact = lines.join(near, "h", "left_semi").select("h", "site").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("sites"))
    return estimates.where(F.col("sites") > high).select("h").union(exact.where(F.col("sites") >= min_sites).select("h"))


def remove_boilerplate(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = 10, min_words: int = 3, copy_percent: int | None = None) -> DataFrame:
    """The rows of ``docs`` without their boilerplate lines; adds n_spread, n_removed and is_copy.

    With ``copy_percent``, a document with more than that share of its words in spread lines is taken for a copied one: it
    keeps its text (is_copy), for a near-duplicate join to settle. Without it such lines go from every document. Row and
    column order of other columns stay; columns named like the added ones are replaced.
    """
    added = ("n_spread", "n_removed", "is_copy")
    key = F.xxhash64(doc_id, text)
    lines = common.stash(line_table(docs, key=key, text=text, site=site, min_words=min_words), "line-table")
    spread = common.stash(spread_lines(lines, min_sites=min_sites), "line-spread")
    hits = lines.join(spread, "h").groupBy(F.col("key").alias("__key")).agg(F.collect_set("h").alias("__hashes"))
    kept = [c for c in docs.columns if c not in added]
    joined = docs.select(*kept).withColumn("__own", key).join(hits, F.col("__own") == F.col("__key"), "left")
    parts = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda line: F.struct(line.alias("line"), F.array_contains("__hashes", F.xxhash64(_bare(line))).alias("spread"), F.when(_bare(line) == "", 0).otherwise(F.size(F.split(_bare(line), common.SPACE_CLASS))).alias("words")),
    )
    parted = joined.withColumn("__parts", F.when(F.col("__hashes").isNotNull(), parts))
    hit = F.filter("__parts", lambda p: p["spread"] & (p["words"] >= min_words))
    measured = parted.select(
        *kept,
        "__parts",
        F.coalesce(F.size(hit), F.lit(0)).cast("long").alias("n_spread"),
        F.aggregate(hit, F.lit(0), lambda total, p: total + p["words"]).alias("__hit_words"),
        F.aggregate("__parts", F.lit(0), lambda total, p: total + p["words"]).alias("__all_words"),
    ).withColumn("is_copy", F.lit(False) if copy_percent is None else F.coalesce(100 * F.col("__hit_words") > copy_percent * F.col("__all_words"), F.lit(False)))
    changes = (F.col("n_spread") > 0) & ~F.col("is_copy") & F.col("__parts").isNotNull()
    cleaned = F.array_join(F.transform(F.filter("__parts", lambda p: ~(p["spread"] & (p["words"] >= min_words))), lambda p: p["line"]), "\n")
    return measured.select(
        *[F.when(changes, cleaned).otherwise(F.col(c)).alias(c) if c == text else F.col(c) for c in kept],
        F.greatest("n_spread", F.lit(0)).alias("n_spread"),
        F.when(changes, F.col("n_spread")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        "is_copy",
    )
