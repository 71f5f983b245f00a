"""Browsing evaluation results: paired samples, searches, sorts, pages, device checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselattice.functions import text as tx

#: Sample orders by name; an unknown name takes the first.
SORTS = {"delta_desc": "-delta", "delta_asc": "delta", "lora_desc": "-other_score", "base_desc": "-base_score", "id": "id"}


def paired_samples(base: DataFrame, other: DataFrame, score: str = "score") -> DataFrame:
    """Samples that both variants have, in the base's order, the last of repeated ids counting."""
    last = lambda df: df.groupBy(F.col("id").cast("string").alias("id")).agg(F.min("ordinal").alias("ordinal"), F.max_by("source", "ordinal").alias("source"), F.max_by(score, "ordinal").alias("s"))
    met = last(base).join(last(other).select("id", F.col("s").alias("other_score")), "id").withColumnRenamed("s", "base_score")
    return met.withColumns({"best_score": F.greatest("base_score", "other_score"), "delta": F.col("other_score") - F.col("base_score")})


def search(samples: DataFrame, words: str) -> DataFrame:
    low = words.strip().lower()
    return samples.where(F.lower(tx.text_of("id")).contains(low) | F.lower(tx.text_of("source")).contains(low)) if low else samples


def page(samples: DataFrame, sort: str, number: int, size: int) -> DataFrame:
    """Page ``number`` from 0 with 1 to 1000 rows: the page is the feature. Rows carry their ``place`` in the whole order,
    from 1; a page's rows are numbered in one task."""
    number, size = max(0, number), min(1000, max(1, size))
    by = SORTS.get(sort, SORTS["delta_desc"])
    order = [F.desc(by[1:]) if by.startswith("-") else F.asc(by), F.asc("id")]
    shown = samples.orderBy(*order).offset(number * size).limit(size)
    return shown.withColumn("place", F.row_number().over(Window.orderBy(*order)) + number * size)


def page_with_total(samples: DataFrame, sort: str, number: int, size: int) -> tuple[DataFrame, DataFrame]:
    """(page, one row with the total before it was cut and the number of pages)"""
    size_ = min(1000, max(1, size))
    return page(samples, sort, number, size), samples.agg(F.count(F.lit(1)).alias("total"), F.ceil(F.count(F.lit(1)) / size_).alias("pages"))


def device_rollup(rows: DataFrame, by: str, has_code: Column, found: Column) -> DataFrame:
    """Per sample: rows, rows checked, found and not found; the latter two null where there is no corpus."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("total"), F.count_if(has_code).alias("checked"), F.sum(F.when(has_code, found.cast("int"))).alias("n_found"), F.sum(F.when(has_code, (~found).cast("int"))).alias("n_not_found"))


def metric_view(record: Column, names: tuple[str, ...]) -> list[Column]:
    """Scores out of a JSON record, 0 where missing or no number."""
    return [F.coalesce(F.get_json_object(record, f"$.{n}.avg").try_cast("double"), F.get_json_object(record, f"$.{n}").try_cast("double"), F.lit(0.0)).alias(n) for n in names]


def field_names(*maps: Column) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.array(*[F.map_keys(F.coalesce(m, F.create_map().cast("map<string,double>"))) for m in maps]))))


def prompt_mode(c, default: str = "compressed") -> Column:
    low = F.lower(tx.strip(c))
    named = lambda mode: (low == mode) | low.endswith(f"+{mode}")
    return F.when(named("full"), "full").when(named("compressed"), "compressed").otherwise(default)


def long_enough(c, least: int = 20) -> Column:
    return F.char_length(tx.strip(c)) >= least


def best_directory(found: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Of complete result folders (path, num_samples, modified) that with most samples, then the latest."""
    return found.groupBy(*by).agg(F.max_by("path", F.struct("num_samples", "modified", "path")).alias("path"))


def discover(spark: SparkSession, root: str, override: str | None = None) -> tuple[str, str]:
    """(folder, layout) to read results from: ``override`` if given; else of the folders below ``root`` that hold two variants
    the one with most samples, then the latest; else the first that holds an older batch; else ``root`` itself."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path_of = jvm.org.apache.hadoop.fs.Path
    fs = path_of(root).getFileSystem(conf)

    def names(folder: str) -> set[str]:
        at = path_of(folder)
        return {s.getPath().getName() for s in fs.listStatus(at) if s.isFile()} if fs.exists(at) else set()

    if override:
        return override, layout(names(override))
    below = sorted(s.getPath().toString() for s in fs.listStatus(path_of(root)) if s.isDirectory()) if fs.exists(path_of(root)) else []
    kinds = {folder: layout(names(folder)) for folder in [*below, root]}
    complete = []
    for folder in (f for f, k in kinds.items() if k == "paired"):
        summary = path_of(f"{folder}/{SUMMARY_FILE}")
        said = spark.read.text(summary.toString(), wholetext=True).select(F.get_json_object("value", "$.num_samples").try_cast("long")).first()[0]
        complete.append((said or 0, fs.getFileStatus(summary).getModificationTime(), folder))
    chosen = max(complete)[2] if complete else next((f for f, k in kinds.items() if k == "legacy"), root)
    return chosen, kinds[chosen]


def columns_in_order(tables: DataFrame, canonical: list[str], by: str = "id", rows: str = "rows") -> DataFrame:
    """(column, place): the canonical columns, then others as they were first met; hidden ones begin with _."""
    met = tables.select(by, F.posexplode(rows).alias("i", "row")).select(by, "i", F.posexplode(F.map_keys("row")).alias("j", "name"))
    new = met.where(~F.col("name").isin(*canonical) & ~F.col("name").startswith("_")).groupBy("name").agg(F.min(F.struct(by, "i", "j")).alias("first"))
    # one row a column name: the names are those of a table's header
    later = new.select("name", (F.row_number().over(Window.orderBy("first")) + len(canonical)).alias("place"))
    own = tables.sparkSession.createDataFrame(list(zip(canonical, range(1, len(canonical) + 1), strict=True)), "name string, place int")
    return own.unionByName(later)


def row_style(modified: Column, level: Column, index: Column) -> Column:
    return F.when(modified, 8).when(level == "执行步骤", 7).when(index % 2 == 0, 5).otherwise(6)


#: The files of a results folder with two variants, and of an older one.
SUMMARY_FILE = "vllm_compare_summary.json"
PAIRED_FILES = {SUMMARY_FILE, "base_predictions.jsonl", "lora_predictions.jsonl"}
OLDER_FILE = "did_batch_summary.json"


def layout(names: set[str]) -> str:
    """What a results folder holds: two variants' predictions, an older batch, or nothing of use."""
    return "paired" if PAIRED_FILES <= names else "legacy" if OLDER_FILE in names else "missing"


def export_request_errors(n_rows: Column, n_final: Column, indexes: Column, most: int = 1000) -> Column:
    """What is wrong with a request to export a table with edits at some rows."""
    checks = [
        ((n_rows < 1) | (n_rows > most), "row_count"),
        (n_rows != n_final, "tables_differ_in_rows"),
        (F.exists(indexes, lambda i: i.isNull() | (i < 0) | (i >= n_rows)), "index_out_of_range"),
        (F.size(F.array_distinct(indexes)) != F.size(indexes), "index_repeated"),
    ]
    return F.array_compact(F.array(*[F.when(bad, name) for bad, name in checks]))
