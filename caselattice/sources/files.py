"""Readers of case files: strict and lenient JSON lines, sniffed CSV, workbooks, XML records, images."""

from __future__ import annotations

import csv
import io
import itertools
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselattice.functions import text as tx


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number, value) of every line. Files are read in splits of any number: a line's number is its place in
    its split and the lines counted in the splits before, so no task holds a file."""
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    read = spark.read.option("lineSep", "\n").text(path).select(*split, F.monotonically_increasing_id().alias("place"), "value")
    blocks = read.groupBy("file", "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    number = F.col("before") + F.col("place") - F.col("first") + 1
    bare = F.regexp_replace("value", r"\r+\z", "")
    return read.join(starts, ["file", "block"]).select("file", number.alias("line_number"), F.when(number == 1, F.regexp_replace(bare, "^\ufeff", "")).otherwise(bare).alias("value"))


def strict_json_lines(spark: SparkSession, path: str, schema: T.StructType, key: str = "id") -> DataFrame:
    """Objects of a file; a bad line, a value that is no object, or a missing or repeated key fails with its place."""
    lines = json_lines(spark, path).where(F.trim("value") != "")
    parsed = lines.withColumns({"v": F.try_parse_json("value"), "row": F.from_json("value", schema)})
    place = F.concat("file", F.lit(":"), F.col("line_number").cast("string"))
    fail = lambda what: F.raise_error(F.concat(place, F.lit(f": {what}"))).cast("boolean")
    same = Window.partitionBy("row." + key).orderBy("file", "line_number").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    again = F.count(F.lit(1)).over(same) > 1
    checked = parsed.withColumn(
        "ok",
        F.when(F.col("v").isNull(), fail("not JSON")).when(~F.schema_of_variant("v").startswith("OBJECT"), fail("not an object"))
        .when(F.col(f"row.{key}").isNull(), fail(f"no {key}")).when(again, fail(f"repeated {key}")).otherwise(True),
    )
    return checked.where("ok").select("line_number", "row.*")


def lenient_json_lines(spark: SparkSession, path: str, schema: T.StructType, key: str | None = None) -> DataFrame:
    """Objects of a file, bad lines left out; with ``key`` the last object of a key at the place of its first."""
    lines = json_lines(spark, path).where(F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False)))
    rows = lines.select("line_number", F.from_json("value", schema).alias("row")).select("line_number", "row.*")
    if key is None:
        return rows
    from caselattice.operators.prep import last_wins

    return last_wins(rows.where(F.col(key).isNotNull()), key, "line_number")


ENCODINGS = ("utf-8-sig", "utf-8", "gb18030")


def sniff(head: bytes) -> tuple[str, str]:
    """(encoding, delimiter) from a file's first bytes."""
    for encoding in ENCODINGS:
        try:
            text = head.decode(encoding) if len(head) < 1 << 16 else io.TextIOWrapper(io.BytesIO(head[:-4]), encoding).read()
            break
        except UnicodeDecodeError:
            continue
    else:
        raise ValueError("no known encoding")
    if encoding == "utf-8-sig" and not head.startswith(b"\xef\xbb\xbf"):
        encoding = "utf-8"
    try:
        return encoding, csv.Sniffer().sniff(text, ",\t;").delimiter
    except csv.Error:
        return encoding, ","


def file_head(spark: SparkSession, path: str, size: int = 1 << 16) -> bytes:
    """The first bytes of a file of any store that Hadoop knows, or of the first file of a folder."""
    conf, at = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    if fs.getFileStatus(at).isDirectory():
        at = min((s.getPath() for s in fs.listStatus(at) if s.isFile() and not s.getPath().getName().startswith(("_", "."))), key=lambda p: p.getName())
    stream = fs.open(at)
    try:
        return bytes(stream.readNBytes(size))
    finally:
        stream.close()


def csv_names(head: bytes, encoding: str, delimiter: str) -> list[str]:
    return [h.strip().lstrip("\ufeff") for h in next(csv.reader(io.StringIO(head.decode(encoding, "ignore")), delimiter=delimiter), [])]


def csv_cells(contents: DataFrame, encoding: str, delimiter: str, most: int = 10_000) -> DataFrame:
    """(row_number, cells) of CSV files given as (path, content), given out ``most`` rows at a time; a file is one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                lines = io.TextIOWrapper(io.BytesIO(content.as_py().replace(b"\0", b"")), encoding, newline="")
                rows = csv.reader(lines, delimiter=delimiter)
                names = [h.strip().lstrip("\ufeff") for h in next(rows, [])]
                numbered = ((i, list(dict(zip(names, r, strict=False)).items())) for i, r in enumerate(rows, 2) if any(x.strip() for x in r))
                while some := list(itertools.islice(numbered, most)):
                    yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in some], pa.int64()), pa.array([r for _, r in some], pa.map_(pa.string(), pa.string()))], names=["row_number", "cells"])

    return contents.select("path", "content").mapInArrow(run, "row_number long, cells map<string,string>")


def sniffed_csv(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> tuple[DataFrame, str, str]:
    """(rows, encoding, delimiter): all columns text, clean headers, blank rows left out, row_number from 2.

    Quoted cells may hold line breaks. The first 64 KiB decide encoding and delimiter, and only these are read for it.
    """
    head = file_head(spark, path)
    encoding, delimiter = sniff(head)
    names = csv_names(head, encoding, delimiter)
    if lacking := sorted(set(required) - set(names)):
        raise ValueError(f"{path}: headers are missing: {lacking}")
    rows = csv_cells(spark.read.format("binaryFile").load(path), encoding, delimiter)
    return rows.select("row_number", *[F.element_at("cells", F.lit(n)).alias(n) for n in dict.fromkeys(names)]), encoding, delimiter


def source_facts(spark: SparkSession, path: str) -> dict:
    """What a report says of an input file: path, encoding, delimiter, bytes, SHA-256."""
    encoding, delimiter = sniff(file_head(spark, path))
    known = file_hashes(spark, path).first()
    return {"path": path, "encoding": encoding, "delimiter": delimiter, "bytes": known["bytes"], "sha256": known["sha256"]}


#: Names of the id and instruction columns, in the order of preference; image suffixes.
QUERY_COLUMNS = ("ao_instruction", "instruction", "query", "question", "AO指令", "指令")
ID_COLUMNS = ("ao_id", "id", "q_id", "case_id", "AO编号", "编号")
IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "webp", "bmp")


def choose_column(columns: list[str], wanted: str | None, candidates: tuple[str, ...]) -> str:
    found = [wanted] if wanted else [c for c in candidates if c in columns]
    if not found or found[0] not in columns:
        raise ValueError(f"no such column among {columns}")
    return found[0]


def query_csv(spark: SparkSession, path: str, query: str | None = None, key: str | None = None) -> DataFrame:
    """(ao_id, instruction) of a batch of queries; a blank id is the row's number, rows without instruction go."""
    rows, _, _ = sniffed_csv(spark, path)
    said = choose_column(rows.columns, query, QUERY_COLUMNS)
    named = [c for c in ([key] if key else ID_COLUMNS) if c in rows.columns]
    number = (F.col("row_number") - 1).cast("string")
    own = F.coalesce(F.nullif(tx.strip(named[0]), F.lit("")), number) if named else number
    return rows.select(own.alias("ao_id"), tx.strip(said).alias("instruction")).where("instruction <> ''")


_TAG = re.compile(r"^\{[^}]*\}")


def _sheet_rows(content: bytes, skip: int) -> list[list[str | None]]:
    """Rows of a workbook's first sheet as text, by column; a string's first run stands for it."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = []
        if "xl/sharedStrings.xml" in book.namelist():
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iterfind(".//{*}si"):
                first = item.find(".//{*}t")
                strings.append(first.text or "" if first is not None else "")
        rows = []
        for number, row in enumerate(ElementTree.fromstring(book.read("xl/worksheets/sheet1.xml")).iterfind(".//{*}row")):
            if number < skip:
                continue
            cells: dict[int, str | None] = {}
            for cell in row.iterfind(".//{*}c"):
                letters = "".join(x for x in cell.get("r", "") if x.isalpha()).upper()
                at = sum((ord(x) - 64) * 26**k for k, x in enumerate(reversed(letters))) - 1 if letters else max(cells, default=-1) + 1
                value = cell.find(".//{*}v")
                text = value.text if value is not None else None
                cells[at] = strings[int(text)] if text is not None and cell.get("t") == "s" else text
            rows.append([cells.get(k) for k in range(max(cells, default=-1) + 1)])
        return rows


def workbook_rows(spark: SparkSession, path: str, skip: int = 1) -> DataFrame:
    return sheet_rows(spark.read.format("binaryFile").load(path), skip)


def sheet_rows(contents: DataFrame, skip: int = 1) -> DataFrame:
    """(file, row_number, cells) of the first sheet of workbooks given as (path, content), without ``skip`` header rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = _sheet_rows(content.as_py(), skip)
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.list_(pa.string()))], names=["file", "row_number", "cells"])

    return contents.select("path", "content").mapInArrow(run, "file string, row_number long, cells array<string>")


def nested_records(rows: DataFrame, *, is_major, major: dict[int, str], minor: dict[int, str], minors: str = "steps") -> DataFrame:
    """Records of workbook rows: a major row opens one, later rows join its list; blank rows and leading minors go."""
    cell = lambda i: F.coalesce(F.get("cells", F.lit(i)), F.lit(""))
    filled = rows.where(F.exists("cells", lambda c: tx.strip(c) != "")).withColumn("major", is_major(F.col("cells")))
    island = F.sum(F.col("major").cast("int")).over(Window.partitionBy("file").orderBy("row_number").rowsBetween(Window.unboundedPreceding, 0))
    own = F.struct("row_number", F.struct(*[cell(i).alias(n) for i, n in minor.items()]).alias("v"))
    head = F.struct(*[cell(i).alias(n) for i, n in major.items()])
    grouped = filled.withColumn("island", island).where("island > 0").groupBy("file", "island")
    out = grouped.agg(F.min_by(head, "row_number").alias("h"), F.array_sort(F.collect_list(F.when(F.lit(True), own))).alias("m"))
    return out.select("file", "island", "h.*", F.transform("m", lambda x: x["v"]).alias(minors))


def match_path(path: str, patterns) -> str | None:
    """The pattern that a path matches: itself before any ending given as */ending."""
    patterns = [patterns] if isinstance(patterns, str) else list(patterns or ())
    if path in patterns:
        return path
    return next((p for p in patterns if p.startswith("*/") and path.endswith(p[1:])), None)


def xml_records(spark: SparkSession, path: str, **options) -> DataFrame:
    return xml_file_records(spark.read.format("binaryFile").load(path), **options)


def xml_file_records(contents: DataFrame, *, triggers, attributes: dict[str, dict[str, str]], texts: dict[str, str], clean=None) -> DataFrame:
    """(file, record_number, record) of XML files given as (path, content): attributes are taken where an element opens, texts where it closes,
    and the record so far is given out where a trigger closes; what came before carries over to the next."""
    tidy = clean or plain_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                records, record, trail = [], {}, []
                for event, node in ElementTree.iterparse(io.BytesIO(content), ("start", "end")):
                    if event == "start":
                        trail.append(_TAG.sub("", node.tag))
                        wanted = attributes.get(match_path("/".join(trail), attributes) or "", {})
                        record |= {out: node.attrib[a] for a, out in wanted.items() if a in node.attrib}
                        continue
                    here = "/".join(trail)
                    if (pattern := match_path(here, texts)) is not None:
                        record[texts[pattern]] = tidy(node.text)
                    if match_path(here, triggers) is not None and record:
                        records.append(record)
                        record = {}
                    node.clear()
                    trail.pop()
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(records), pa.string()), pa.array(range(len(records)), pa.int64()), pa.array([list(r.items()) for r in records], pa.map_(pa.string(), pa.string()))], names=["file", "record_number", "record"])

    return contents.select("path", "content").mapInArrow(run, "file string, record_number long, record map<string,string>")


def plain_text(raw: str | None) -> str:
    """The HTML cleaner of the text functions, for use inside a reader."""
    import html

    text = html.unescape(raw or "")
    for pattern, becomes in tx._HTML_RULES:
        text = re.sub(pattern.replace("(?U)", ""), becomes.replace("$1", r"\1"), text)
    return text.strip()


def images(spark: SparkSession, folder: str, *, recursive: bool = True) -> DataFrame:
    """(image_path, file_size, modified, image_id, source_ao_id, embedding_name) of image files; contents aren't read."""
    plain = F.try_url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))  # the source gives names as they stand in an address
    found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder).select(F.coalesce(plain, "path").alias("path"), "length", "modificationTime")
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    chosen = found.where(F.rlike(F.lower("path"), F.lit(rf"\.({'|'.join(IMAGE_SUFFIXES)})$")))
    return chosen.select(
        F.col("path").alias("image_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("modified"), stem.alias("image_id"), source_id(stem).alias("source_ao_id"),
        F.concat(F.regexp_replace(stem, r"[^A-Za-z0-9_.\-]+", "_"), F.lit("_"), F.left(F.sha1("path"), F.lit(12)), F.lit(".pt")).alias("embedding_name"),
    ).orderBy("image_path")


def source_id(stem):
    return F.nullif(F.regexp_extract(stem, r"_id([^_.\-]+)", 1), F.lit(""))


def stale_embeddings(files: DataFrame, index: DataFrame) -> DataFrame:
    """Files whose embedding must be made anew: not in the index, or of another size or time."""
    same = (files["image_path"] == index["image_path"]) & (files["file_size"] == index["file_size"]) & (files["modified"] == index["modified"])
    return files.join(index, same, "left_anti")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Rows and an order-free hash of a table, to hold an index against the corpus it was made of. Hashes are added, so
    repeated rows count, too."""
    total = F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.pmod(total, F.lit((1 << 61) - 1)).cast("long").alias("hash"))


_READ: dict[str, tuple[tuple, DataFrame]] = {}


def cached_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lenient objects of a path, kept in memory until a file's time or size changes."""
    seen = spark.read.format("binaryFile").load(path).agg(F.array_sort(F.collect_list(F.struct("path", "modificationTime", "length"))).alias("f")).first().f
    mark = tuple(map(tuple, seen))
    held = _READ.get(path)
    if held is None or held[0] != mark:
        if held is not None:
            held[1].unpersist()
        held = _READ[path] = (mark, lenient_json_lines(spark, path, schema).cache())
    return held[1]
