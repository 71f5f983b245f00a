"""Writers: JSON lines, CSV with a byte order mark, manifests, and workbooks of three sheets."""

from __future__ import annotations

import contextlib
import csv
import io
import itertools
import json
import math
import re
import string
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession

from caselattice import schema
from caselattice.functions import text as tx

# The sheets' columns.
CANONICAL_COLUMNS = (
    "步骤层级", "说明", "注意事项", "操作内容", "操作对象", "操作目的", "是否同时发送", "多判据组合条件", "是否使用设备", "操作类型", "判据类型",
    "判据范围", "判据描述", "左值", "右值", "单位", "设备类型", "设备单元号", "设备指令号", "设备参数", "判据关联标志",
)
AUDIT_COLUMNS = (
    "修改序号", "输出行", "原设备类型", "新设备类型", "原设备指令号", "新设备指令号", "设备单元号", "设备参数", "候选主键", "候选功能说明", "BM25排名", "BGE排名", "BGE分数", "BGE间隔", "原检索决策", "应用时间",
)
CANDIDATE_FIELDS = ("bm25_rank", "bge_rank", "bge_score", "bge_margin_to_second")
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_RELATIONS = "application/vnd.openxmlformats-package.relationships+xml"
_SPREADSHEET = "application/vnd.openxmlformats-officedocument.spreadsheetml"
CELL_LIMIT, CELL_KEPT, CUT_MARK = 32_000, 31_980, "…（内容已截断）"
# End of fixed values.


def write_json_lines(df: DataFrame, path: str, *order: str) -> None:
    """Compact objects, nulls kept, in files whose names follow the order; fails if ``path`` is there."""
    (df.orderBy(*order) if order else df).write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_chunks(spark: SparkSession, path: str, chunks: Iterable[bytes], overwrite: bool = False) -> None:
    """Bytes to a file of any store that Hadoop knows, one chunk in memory at a time, by a temporary name and a rename."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    target, draft = path_of(path), path_of(path + ".tmp")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target) and not overwrite:
        raise FileExistsError(path)
    stream = fs.create(draft, True)
    try:
        for chunk in chunks:
            stream.write(bytearray(chunk))
    finally:
        stream.close()
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(draft, target)


def write_text(spark: SparkSession, path: str, data: bytes, overwrite: bool = False) -> None:
    write_chunks(spark, path, [data], overwrite)


def write_manifest(spark: SparkSession, path: str, entries: dict, overwrite: bool = False) -> None:
    write_text(spark, path, json.dumps(entries, ensure_ascii=False, indent=1).encode(), overwrite)


@contextlib.contextmanager
def run_manifest(spark: SparkSession, path: str, **facts) -> Iterator[dict]:
    """A manifest that says ``initializing`` while the block runs, then ``completed``, or ``failed`` with the error; what
    the block puts into the dictionary goes in, too."""
    entries = {"status": "initializing", "started_at": spark.range(1).select(tx.stamp()).first()[0], **facts}
    write_manifest(spark, path, entries)
    try:
        yield entries
        entries["status"] = "completed"
    except BaseException as error:
        entries |= {"status": "failed", "error": f"{type(error).__name__}: {error}"}
        raise
    finally:
        entries["ended_at"] = spark.range(1).select(tx.stamp()).first()[0]
        write_manifest(spark, path, entries, overwrite=True)


def write_result_csv(df: DataFrame, path: str, most: int = 10_000) -> None:
    """Rows as one CSV file that begins with a byte order mark; the driver holds a partition and ``most`` lines of it."""

    def lines() -> Iterator[bytes]:
        yield b"\xef\xbb\xbf" + _csv_line(df.columns)
        rows = df.toLocalIterator()
        while some := list(itertools.islice(rows, most)):
            yield b"".join(_csv_line(["" if v is None else v for v in row]) for row in some)

    write_chunks(df.sparkSession, path, lines())


def _csv_line(values) -> bytes:
    out = io.StringIO()
    csv.writer(out).writerow(values)
    return out.getvalue().encode()


def distinct_paths(*paths: str) -> None:
    if len({p.rstrip("/") for p in paths}) != len(paths):
        raise ValueError("input and outputs must be different paths")


def column_names() -> Iterator[str]:
    """A, B, ..., Z, AA, AB, ...: a sheet's columns in order."""
    for size in itertools.count(1):
        yield from map("".join, itertools.product(string.ascii_uppercase, repeat=size))


#: Characters that XML 1.0 does not allow.
_FORBIDDEN = re.compile("[^\t\n\r\x20-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]")


def shown(value) -> str:
    """A value as a cell's text: lists and objects as compact JSON, nothing for null, cut where a cell would be too long."""
    if isinstance(value, (dict, list, tuple)):
        value = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    text = _FORBIDDEN.sub("\ufffd", "" if value is None else str(value))
    return text[:CELL_KEPT] + CUT_MARK if len(text) > CELL_LIMIT else text


class Sheet:
    """A worksheet as an element tree. Cells are truth values, finite numbers or inline strings, never formulas."""

    def __init__(self):
        self.root = ElementTree.Element("worksheet", xmlns=_MAIN)
        self.body = ElementTree.SubElement(self.root, "sheetData")

    def add(self, values, style: int) -> None:
        number = str(len(self.body) + 1)
        line = ElementTree.SubElement(self.body, "row", r=number)
        for name, value in zip(column_names(), values, strict=False):
            cell = ElementTree.SubElement(line, "c", r=name + number, s=str(style))
            if isinstance(value, (bool, int)) or isinstance(value, float) and math.isfinite(value):
                ElementTree.SubElement(cell, "v").text = str(+value)
                if isinstance(value, bool):
                    cell.set("t", "b")
            else:
                cell.set("t", "inlineStr")
                text = ElementTree.SubElement(ElementTree.SubElement(cell, "is"), "t")
                text.set("{http://www.w3.org/XML/1998/namespace}space", "preserve")
                text.text = shown(value)

    def written(self) -> bytes:
        return ElementTree.tostring(self.root, "UTF-8", xml_declaration=True)


def table_columns(rows: list[dict]) -> list[str]:
    """The canonical columns, then others as first met; those that begin with _ stay hidden."""
    return list(dict.fromkeys([*CANONICAL_COLUMNS, *(k for r in rows for k in r if not k.startswith("_"))]))


def build_workbook(*, ao_text: str, original_rows: list[dict], final_rows: list[dict], modifications: list[dict], facts: dict) -> bytes:
    """Three sheets: the final table, the original table, and the audit with the facts of the export. Text only, no
    formulas. A case's table has at most a thousand rows."""
    changed = {m["row_index"] for m in modifications}

    def table(rows: list[dict]) -> Sheet:
        names, sheet = table_columns(rows), Sheet()
        sheet.add(["行号", *names], 1)
        for i, r in enumerate(rows):
            sheet.add([i + 1, *(r.get(n, "") for n in names)], row_style(i, i in changed, r))
        return sheet

    audit = Sheet()
    for fact in {"AO": ao_text, **facts}.items():
        audit.add(fact, 2)
    audit.add(AUDIT_COLUMNS, 1)
    for number, edit in enumerate(sorted(modifications, key=lambda m: m["row_index"]), 1):
        audit.add(audit_row(number, edit), 5 + number % 2)
    if not modifications:
        audit.add(["未应用任何设备修改"], 2)
    sheets = {"最终表格": table(final_rows), "原始表格": table(original_rows), "修改记录": audit}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, content in _package(list(sheets)).items():
            book.writestr(name, ElementTree.tostring(content, "UTF-8", xml_declaration=True))
        for i, sheet in enumerate(sheets.values(), 1):
            book.writestr(f"xl/worksheets/sheet{i}.xml", sheet.written())
    return out.getvalue()


def row_style(index: int, modified: bool, row: dict) -> int:
    return 8 if modified else 7 if row.get(schema.LEVEL) == schema.EXECUTION else 5 + index % 2


def audit_row(number: int, edit: dict) -> list:
    """One edit as the audit's columns show it."""
    old, new, found = (edit.get(k) or {} for k in ("original", "final", "candidate"))
    devices = [side.get(name) for name in ("设备类型", "设备指令号") for side in (old, new)]
    return [number, edit["row_index"] + 1, *devices, *map(new.get, ("设备单元号", "设备参数")), *map(found.get, ("设备指令主键", "设备指令功能说明", *CANDIDATE_FIELDS)), edit.get("source_decision"), edit.get("applied_at")]


def _package(names: list[str]) -> dict[str, ElementTree.Element]:
    """The parts of a workbook beside its sheets."""
    made = lambda tag, space, *children: _with(ElementTree.Element(tag, xmlns=space), children)
    part = lambda tag, **given: ElementTree.Element(tag, given)
    sheets = range(1, len(names) + 1)
    types = [part("Default", Extension="rels", ContentType=_RELATIONS), part("Default", Extension="xml", ContentType="application/xml"), part("Override", PartName="/xl/workbook.xml", ContentType=f"{_SPREADSHEET}.sheet.main+xml"), part("Override", PartName="/xl/styles.xml", ContentType=f"{_SPREADSHEET}.styles+xml")]
    types += [part("Override", PartName=f"/xl/worksheets/sheet{i}.xml", ContentType=f"{_SPREADSHEET}.worksheet+xml") for i in sheets]
    link = lambda i, kind, target: part("Relationship", Id=f"rId{i}", Type=f"{_OFFICE}/{kind}", Target=target)
    book = made("workbook", _MAIN, _with(part("sheets"), [ElementTree.Element("sheet", {"name": n, "sheetId": str(i), f"{{{_OFFICE}}}id": f"rId{i}"}) for i, n in zip(sheets, names, strict=True)]))
    plain = {"fonts": "font", "fills": "fill", "borders": "border", "cellStyleXfs": "xf"}
    styles = [_with(part(many, count="1"), [part(one)]) for many, one in plain.items()] + [_with(part("cellXfs", count="9"), [part("xf") for _ in range(9)])]
    return {
        "[Content_Types].xml": made("Types", f"{_PACKAGE}/content-types", *types),
        "_rels/.rels": made("Relationships", f"{_PACKAGE}/relationships", link(1, "officeDocument", "xl/workbook.xml")),
        "xl/workbook.xml": book,
        "xl/_rels/workbook.xml.rels": made("Relationships", f"{_PACKAGE}/relationships", *[link(i, "worksheet", f"worksheets/sheet{i}.xml") for i in sheets], link(len(names) + 1, "styles", "styles.xml")),
        "xl/styles.xml": made("styleSheet", _MAIN, *styles),
    }


ElementTree.register_namespace("r", _OFFICE)


def _with(element: ElementTree.Element, children) -> ElementTree.Element:
    element.extend(children)
    return element
