"""Rows out of free-form model output. Whole JSON takes a built-in path; only the rest is scanned in an Arrow operator.

Three readers differ on purpose: `evaluation` takes the first list it finds, `judge` drops what is no object and takes
the first usable value, `server` lets a later list of objects replace an earlier one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselattice import schema

_DECODE = json.JSONDecoder().raw_decode
_OPENING = re.compile(r"[\[{]")


def values_in(text: str) -> Iterator:
    """Every JSON list or object that begins somewhere in the text, nested ones too."""
    for match in _OPENING.finditer(text):
        try:
            yield _DECODE(text, match.start())[0]
        except json.JSONDecodeError:
            pass


def unwrapped(text: str, *, cut_first: bool) -> str:
    """Text without thoughts and fences; ``cut_first`` cuts at the first closing tag before whole blocks go."""
    steps = [lambda t: re.sub(r"<think>.*?</think>", "", t, flags=re.I | re.S), lambda t: re.split(r"</think>", t, maxsplit=1, flags=re.I)[-1]]
    for step in reversed(steps) if cut_first else steps:
        text = step(text)
    return re.sub(r"\s*```\s*\Z", "", re.sub(r"\A\s*```(?:json)?\s*", "", text.strip(), flags=re.I)).strip()


def listed(value, keys: tuple[str, ...]) -> tuple[str, list] | None:
    """A list and how it was held: by itself, or as the first list among an object's ``keys``."""
    if isinstance(value, list):
        return "array", value
    held = value if isinstance(value, dict) else {}
    return next(((f"object_wrapper:{k}", held[k]) for k in keys if isinstance(held.get(k), list)), None)


@dataclass
class Reading:
    """What was read out of a text: its rows, how, and what is wrong."""

    rows: list[dict] = field(default_factory=list)
    mode: str = "failed"
    errors: list[str] = field(default_factory=list)

    @property
    def success(self) -> bool:
        return self.mode != "failed" and not self.errors

    @property
    def strict(self) -> bool:
        return self.mode == "strict_json_array"


def _candidates(text: str) -> Iterator[tuple[str, list]]:
    """Lists in the order in which they are tried: the whole text's, then those in it without thoughts and fences."""
    try:
        whole = listed(json.loads(text), schema.ROW_LIST_KEYS)
    except json.JSONDecodeError:
        whole = None
    if whole:
        yield ("strict_json_array" if whole[0] == "array" else whole[0]), whole[1]
    for value in values_in(unwrapped(text, cut_first=False)):
        if (held := listed(value, schema.ROW_LIST_KEYS)) is not None:
            yield f"recovered_{held[0]}", held[1]


def read_evaluation(text: str) -> Reading:
    """The first list that the text gives; one that holds anything but objects gives no rows."""
    mode, rows = next(_candidates(text.strip()), ("failed", []))
    if mode == "failed":
        return Reading(errors=["no_json_list"])
    odd = [f"[{i}]:not_an_object" for i, r in enumerate(rows) if not isinstance(r, dict)]
    return Reading([] if odd else rows, mode, odd)


def read_judge(text: str) -> Reading:
    """The first value that is a list, or an object that names one; what in it is no object is left out."""
    for value in values_in(unwrapped(text, cut_first=True)):
        held = value
        if isinstance(value, dict):
            head, *others = schema.JUDGE_LIST_KEYS
            held = value[head] if value.get(head) is not None else next((value[k] for k in others if k in value), None)
        if isinstance(held, list):
            return Reading([r for r in held if isinstance(r, dict)], "judge")
    return Reading(errors=["no_json_list"])


def read_server(text: str) -> Reading:
    """The last list with objects among all values of the text, else the first list."""
    bare = unwrapped(text, cut_first=False)
    try:
        values = [json.loads(bare)]
    except json.JSONDecodeError:
        values = list(values_in(bare))
    held = [next((v[k] for k in schema.ROW_LIST_KEYS if k in v), []) if isinstance(v, dict) else v for v in values]
    lists = [[r for r in v if isinstance(r, dict)] for v in held if isinstance(v, list)]
    return Reading(next((v for v in reversed(lists) if v), []), "server") if lists else Reading(errors=["no_json_list"])


READERS = {"evaluation": read_evaluation, "judge": read_judge, "server": read_server}


def first_object(text: str) -> dict | None:
    return next((v for v in values_in(unwrapped(text, cut_first=True)) if isinstance(v, dict)), None)


def _cell(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def recover_rows(outputs: DataFrame, text: str, *, reader: str = "evaluation", keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """Adds rows, parse_success, strict_json_array, parse_mode, schema_valid and errors; a null text is an empty one.

    errors: why nothing was read, or what `prep.row_errors` says of the rows; schema_valid: there is none.
    """
    from caselattice.operators.prep import row_errors

    read = "parsed array<map<string,string>>, parse_success boolean, strict_json_array boolean, parse_mode string, found array<string>, written string"
    out = T.StructType([*(outputs.schema[c] for c in keep), *T._parse_datatype_string(read).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [READERS[reader](value.as_py() or "") for value in batch.column(len(keep))]
            maps = [[[(k, _cell(v)) for k, v in r.items()] for r in f.rows] for f in found]
            written = [json.dumps(f.rows, ensure_ascii=False) if f.success else None for f in found]
            columns = [pa.array(maps, pa.list_(pa.map_(pa.string(), pa.string()))), pa.array([f.success for f in found], pa.bool_()), pa.array([f.strict for f in found], pa.bool_()), pa.array([f.mode for f in found], pa.string()), pa.array([f.errors for f in found], pa.list_(pa.string())), pa.array(written, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *columns], names=out.names)

    got = outputs.select(*keep, text).mapInArrow(run, out)
    errors = F.when(F.col("written").isNull(), F.col("found")).otherwise(row_errors(typed_rows("written")))
    got = got.withColumn("errors", errors)
    return got.select(*keep, F.col("parsed").alias("rows"), "parse_success", "strict_json_array", "parse_mode", (F.size("errors") == 0).alias("schema_valid"), "errors")


def response_text(c) -> Column:
    """The answer in a chat service's reply, a content list joined; a reply that is no such object is the text itself."""
    reply = F.col(c) if isinstance(c, str) else c
    at = lambda path: F.get_json_object(reply, path)
    content = at("$.choices[0].message.content")
    listed = F.from_json(content, "array<struct<text:string>>")
    joined = F.when(content.startswith("["), F.array_join(F.transform(listed, lambda x: x["text"]), ""))
    return F.coalesce(joined, content, at("$.content"), at("$.text"), reply, F.lit(""))


def typed_rows(c) -> Column:
    """A JSON list of objects as an array of maps from field to (kind, value); null if it is no list.

    Absent fields have no key, JSON nulls have kind null: the checks on rows tell them apart.
    """
    parsed = F.try_parse_json(F.col(c) if isinstance(c, str) else c)
    objects = F.try_variant_get(parsed, "$", "array<map<string,variant>>")
    kinds = lambda v: F.lower(F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1))
    named = lambda v: F.when(F.is_variant_null(v), "null").otherwise(kinds(v))
    return F.transform(objects, lambda row: F.transform_values(row, lambda _, v: F.struct(named(v).alias("kind"), F.try_variant_get(v, "$", "string").alias("value"))))
