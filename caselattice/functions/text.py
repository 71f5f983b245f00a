"""String functions as columns; no Python runs on the executors unless a name says so."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselattice import schema
from caselattice.functions import similarity as sim

_EMPTY_WORDS = ("", "[]", "null", "none", "无", "否")
#: One-character stop words of the search tokenizer, and the stop words of the index tokenizer.
SEARCH_STOP = ("的", "了", "和", "是", "在", "将", "与", "或")
INDEX_STOP = (
    "的 了 在 是 我 有 和 就 不 人 都 一 一个 上 也 很 到 说 要 去 你 会 着 没有 看 好 自己 这 他 她 它 们 那 些 "
    "the a an is are was were be been being have has had do does did will would could should may might can shall to of in for on with at by from as into through during"
).split()
#: Words for a set flag; words of a judge's yes.
TRUE_WORDS = ("1", "true", "yes", "y", "是", "已删除", "deleted")
YES_WORDS = ("true", "yes", "是", "1")
_LETTER_STOP = [w for w in INDEX_STOP if len(w) == 1]


#: What becomes of parts of an HTML fragment, in this order.
_HTML_RULES = (
    (r"""(?i)<?img\b[^>]*?src=["']([^"']+)["'][^>]*>?""", "[IMAGE: $1]"),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)</?p[^>]*>", "\n"),
    (r"(?i)<tab\s*/?>", "\t"),
    ("\u00a0", ""),
    ("&nbsp;", " "),
    ("[\u200b\u200c\u200d\ufeff]", ""),
    ("<[^>]+>", ""),
    (r"(?U)\n\s*\n", "\n"),
)


def text_of(c) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def strip(c) -> Column:
    """Without white space at the ends, Unicode's included."""
    return F.regexp_replace(text_of(c), r"(?U)\A[\s\x1c-\x1f\x85]+|[\s\x1c-\x1f\x85]+\z", "")


def squeeze_out_space(c) -> Column:
    return F.regexp_replace(text_of(c), r"(?U)[\s\x1c-\x1f\x85]+", "")


def clean(c) -> Column:
    """Null to empty, NULs dropped, stripped."""
    return strip(F.translate(text_of(c), "\0", ""))


def filled(c) -> Column:
    """The stripped value, or null if nothing is left."""
    return F.nullif(clean(c), F.lit(""))


def is_meaningful(c) -> Column:
    """Not one of the retrieval's words for nothing."""
    return ~F.lower(strip(c)).isin(*_EMPTY_WORDS)


def is_true(c) -> Column:
    """A flag spelled as one of the words for true or deleted."""
    return F.lower(clean(c)).isin(*TRUE_WORDS)


def reference_form(c) -> Column:
    """Identifiers after @ become @ID, with single spaces about operators; values without @ are only stripped."""
    bare = strip(c)
    named = F.regexp_replace(bare, schema.REFERENCE_PATTERN, "@ID")
    spaced = F.regexp_replace(named, rf"(?U)\s*({schema.OPERATOR_PATTERN})\s*", " $1 ")
    return F.when(bare.contains("@"), strip(F.regexp_replace(spaced, r"(?U)\s+", " "))).otherwise(bare)


@F.pandas_udf(T.StringType())
def _numeric_text(values: pd.Series) -> pd.Series:
    return values.map(sim.number_form, na_action="ignore")


def numeric_form(c) -> Column:
    """Each part of a list with semicolons: whole numbers without a fraction, others with six digits, words as they are.

    An Arrow function: the built-ins round a number's shortest decimal, which differs where that is a tie and the number
    itself is not.
    """
    return _numeric_text(text_of(c))


def field_form(value, field, *, nfkc: bool = True) -> Column:
    """A value as it is compared, by the field's kind; the first kind that fits decides, so references beat numbers."""
    shaped = strip(nfkc_text(text_of(value)) if nfkc else value)
    combined = shaped
    for word, short in schema.COMBINE_WORDS.items():
        combined = F.replace(combined, F.lit(word), F.lit(short))
    forms = {"reference": reference_form(shaped), "flag": casefold_text(shaped) if nfkc else F.lower(shaped), "number": numeric_form(shaped), "combination": combined}
    kind = F.element_at(F.create_map(*[F.lit(x) for item in schema.FIELD_KINDS.items() for x in item]), F.col(field) if isinstance(field, str) else field)
    out = F.when(shaped.isin(*schema.NOTHING), "")
    for name, form in forms.items():
        out = out.when(kind == name, form)
    return out.otherwise(shaped)


@F.pandas_udf(T.StringType())
def nfkc_text(values: pd.Series) -> pd.Series:
    """Compatibility normal form (an Arrow UDF: there is no built-in)."""
    return values.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


@F.pandas_udf(T.StringType())
def casefold_text(values: pd.Series) -> pd.Series:
    return values.map(str.casefold, na_action="ignore")


@F.pandas_udf(T.StringType())
def decode_references(values: pd.Series) -> pd.Series:
    """Character references (an Arrow UDF: there is no built-in)."""
    return values.map(html.unescape, na_action="ignore")


def searchable(parts: list) -> Column:
    """Distinct non-blank parts in their order, with bars between them."""
    return F.array_join(F.array_distinct(F.filter(F.array(*[clean(p) for p in parts]), lambda p: p != "")), " | ")


def plain_html(c, *, decode=decode_references) -> Column:
    """Text of an HTML fragment: references decoded first, then images named, breaks kept, other tags dropped."""
    x = decode(text_of(c))
    for pattern, becomes in _HTML_RULES:
        x = F.regexp_replace(x, pattern, becomes)
    return strip(x)


def without_reasoning(c, *, cut_first: bool = False) -> Column:
    """Model text without thoughts and code fences. ``cut_first`` cuts at the first closing tag before blocks go."""
    x = strip(c)
    blocks = lambda y: F.regexp_replace(y, r"(?is)<think>.*?</think>", "")
    cut = lambda y: F.regexp_replace(y, r"(?is)\A.*?</think>", "")
    x = blocks(cut(x)) if cut_first else cut(blocks(x))
    return strip(F.regexp_replace(F.regexp_replace(x, r"(?i)\A\s*```(?:json)?\s*", ""), r"\s*```\s*\z", ""))


def referenced_ids(c) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text_of(c), F.lit(r"(?<![A-Za-z0-9])@([A-Za-z][A-Za-z0-9_\-]*)"), F.lit(1))))


def referenced_tasks(c) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text_of(c), F.lit(r"((?i)TASK\s*[0-9]{2}(?:-[0-9]{2,3}){3,5})"), F.lit(1))))


def needs_other_cases(c) -> Column:
    """More than one task, words that point to other cases, or an expression over a reference."""
    return (
        (F.size(referenced_tasks(c)) > 1)
        | F.rlike(text_of(c), F.lit(r"(?i)引用|其他测试用例|前序用例|来自.*用例|跨用例|另一个TASK"))
        | F.rlike(text_of(c), F.lit(r"[ab]\s*\*\s*@[_A-Za-z0-9-]+"))
    )


def defined_ids(text, markers: Column | None = None) -> Column:
    """Identifiers that the text records, defines, saves, measures or computes, and those in ``markers``; upper case."""
    found = F.regexp_extract_all(text_of(text), F.lit(r"(?:记录|定义|保存|测量|计算)[^@\n]{0,80}@([A-Za-z0-9_\-]+)"), F.lit(1))
    if markers is not None:
        found = F.array_union(found, F.flatten(F.transform(markers, lambda m: F.regexp_extract_all(F.coalesce(m, F.lit("")), F.lit(r"@([A-Za-z0-9_\-]+)"), F.lit(1)))))
    return F.array_sort(F.array_distinct(F.transform(found, F.upper)))


def index_tokens(c) -> Column:
    """A token per letter, digit or ideograph, lower case, without stop words."""
    return F.filter(F.regexp_extract_all(F.lower(text_of(c)), F.lit(r"([\p{L}\p{N}])"), F.lit(1)), lambda t: ~t.isin(*_LETTER_STOP))


def search_tokens(c) -> Column:
    """Latin words with digits, numbers, @identifiers and single ideographs, lower case, without stop characters."""
    found = F.regexp_extract_all(F.lower(text_of(c)), F.lit(r"([a-z]+[a-z0-9_\-]*|[0-9]+(?:\.[0-9]+)?|@[a-z0-9_\-]+|[\x{4e00}-\x{9fff}])"), F.lit(1))
    return F.filter(found, lambda t: ~t.isin(*SEARCH_STOP))


def column_name(number) -> Column:
    """A sheet column's letters from its number, 1 for A, up to three letters."""
    n = F.col(number) if isinstance(number, str) else number
    letter = lambda k: F.chr((k + 65).cast("int"))
    return F.concat(F.when(n > 702, letter(F.floor((n - 703) / 676))).otherwise(""), F.when(n > 26, letter(F.pmod(F.floor((n - 27) / 26), F.lit(26)))).otherwise(""), letter(F.pmod(n - 1, F.lit(26))))


def column_number(name) -> Column:
    return F.aggregate(F.split(F.upper(text_of(name)), ""), F.lit(0), lambda s, x: s * 26 + F.ascii(x) - 64)


def judged_true(c) -> Column:
    """A judge's boolean, given as such or as a word."""
    return F.lower(strip(c)).isin(*YES_WORDS)


def stamp(at: Column | None = None, zone: str = "UTC") -> Column:
    """A moment as text with its offset, the current one by default."""
    moment = F.current_timestamp() if at is None else at
    return F.date_format(F.from_utc_timestamp(F.to_utc_timestamp(moment, F.current_timezone()), zone), "yyyy-MM-dd'T'HH:mm:ss")


def round_micro(c) -> Column:
    """Millionths as a long, rounded half up from the double alone: the same in every engine."""
    return F.floor((F.col(c) if isinstance(c, str) else c) * 1e6 + 0.5).cast("long")
