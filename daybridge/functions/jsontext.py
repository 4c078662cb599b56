"""JSON kept as text: scalar lookup, null cleaning, validity, row to record."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Walks from the end of the last match over anything that is not the start of null/NaN, taking
# whole string literals at once, so words inside strings are never touched.
_NULL_OUTSIDE_STRINGS = r'\G((?:[^"nN]++|"(?:[^"\\]++|\\.)*+")*+)(?:null|NaN)'


def _is_nested(document: Column, key: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(document, f"$['{key}']", "variant")).rlike("^(OBJECT|ARRAY)")


def json_scalar(text: str | Column, key: str) -> Column:
    """Scalar under a top-level key as text.

    NULL for an object, an array, JSON null, a missing key and unparseable text.
    """
    document = F.try_parse_json(text)
    return F.when(~_is_nested(document, key), F.try_variant_get(document, f"$['{key}']", "string"))


def any_scalar(text: Column, tests: dict[str, Callable[[Column], Column]]) -> Column:
    """True when the scalar under any of the keys passes its test; the text is parsed once.

    A filter evaluates each mention of an expression anew, so the parsed document is bound as the
    one item of an array. The type is looked up only for values that pass.
    """
    def passes(document: Column) -> Column:
        found = [test(F.try_variant_get(document, f"$['{key}']", "string")) & ~_is_nested(document, key)
                 for key, test in tests.items()]
        return reduce(Column.__or__, found)
    return F.exists(F.array(F.try_parse_json(text)), passes)


def clean_nulls(text: str | Column) -> Column:
    """Replace every JSON null and NaN value, at any depth, by the empty string."""
    text = F.col(text) if isinstance(text, str) else text
    # Most of the cost is saved where neither word occurs at all.
    may_hold = F.contains(text, F.lit("null")) | F.contains(text, F.lit("NaN"))
    return F.when(may_hold, F.regexp_replace(text, _NULL_OUTSIDE_STRINGS, '$1""')).otherwise(text)


# Fixed value: characters of the longest string that Spark's JSON parser takes; a whole text may have 128 MiB.
LONGEST_STRING = 20_000_000


def not_json(text: Column, what: str) -> Column:
    """Why a text was not taken as JSON: it is none, or it may be beyond what the parser takes, with its size."""
    size = F.octet_length(text)
    too_large = F.concat(F.lit(f"{what} not parsed, not JSON or beyond the parser's limits: "),
                         size.cast("string"), F.lit(" bytes"))
    return F.when(size > LONGEST_STRING, too_large).otherwise(F.lit(f"not a JSON {what}"))


def is_json(text: Column) -> Column:
    """True when the text is exactly one JSON value.

    The parser stops at the end of the first value and ignores what follows. Reading the text as
    the first of two array items, the second being a hash of the text, shows that it was
    consumed whole.
    """
    mark = F.xxhash64(text)
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark.cast("string"), F.lit("]")))
    whole = (F.try_variant_get(pair, "$[1]", "bigint") == mark) & F.try_variant_get(pair, "$[2]", "variant").isNull()
    return F.coalesce(whole, F.lit(False))


def _needs_care(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _needs_care(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_needs_care(f.dataType) for f in kind)
    return isinstance(kind, (T.FloatType, T.DoubleType, T.TimeType))


def _recordable(value: Column, kind: T.DataType) -> Column:
    """NaN as NULL and times of day as text, at any depth; other values as they are."""
    if not _needs_care(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _recordable(item, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_recordable(value.getField(f.name), f.dataType).alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value.cast("string") if isinstance(kind, T.TimeType) else F.when(~F.isnan(value), value)


def row_record(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The row as cleaned JSON text: nulls and NaN become ``""``, timestamps ISO, decimals numbers."""
    names = columns or df.columns
    fields = [_recordable(F.col(f"`{n}`"), df.schema[n].dataType).alias(n) for n in names]
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx",
               "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return clean_nulls(F.to_json(F.struct(*fields), options))
