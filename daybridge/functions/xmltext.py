"""Text of XML fields: numbers, ISO times, escaping, elements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters XML 1.0 does not allow at all, escaped or not.
_NOT_XML = "[^\\u0009\\u000A\\u000D\\u0020-\\uD7FF\\uE000-\\uFFFD\\x{10000}-\\x{10FFFF}]"


def number_text(value: Column, kind: T.DataType) -> Column:
    """A number without exponent, doubles with at least one decimal (``10000000.0``)."""
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        return value.cast("string")
    plain = value.cast("string")
    # Doubles of 1e7 and above print with an exponent; within 1e16 a decimal holds them exactly
    # enough for their shortest form.
    digits = F.rtrim(value.try_cast("decimal(30,10)").cast("string"), F.lit("0"))
    wide = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    # From 1e16 on all digits stand before the exponent's end: fill up with zeros.
    far = [F.regexp_extract(plain, r"^(-?)(\d)\.(\d+)E(\d+)$", i) for i in range(1, 5)]
    huge = F.concat(far[0], far[1], F.rpad(F.rtrim(far[2], F.lit("0")), far[3].try_cast("int"), F.lit("0")), F.lit(".0"))
    # Below 1e-3 the shortest digits stand before an exponent: put the zeros before them instead.
    part = [F.regexp_extract(plain, r"^(-?)(\d)\.(\d+)E-(\d+)$", i) for i in range(1, 5)]
    zeros = F.repeat(F.lit("0"), part[3].try_cast("int") - 1)
    small = F.concat(part[0], F.lit("0."), zeros, part[1], F.rtrim(part[2], F.lit("0")))
    return (F.when((F.abs(value) >= 1e7) & (F.abs(value) < 1e16), wide)
            .when((F.abs(value) >= 1e16) & plain.contains("E"), huge)
            .when(plain.contains("E-"), small).when(~F.isnan(value), plain))


def iso_text(value: Column, kind: T.DataType) -> Column:
    """ISO form of a timestamp, fraction only where there is one; other types as plain text."""
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return value.cast("string")
    zone = "xxx" if isinstance(kind, T.TimestampType) else ""
    whole = F.date_format(value, f"yyyy-MM-dd'T'HH:mm:ss{zone}")
    exact = F.date_format(value, f"yyyy-MM-dd'T'HH:mm:ss.SSSSSS{zone}")
    has_fraction = F.date_format(value, "SSSSSS") != "000000"
    return F.when(has_fraction, exact).otherwise(whole)


def escaped(text: Column) -> Column:
    """Text escaped once for element content; NULL stays NULL, forbidden characters become U+FFFD."""
    legal = F.regexp_replace(text, _NOT_XML, "�")
    out = F.replace(legal, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))


def attribute(text: Column) -> Column:
    """Text escaped for a double-quoted attribute; NULL becomes empty."""
    return F.coalesce(F.replace(escaped(text), F.lit('"'), F.lit("&quot;")), F.lit(""))


def element(tag: str, text: Column, empty: str = "<{}/>") -> Column:
    """``<tag>text</tag>``, or the empty tag when the text is NULL or empty."""
    body = escaped(text)
    filled = F.concat(F.lit(f"<{tag}>"), body, F.lit(f"</{tag}>"))
    return F.when(F.length(body) > 0, filled).otherwise(F.lit(empty.format(tag)))
