"""API responses landed as text: unwrap the envelope into records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.functions.jsontext import LONGEST_STRING, clean_nulls, is_json, not_json

ON_ERROR = ("raise", "reject")

# JSON texts that count as false in a success flag, after null cleaning.
_FALSE_TEXTS = ("false", "0", "0.0", "-0.0", '""', "[]", "{}")

# The reader's limits: only a record is a value as a whole, a response may be of any size a string has.
_LIMITS = {"maxStringLen": str(2**31 - 1), "maxNestingDepth": "1000"}

_ENVELOPE = "array<struct<success variant, error variant, data array<variant>, mark bigint>>"


def _read(text: Column, is_list: Column) -> tuple[Column, Column]:
    """The response's list of records with a mark behind it, as a bare list and as an envelope.

    A reader stops at the end of the first value and ignores what follows. The text is read as the first
    of two items of a list, the second being its hash: that this came out second shows that the text was
    one value, consumed whole.
    """
    mark = F.xxhash64(text).cast("string")
    bare = F.from_json(F.concat(F.lit('{"data":['), text, F.lit(",["), mark, F.lit("]]}")),
                       "struct<data array<array<variant>>>", _LIMITS)
    envelope = F.from_json(F.concat(F.lit("["), text, F.lit(',{"mark":'), mark, F.lit("}]")), _ENVELOPE, _LIMITS)
    return F.when(is_list, bare["data"]), F.when(~is_list, envelope)


def _refused(text: Column, root: Column) -> Column:
    """What is wrong with a response that has no list of records."""
    has_data = F.try_variant_get(root, "$.data", "variant").isNotNull()
    return (
        F.when(~F.coalesce(is_json(text), F.lit(False)), not_json(text, "response"))
        .when(has_data, F.lit("data is not a list"))
        .otherwise(F.lit("response has no data and is not a list"))
    )


def unwrap_envelope(df: DataFrame, column: str, on_error: str = "raise") -> DataFrame:
    """One row per record of each response, as cleaned JSON text in ``record``.

    A response is an object whose ``data`` is the list of records, or the list itself. A
    ``success`` that is present and false, a ``data`` that is no list, or neither form is an error:
    it fails the query, or with ``on_error="reject"`` gives a row with only ``error`` set.

    Records are taken out one by one as the response is read, so only a record has to be within what a
    JSON value may hold (128 MiB), not the response.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}, not {on_error!r}")
    others = [c for c in df.columns if c != column]
    staged = df.select(*others, clean_nulls(F.col(column)).alias("_text"))
    is_list = F.coalesce(F.ltrim(F.col("_text"), F.lit(" \t\r\n")).startswith("["), F.lit(False))
    bare, envelope = _read(F.col("_text"), is_list)
    staged = staged.select("*", bare.alias("_bare"), envelope.alias("_envelope"))
    mark = F.xxhash64("_text")
    bare_whole = (F.size("_bare") == 2) & (F.try_variant_get(F.get(F.get("_bare", F.lit(1)), F.lit(0)), "$", "bigint") == mark)
    whole = (F.size("_envelope") == 2) & (F.get("_envelope", F.lit(1))["mark"] == mark)
    first = F.get("_envelope", F.lit(0))
    staged = staged.select(
        *others, "_text",
        F.when(F.coalesce(bare_whole, F.lit(False)), F.get("_bare", F.lit(0)))
        .when(F.coalesce(whole, F.lit(False)), first["data"]).alias("_items"),
        F.coalesce(whole, F.lit(False)).alias("_whole"), first["success"].alias("_success"), first["error"].alias("_reason"))
    failed = F.col("_whole") & F.to_json("_success").isin(*_FALSE_TEXTS)
    # what a response without a list is instead, only such responses are parsed for
    odd = F.col("_items").isNull()
    staged = staged.withColumn("_root", F.when(odd & ~(F.col("_whole") & (F.octet_length("_text") > LONGEST_STRING)),
                                               F.try_parse_json("_text")))
    staged = staged.withColumn("error", F.when(
        failed, F.concat(F.lit("request failed: "), F.coalesce(F.try_variant_get("_reason", "$", "string"), F.lit("success is false"))))
        .when(odd & F.col("_whole") & F.col("_root").isNull(), F.lit("response has no list of data"))
        .when(odd, _refused(F.col("_text"), F.col("_root"))))
    if on_error == "raise":
        items = F.when(F.col("error").isNull(), F.col("_items")).otherwise(
            F.raise_error(F.concat(F.lit("bad API response: "), "error")))
        return staged.select(*others, F.explode(items).alias("_item")).select(
            *others, F.to_json("_item").alias("record"))
    items = F.when(F.col("error").isNull(), F.col("_items"))
    rows = staged.select(*others, "error", F.explode_outer(items).alias("_item"))
    # An empty list is no error and no record.
    rows = rows.where(F.col("error").isNotNull() | F.col("_item").isNotNull())
    return rows.select(*others, F.to_json("_item").alias("record"), "error")
