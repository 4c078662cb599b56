"""Product catalogue documents: one XML offer per product, one document per merchant."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.functions.xmltext import attribute, element, iso_text, number_text
from daybridge.operators.filters import on_day

# Source column and the XML tag it fills, in document order.
OFFER_TAGS = {
    "title": "name",
    "url": "url",
    "price": "price",
    "original_price": "oldprice",
    "category_full_path": "path",
    "sub_category": "category",
    "url_picture": "picture",
    "time_scrap": "scrappedat",
    "measure": "measure",
    "city": "city",
}
OFFER_CLOSE = "</offers>\n</shop>\n</yml_catalog>"


def _text(df: DataFrame, column: str) -> Column:
    """A column as XML text; a column the table lacks is NULL."""
    if column not in df.columns:
        return F.lit(None).cast("string")
    kind = df.schema[column].dataType
    return iso_text(F.col(column), kind) if column == "time_scrap" else number_text(F.col(column), kind)


def offer_id(df: DataFrame) -> Column:
    """``product_id``; ``id`` only where the table has no such column."""
    return F.coalesce(_text(df, "product_id" if "product_id" in df.columns else "id"), F.lit(""))


def catalogue_offers(df: DataFrame, day: dt.date | str | None = None) -> DataFrame:
    """One offer element per product of every merchant; products without a merchant are left out."""
    if "mercant_id" not in df.columns:
        raise ValueError("the table needs a mercant_id column")
    rows = df if day is None else on_day(df, "pars_date_created_at", day)
    rows = rows.where(F.col("mercant_id").cast("string") != "")
    parts = [F.concat(F.lit('<offer id="'), attribute(offer_id(df)), F.lit('">'))]
    parts += [element(tag, _text(df, column)) for column, tag in OFFER_TAGS.items()]
    parts.append(F.lit("</offer>"))
    name = F.col("mercant_name").cast("string") if "mercant_name" in df.columns else F.lit(None).cast("string")
    return rows.select(
        F.col("mercant_id").cast("string").alias("mercant_id"),
        name.alias("mercant_name"),
        offer_id(df).alias("offer_id"),
        F.concat_ws("\n", *parts).alias("offer"),
    )


def document_open(generated_at: dt.datetime) -> Column:
    """The envelope above the offers of a merchant."""
    return F.concat_ws(
        "\n",
        F.lit(f'<yml_catalog date="{generated_at:%Y-%m-%d %H:%M}">'),
        F.lit("<shop>"),
        element("name", F.col("mercant_name")),
        element("company", F.col("mercant_id")),
        F.lit("<categories/>"),
        F.lit("<offers>"),
    )


def merchants(offers: DataFrame, max_offers: int) -> DataFrame:
    """Per merchant: its name, its offer count and how many fragments its document takes.

    Counting per merchant and name first keeps the large step a hash aggregate; picking one of the
    names, normally the only one, is then left to a few rows.
    """
    named = offers.groupBy("mercant_id", "mercant_name").agg(F.count(F.lit(1)).alias("offers"))
    return named.groupBy("mercant_id").agg(
        F.min("mercant_name").alias("mercant_name"), F.sum("offers").alias("offers"),
    ).withColumn("fragments", F.ceil(F.col("offers") / F.lit(max_offers)).cast("long"))


def catalogue_lite(df: DataFrame, generated_at: dt.datetime, order_by: str | None = None,
                   rows: int | None = None, max_offers: int = 200_000) -> DataFrame | None:
    """Lines of the brief document, name and whole price of every product: ``(fragment, kind, position, value)``.

    Ordered by kind and position, the values of a fragment are a complete document; products are
    dealt to fragments of about ``max_offers`` by a hash of their content. The envelope names the first
    product's merchant, in ``order_by`` if given. ``rows`` limits the products and needs an order. No
    products, no lines.
    """
    if rows is not None and order_by is None:
        raise ValueError("a limit needs an order")
    text = {c: (F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string"))
            for c in ("mercant_name", "mercant_id", "title")}
    price = F.col("price").cast("long").cast("string") if "price" in df.columns else F.lit("0")
    offer = F.concat(F.lit('<offer id="'), attribute(_text(df, "id")), F.lit('">'),
                     element("name", text["title"], "<{} />"), element("price", price, "<{} />"), F.lit("</offer>"))
    position = F.col(order_by) if order_by else offer
    picked = df if rows is None else df.orderBy(order_by).limit(rows)
    picked = picked.select(position.alias("position"), text["mercant_name"].alias("name"),
                           text["mercant_id"].alias("company"), offer.alias("value"))
    whole = picked.agg(F.count(F.lit(1)).alias("offers"),
                       F.min(F.struct("position", "name", "company", "value")).alias("first")).first()
    if not whole.offers:
        return None
    fragments = -(-whole.offers // max_offers)
    first = {c: F.lit(whole["first"][c]).cast("string") for c in ("name", "company")}
    opening = F.concat(F.lit("<?xml version='1.0' encoding='utf-8'?>\n"),
                       F.lit(f'<yml_catalog date="{generated_at.isoformat()}"><shop>'),
                       element("name", first["name"], "<{} />"), element("company", first["company"], "<{} />"),
                       F.lit("<categories /><offers>"))
    none = F.lit(None).cast(picked.schema["position"].dataType).alias("position")
    numbers = df.sparkSession.range(fragments).withColumnRenamed("id", "fragment")
    body = picked.select(F.pmod(F.xxhash64("position", "value"), F.lit(fragments)).alias("fragment"),
                         F.lit(1).alias("kind"), "position", "value")
    return (body.unionByName(numbers.select("fragment", F.lit(0).alias("kind"), none, opening.alias("value")))
            .unionByName(numbers.select("fragment", F.lit(2).alias("kind"), none,
                                        F.lit("</offers></shop></yml_catalog>").alias("value"))))
