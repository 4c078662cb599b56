"""Bring a DataFrame to a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.session import require

MODES = ("strict", "permissive")


def sanitize(schema: T.StructType) -> T.StructType:
    """Make every field nullable and give untyped fields and untyped lists the type string."""
    def typed(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.NullType):
            return T.StringType()
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NullType):
            return T.ArrayType(T.StringType(), True)
        return kind
    return T.StructType([T.StructField(f.name, typed(f.dataType), True) for f in schema])


def _same_shape(source: T.DataType, target: T.DataType) -> bool:
    """True when nested types differ only in the types of their leaves."""
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        return source.names == target.names and all(
            _same_shape(s.dataType, t.dataType) for s, t in zip(source, target))
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return _same_shape(source.elementType, target.elementType)
    nested = (T.StructType, T.ArrayType, T.MapType)
    return not isinstance(source, nested) and not isinstance(target, nested)


def _flat(kind: T.DataType) -> bool:
    """A struct of plain values."""
    return isinstance(kind, T.StructType) and not any(
        isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType, T.NullType)) for f in kind)


def _fit_items(value: Column, source: T.StructType, target: T.StructType, item_by_item: Column) -> Column:
    """A list of flat structs with its fields in another order or number, put together from lists of each field.

    That is generated code, which ``item_by_item`` is not, but it would make NULL items structs of NULLs. A search
    for such a struct finds one, or tells by its NULL that there are NULL items: those lists go item by item.
    """
    have = {f.name: f.dataType for f in source}
    nulls = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in source])
    lists = [value.getField(f.name).cast(T.ArrayType(f.dataType)) if f.name in have
             else F.array_repeat(F.lit(None).cast(f.dataType), F.size(value)) for f in target]
    return F.when(~F.array_contains(value, nulls), F.arrays_zip(*lists).cast(T.ArrayType(target))).otherwise(item_by_item)


def _fit(value: Column, source: T.DataType, target: T.DataType, mode: str, where: str) -> Column:
    """``value`` as ``target``; struct fields pair by name at every depth."""
    if source == target:
        return value
    if mode == "strict" and _same_shape(source, target):
        # One cast of the whole value, which stays in generated code.
        return value.cast(target)
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        have = {f.name: f.dataType for f in source}
        fields = [
            (_fit(value.getField(f.name), have[f.name], f.dataType, mode, f"{where}.{f.name}")
             if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        fitted = F.transform(value, lambda item: _fit(item, source.elementType, target.elementType, mode, f"{where}[]"))
        if mode == "strict" and _flat(source.elementType) and _flat(target.elementType) \
                and set(source.elementType.names) & set(target.elementType.names):
            return _fit_items(value, source.elementType, target.elementType, fitted)
        return fitted
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(source, nested) or isinstance(target, nested):
        if not isinstance(source, T.NullType):
            raise TypeError(f"{where}: cannot turn {source.simpleString()} into {target.simpleString()}")
        return F.lit(None).cast(target)
    return value.cast(target) if mode == "strict" else value.try_cast(target)


def _fitted(df: DataFrame, schema: T.StructType, mode: str) -> list[Column]:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "strict":
        require(df.sparkSession, "spark.sql.ansi.enabled")
    have = {f.name: f.dataType for f in df.schema}
    return [
        (_fit(F.col(f"`{f.name}`"), have[f.name], f.dataType, mode, f.name)
         if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in sanitize(schema)
    ]


def conform(df: DataFrame, schema: T.StructType, mode: str = "strict", keep: tuple[str, ...] = ()) -> DataFrame:
    """Add missing columns as typed NULL, drop extra ones, reorder, cast; one projection.

    ``strict`` raises on a value that cannot be cast, ``permissive`` makes it NULL (count those
    with ``conform_losses``). Columns in ``keep``, such as the partition day, stay in front.
    """
    return df.select(*keep, *_fitted(df, schema, mode))


def _losses(value: Column, source: T.DataType, target: T.DataType, where: str) -> list[tuple[str, Column]]:
    """For each leaf below ``value`` its path and how many of its values one row loses."""
    if isinstance(target, T.StructType) and isinstance(source, T.StructType):
        have = {f.name: f.dataType for f in source}
        return [found for f in target if f.name in have
                for found in _losses(value.getField(f.name), have[f.name], f.dataType, f"{where}.{f.name}")]
    if isinstance(target, T.ArrayType) and isinstance(source, T.ArrayType):
        def leaves(item: Column) -> list[tuple[str, Column]]:
            return _losses(item, source.elementType, target.elementType, f"{where}[]")

        def total(number: int) -> Column:
            return F.aggregate(value, F.lit(0).cast("long"), lambda sum_, item: sum_ + leaves(item)[number][1])
        return [(path, F.coalesce(total(i), F.lit(0).cast("long"))) for i, (path, _) in enumerate(leaves(F.lit(None)))]
    if source == target or isinstance(source, T.NullType):
        return [(where, F.lit(0).cast("long"))]
    return [(where, (value.isNotNull() & value.try_cast(target).isNull()).cast("long"))]


def loss_counts(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """For each leaf that source and schema share, by its path, the aggregate that counts the values
    a permissive conform turns into NULL: ``a``, ``s.a`` in a struct, ``l[].a`` in the items of a list."""
    _fitted(df, schema, "permissive")  # raises on shapes that do not go together
    have = {f.name: f.dataType for f in df.schema}
    return {path: F.coalesce(F.sum(lost), F.lit(0).cast("long"))
            for f in sanitize(schema) if f.name in have
            for path, lost in _losses(F.col(f"`{f.name}`"), have[f.name], f.dataType, f.name)}


def lost_leaf(df: DataFrame, schema: T.StructType) -> Column:
    """The path of the first leaf, in the order of the schema, of which a permissive conform of the row makes
    a value NULL; NULL where all values fit."""
    _fitted(df, schema, "permissive")  # raises on shapes that do not go together
    have = {f.name: f.dataType for f in df.schema}
    lost = [F.when(count > 0, F.lit(path)) for f in sanitize(schema) if f.name in have
            for path, count in _losses(F.col(f"`{f.name}`"), have[f.name], f.dataType, f.name)]
    return F.coalesce(*lost, F.lit(None).cast("string"))


def conform_losses(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per leaf, nested ones included, how many values a permissive conform turns into NULL."""
    counts = loss_counts(df, schema)
    if not counts:
        return df.sparkSession.createDataFrame([], "column string, nulled long")
    row = df.agg(*[count.alias(f"n{i}") for i, count in enumerate(counts.values())])
    pairs = F.array(*[F.struct(F.lit(path).alias("column"), F.col(f"n{i}").alias("nulled"))
                      for i, path in enumerate(counts)])
    return row.select(F.inline(pairs))
