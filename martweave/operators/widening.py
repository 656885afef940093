"""Types of extra columns, found from their text and widened over files.

A column's candidates are the types that every one of its values parses as, so
candidates of several files are combined by intersection and the result does not
depend on their order. The narrowest candidate is the column's type:
bigint, double, date, timestamp, boolean, and string, which everything parses as.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.functions.sales import field

TEXT_TYPE = "string"
# From narrow to wide: the type, and what text has to look like besides being castable.
_SHAPES = {
    "bigint": r"^[+-]?[0-9]+$",
    "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$",
    "boolean": r"^(?i)(true|false)$",
}
# Whole numbers beyond this are not exact as double, so they never become one.
_EXACT_IN_DOUBLE = 1 << 53


def _value(text: Column) -> Column:
    return F.trim(text)


def _parses(text: Column, kind: str) -> Column:
    fits = text.rlike(_SHAPES[kind]) & text.try_cast(kind).isNotNull()
    if kind == "double":
        fits &= ~text.rlike(_SHAPES["bigint"]) | (F.abs(text.try_cast("decimal(38,0)")) <= _EXACT_IN_DOUBLE)
    return F.coalesce(fits, F.lit(False))


def candidates(sales: DataFrame, by: tuple[str, ...] = ("source_file",)) -> DataFrame:
    """``by, name`` and per type whether every value of the extra column has it, from ``sales(extra_map)``.

    NULL and blank cells say nothing, so a column without values has all candidates. One
    aggregate with one row per file and column.
    """
    cells = sales.select(*by, F.explode("extra_map").alias("name", "text")).withColumn("text", _value(F.col("text")))
    has = [
        F.coalesce(F.every(F.when(F.col("text") != "", _parses(F.col("text"), kind))), F.lit(True)).alias(kind)
        for kind in _SHAPES
    ]
    return cells.groupBy(*by, "name").agg(*has, F.count(F.when(F.col("text") != "", 1)).alias("values"))


def widened(of_files: DataFrame) -> DataFrame:
    """``name, type`` of every extra column over all files of ``candidates``."""
    folded = of_files.groupBy("name").agg(*[F.every(kind).alias(kind) for kind in _SHAPES], F.sum("values").alias("values"))
    narrowest = F.coalesce(*[F.when(F.col(kind), F.lit(kind)) for kind in _SHAPES], F.lit(TEXT_TYPE))
    return folded.select("name", F.when(F.col("values") > 0, narrowest).otherwise(TEXT_TYPE).alias("type"))


def typed_extras(sales: DataFrame, types: DataFrame) -> DataFrame:
    """``sales`` with ``extras``, a struct of typed columns, in place of ``extra_map``.

    ``types(name, type)`` comes to the driver: one row per extra column of the headers.
    A string keeps its text as it is; blank cells of other types are NULL, and so is text that does
    not parse as a type the caller gives. Names that differ only in case get a number.
    Without extra columns the struct is NULL.
    """
    fields, taken = [], {}
    for name, kind in sorted((r["name"], r["type"]) for r in types.collect()):
        taken[name.lower()] = taken.get(name.lower(), 0) + 1
        shown = name if taken[name.lower()] == 1 else f"{name}_{taken[name.lower()]}"
        text = F.try_element_at("extra_map", F.lit(name))
        value = text if kind == TEXT_TYPE else _value(text).try_cast(kind)
        fields.append(value.alias(shown))
    extras = F.when(F.col("extra_map").isNotNull(), F.struct(*fields)) if fields else F.lit(None).cast("struct<>")
    return sales.select(*[field(c) for c in sales.columns if c != "extra_map"], extras.alias("extras"))
