"""Accepted sales files to one typed sales fact."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.contract import EXTRA_COLUMN, FACT_SCHEMA, MANDATORY_COLUMNS, UNPARSED, UNPARSED_TYPE
from martweave.functions.sales import extras_map, field, fold_extras, money, whole_number
from martweave.sources.landing import metadata_path, reader_path


def empty_fact(spark: SparkSession) -> DataFrame:
    """The fact without rows: the seed of the union."""
    return spark.createDataFrame([], FACT_SCHEMA)


def conform(raw: DataFrame, names: list[str]) -> DataFrame:
    """Text columns of one header to the fact schema, by name.

    Text that is no number or date becomes NULL, and is kept with its column in
    ``unparsed``; blank cells are missing values, not unparsed ones. Columns outside
    the contract are folded into ``extra_column`` in header order, and kept with
    their names in ``extra_map``.
    """
    casts = {T.LongType: whole_number, T.DateType: lambda c: c.try_cast("date"), T.DecimalType: money}
    extras = [n for n in names if n not in MANDATORY_COLUMNS]
    typed = raw.select(
        *[casts.get(type(FACT_SCHEMA[c].dataType), lambda c: c)(field(c)).alias(c) for c in MANDATORY_COLUMNS],
        *[field(c).alias(_text(c)) for c in MANDATORY_COLUMNS],
        fold_extras(extras).alias(EXTRA_COLUMN),
        extras_map(extras).alias("extra_map"),
        metadata_path().alias("source_file"),
    )
    return typed.select(
        *MANDATORY_COLUMNS, EXTRA_COLUMN, "extra_map", "source_file", unparsed_of(MANDATORY_COLUMNS).alias(UNPARSED)
    )


def _text(column: str) -> str:
    return f"text of {column}"


def unparsed_of(columns: list[str]) -> Column:
    """The cells that hold text (beside the typed column) where the typed value is NULL; NULL when there is none.

    They are listed for the rows that have one only: most rows have none, and the list is not compiled.
    """
    unread = {c: F.col(c).isNull() & F.col(_text(c)).rlike(r"[^\x00-\x20]") for c in columns}
    cells = F.array(
        *[F.when(u, F.struct(F.lit(c).alias("column"), F.col(_text(c)).alias("text"))) for c, u in unread.items()]
    )
    found = F.filter(cells, lambda cell: cell.isNotNull())
    return F.when(reduce(lambda a, b: a | b, unread.values()), found).cast(UNPARSED_TYPE)


def unparsed_cells(fact: DataFrame) -> DataFrame:
    """One row per cell that did not parse: the fact's columns, then ``column`` and ``text``."""
    return fact.where(F.col(UNPARSED).isNotNull()).select(
        *[c for c in fact.columns if c != UNPARSED], F.inline(UNPARSED)
    )


def read_sales(spark: SparkSession, accepted: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Union by name of all accepted files, one CSV scan per distinct header.

    Files are grouped by header line because Spark binds CSV columns by
    position. The plan grows with the number of headers, not of files. The paths
    come to the driver, which lists them for every scan anyway. ``keep`` adds
    ``extra_map``, ``source_file`` or ``unparsed`` to the nine fact columns.
    """
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row in accepted.select("columns", "path").toLocalIterator():
        groups[tuple(row["columns"])].append(reader_path(row["path"]))
    parts = [empty_fact(spark)]
    for names, paths in sorted(groups.items()):
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        raw = spark.read.schema(schema).option("header", "true").csv(sorted(paths))
        parts.append(conform(raw, list(names)).select(*FACT_SCHEMA.names, *keep))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=bool(keep)), parts)
