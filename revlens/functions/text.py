"""Text comparison with the case rules of the source reports.

Their engines compare text without case, Spark with it. Two tools:

* :func:`equals_ci` for one predicate;
* collated columns (:func:`caseless`) for grouping, joining, ranking and
  filtering: every comparison of such a column ignores case, in operators that
  know nothing of it.

What a collation costs, as ``explain()`` shows it: a filter on a collated column
is not pushed to the scan (no row group is skipped), a grouping by one sorts
instead of hashing, and a join compares collation keys. So facts are filtered
and summed by their codes first, and only dimension attributes are collated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

CASELESS = "UTF8_LCASE"
PLAIN = "UTF8_BINARY"


def equals_ci(col: Column | str, value: str) -> Column:
    """Case-insensitive equality (report engines compare text this way)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(c) == F.lit(value.lower())


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def caseless(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``df`` with its text columns (or the given ones) collated to ignore case."""
    columns = text_columns(df) if columns is None else columns
    return df.withColumns({c: F.collate(c, CASELESS) for c in columns})


def plain(df: DataFrame) -> DataFrame:
    """``df`` with all text columns compared byte by byte again (as files and other engines expect)."""
    return df.withColumns({c: F.collate(c, PLAIN) for c in text_columns(df)})


def one_spelling(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``df`` with the spellings of a text that differ in case replaced by the first of them in byte order.

    For dimension tables: the spellings of a column are grouped (one row a
    spelling, with map-side aggregation) and joined back, so a value that most
    rows share gathers nowhere.
    """
    columns = text_columns(df) if columns is None else columns

    def respell(out: DataFrame, c: str) -> DataFrame:
        spellings = df.select(F.collate(c, PLAIN).alias("__old")).where(F.col("__old").isNotNull()).distinct()
        own = Window.partitionBy(F.collate("__old", CASELESS))
        spellings = spellings.withColumn("__new", F.min("__old").over(own))
        joined = out.join(spellings, F.collate(out[c], PLAIN) == F.col("__old"), "left")
        return joined.withColumn(c, F.col("__new")).select(*out.columns)

    return reduce(respell, columns, df)
