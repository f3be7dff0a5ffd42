"""Edge conversion: results leave the library with DATE/INT/BIGINT/DOUBLE/STRING columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast every DECIMAL column to DOUBLE (the last step, after all rounding)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])
