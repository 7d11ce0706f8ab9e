"""Text to typed values, unparsable text becoming NULL (the row is kept)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.compare import quoted


def typed(c: Column, data_type: T.DataType, date_format: str | None = None, timestamp_format: str | None = None) -> Column:
    if isinstance(data_type, T.DateType) and date_format:
        return F.try_to_date(c, date_format)
    if isinstance(data_type, T.TimestampType) and timestamp_format:
        return F.try_to_timestamp(c, F.lit(timestamp_format))
    return c.try_cast(data_type)


def parse_text(df: DataFrame, schema: T.StructType, date_format: str | None = None, timestamp_format: str | None = None) -> DataFrame:
    """Type the text columns named by `schema`; other columns pass through."""
    return df.withColumns(
        {f.name: typed(quoted(f.name), f.dataType, date_format, timestamp_format) for f in schema.fields}
    )
