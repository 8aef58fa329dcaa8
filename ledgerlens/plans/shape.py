"""Presentation of result frames: rounded doubles, text timestamps, wide integers."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T


def shape(df: DataFrame, digits: dict | None = None, default: int = 6) -> DataFrame:
    digits = digits or {}
    out = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = F.round(column.cast("double"), digits.get(field.name, default))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        out.append(column.alias(field.name))
    return df.select(*out)
