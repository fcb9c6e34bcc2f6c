"""Shared pieces of the query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..adapters import Catalog

ASOF = "2001-11-05 00:00:00"
EVENTS_ASOF = "2024-01-31 00:00:00"


@dataclass(frozen=True)
class Entry:
    run: Callable[[Catalog], DataFrame]
    sql: str | None = None


def printable(df: DataFrame) -> DataFrame:
    """Dates and instants as text, so that both engines show them the same way."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)
