"""Backlog posting at a fixed pace: which book is due at an instant, and when a book is due."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import BACKLOG_SECONDS


def _seconds(instant: Column) -> Column:
    return F.unix_micros(instant.cast("timestamp")) / 1_000_000


def due_book(at: Column, start: str, first_book: int) -> Column:
    passed = _seconds(at) - _seconds(F.lit(start).cast("timestamp_ntz"))
    return (F.lit(first_book) + F.floor(passed / BACKLOG_SECONDS)).cast("bigint")


def due_time(book: Column, start: str, first_book: int) -> Column:
    seconds = ((book - first_book) * BACKLOG_SECONDS).cast("bigint")
    return F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
