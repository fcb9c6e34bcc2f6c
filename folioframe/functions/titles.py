"""Titles, notes, rights and dates as they are printed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import FIXED_008_TAIL


def clean_title(title: Column) -> Column:
    """Trimmed, with the white space around each line break removed."""
    return F.regexp_replace(F.regexp_replace(title, r"^\s+|\s+$", ""), r"\s*\n\s*", "\n")


def main_title(title: Column) -> Column:
    """First line; ` :` follows it when a remainder does."""
    first = F.substring_index(title, "\n", 1)
    return F.when(title.contains("\n"), F.concat(first, F.lit(" :"))).otherwise(title)


def rest_of_title(title: Column) -> Column:
    """Lines after the first, joined by spaces; null if there is one line only."""
    rest = F.substr(title, F.instr(title, "\n") + 1)
    return F.when(title.contains("\n"), flatten(rest))


def flatten(note: Column) -> Column:
    return F.replace(note, F.lit("\n"), F.lit(" "))


def rights_flag(rights: Column) -> Column:
    """1 for copyrighted books, else the text as it is."""
    return F.when(F.lower(rights).contains("copyright"), F.lit("1")).otherwise(rights)


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def fixed_field_008(asof: str, released: Column, published: Column) -> Column:
    """Run date, `r`, release year, year of the original or four bars, then the constant tail."""
    run_day = F.date_format(F.lit(asof).cast("date"), "yyMMdd")
    return F.concat(run_day, F.lit("r"), F.date_format(released, "yyyy"), F.coalesce(published, F.lit("||||")), F.lit(FIXED_008_TAIL))


def pretty_title(title: Column, authors: Column, room: int) -> Column:
    """`title by a, b` on one line; cut to `room` characters, the last one an ellipsis."""
    whole = flatten(F.when(F.coalesce(authors, F.lit("")) != "", F.concat(title, F.lit(" by "), authors)).otherwise(title))
    return F.when(F.length(whole) > room, F.concat(F.substring(whole, 1, room - 1), F.lit("…"))).otherwise(whole)
