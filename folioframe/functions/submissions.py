"""Fields of workflow submissions: JSON whose values are sometimes a string and sometimes a list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profile import DEFAULT, LibraryProfile


def text_at(record: Column, path: str) -> Column:
    return F.try_variant_get(record, path, "string")


def list_at(record: Column, path: str) -> Column:
    """A string becomes a list of one; absent and empty values become null."""
    many = F.try_variant_get(record, path, "array<string>")
    one = F.nullif(F.try_variant_get(record, path, "string"), F.lit(""))
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)))


def publication_events(years: Column) -> Column:
    """`event:year` pairs; a bare year is a copyright year; more than one colon is no pair."""
    def pair(item: Column) -> Column:
        bare = F.struct(F.lit("copyright").alias("event"), item.alias("year"))
        both = F.struct(F.substring_index(item, ":", 1).alias("event"), F.substring_index(item, ":", -1).alias("year"))
        colons = F.length(item) - F.length(F.replace(item, F.lit(":"), F.lit("")))
        return F.when(colons == 0, F.when(item != "", bare)).when(colons == 1, both)

    return F.array_compact(F.transform(years, pair))


def events_text(events: Column) -> Column:
    return F.array_join(F.transform(events, lambda e: F.concat(e["event"], F.lit("="), e["year"])), ";")


def normal_email(email: Column, profile: LibraryProfile = DEFAULT) -> Column:
    """Null for no address; a bare user name gets the library's domain."""
    given = F.nullif(email, F.lit(""))
    return F.when(given.contains("@"), given).otherwise(F.concat(F.trim(given), F.lit("@" + profile.mail_domain)))
