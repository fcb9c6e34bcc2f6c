"""Every registered query with its check."""

from __future__ import annotations

from importlib import import_module

from ..adapters import Catalog
from .base import Entry, printable

_MODULES = ("selection", "planning", "feeds", "metadata", "text", "outbox", "stores", "streams")


def entries() -> dict[str, Entry]:
    found: dict[str, Entry] = {}
    for name in _MODULES:
        found.update(import_module(f"{__name__}.{name}").ENTRIES)
    return found


def runner(entry: Entry):
    def run(spark, folder):
        return printable(entry.run(Catalog(spark, folder)))

    return run
