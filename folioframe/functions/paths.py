"""File paths and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import PARSEABLE_EXTENSIONS


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dir_name(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def extension(path: Column) -> Column:
    """`.ext` of the last path part; a name that only starts with a dot has none."""
    return F.regexp_extract(path, r"(?:^|/)\.*[^./][^/]*?(\.[^./]*)$", 1)


def stem(path: Column) -> Column:
    return F.substr(path, F.lit(1), F.length(path) - F.length(extension(path)))


def include_glob(path: Column) -> Column:
    return F.concat(dir_name(path), F.lit("/*"))


def archive_dir(book: Column) -> Column:
    """One directory per digit but the last, then the number: 64156 lives in 6/4/1/5/64156."""
    digits = book.cast("string")
    lead = F.regexp_replace(F.substr(digits, F.lit(1), F.length(digits) - 1), "(.)", "$1/")
    return F.concat(F.when(book < 10, "0/").otherwise(lead), digits)


def shelf_path(path: Column, book: Column) -> Column:
    """Archive path as the converters address it: by number, or under `dirs/` for the oldest books."""
    home = archive_dir(book)
    at_home = (F.substring(path, 2, 1) == "/") & path.startswith(home)  # such a directory starts with one digit
    by_number = F.replace(path, home, F.concat(F.lit("files/"), book.cast("string")))
    return F.when(at_home, by_number).when(path.startswith("etext"), F.concat(F.lit("dirs/"), path)).otherwise(path)


def root_kind(path: Column) -> Column:
    """Which root a stored path hangs under; the first rule that fits wins."""
    return (
        F.when(path.startswith("/"), "absolute")
        .when(path.startswith("cache"), "public")
        .when(path.startswith("dirs"), "public")
        .when(path.rlike("^[0-9][0-9]"), "files")
        .otherwise("dirs")
    )


def resolved_path(path: Column, public_dir: str) -> Column:
    """Full path of a stored path."""
    under = lambda root: F.concat(F.lit(f"{public_dir}/{root}"), path)
    return (
        F.when(path.startswith("/"), path)
        .when(path.startswith("cache") | path.startswith("dirs"), under(""))
        .when(path.rlike("^[0-9][0-9]"), under("files/"))
        .otherwise(under("dirs/"))
    )


def is_parseable(path: Column) -> Column:
    return extension(path).isin(*PARSEABLE_EXTENSIONS)


def is_readable(path: Column) -> Column:
    return ~path.contains("/.")


def metadata_key(path: Column) -> Column:
    """Sort key: files with the best metadata first, `-z` puts plain ASCII texts behind their variants."""
    place = F.array_position(F.lit(list(PARSEABLE_EXTENSIONS)), extension(path)) - 1
    ranked = F.concat(F.lpad(place.cast("string"), 2, "0"), F.lit(" "), stem(path))
    return F.concat(F.when(is_parseable(path), ranked).otherwise(F.concat(F.lit("99"), stem(path))), F.lit("-z"))


def join_url(base: Column, relative: Column) -> Column:
    """Relative reference against a base directory, with `.` and `..` steps resolved."""
    joined = (
        F.when(relative.rlike("^[a-z][a-z0-9+.-]*:"), relative)
        .when(relative.startswith("/"), relative)
        .otherwise(F.concat(F.regexp_extract(base, "^(.*/)", 1), relative))
    )

    def step(done: Column, part: Column) -> Column:
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == ".", done).when(part == "..", shorter).otherwise(F.concat(done, F.array(part)))

    parts = F.split(joined, "/")
    has_steps = joined.contains("/./") | joined.contains("/../") | joined.endswith("/.") | joined.endswith("/..")
    walked = F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), F.slice(parts, 1, 1), step)
    return F.when(has_steps, F.array_join(walked, "/")).otherwise(joined)
