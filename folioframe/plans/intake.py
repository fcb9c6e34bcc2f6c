"""Metadata intake: submissions, text headers, the fill-if-empty merge, contacts and credits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import CREDIT_CODE, HTML_EXTENSIONS
from ..functions.paths import base_name, extension, is_parseable, metadata_key
from ..functions.submissions import list_at, normal_email, publication_events, text_at
from ..functions.texts import header_fields, html_body_text
from ..operators.candidates import best_sources
from ..operators.ranking import order_key, skew_safe_rank
from ..operators.scans import scan_attributes
from ..profile import DEFAULT, LibraryProfile

BACKUP_SLOTS = 10


def workflow_records(files: DataFrame) -> DataFrame:
    """Fields of submissions from rows (ebook, text, ...); `valid` is false for text that is no JSON object with DATA."""
    record = F.try_parse_json(F.col("text"))
    data = lambda name: text_at(F.col("_record"), f"$.DATA.{name}")
    parsed = files.withColumn("_record", record)
    return parsed.select(
        *[c for c in files.columns if c != "text"],
        F.try_variant_get("_record", "$.DATA", "variant").isNotNull().alias("valid"),
        data("TITLE").alias("title"),
        data("LANGUAGE").alias("language"),
        data("PUBLISHER").alias("publisher"),
        data("PUBLISHER_COUNTRY").alias("country"),
        publication_events(list_at(F.col("_record"), "$.DATA.SOURCE_PUBLICATION_YEARS")).alias("years"),
        list_at(F.col("_record"), "$.DATA.SCANS_ARCHIVE_URL").alias("scan_urls"),
        data("REQUEST_KEY").alias("request_key"),
        data("CREDIT").alias("credit"),
        data("NOTIFY").alias("notify"),
        data("WW").alias("ww"),
    )


def merge_workflow(meta: DataFrame, records: DataFrame) -> DataFrame:
    """Fills what the catalog lacks from a submission. Unknown books are ignored.

    Publication data comes as a whole, only if there is none; the language only with it, and only
    over none or `en`. Of several submissions of a book the newest form counts, as `pick_newest` ranks paths (or the
    last in order of its content where records have no path), so that a book has one row.
    """
    fields = ("language", "publisher", "country", "years", "scan_urls", "request_key", "credit")
    newest = (submission_rank(F.col("path"), F.col("ebook")), F.col("path")) if "path" in records.columns else ()
    order = F.struct(*newest, *fields)
    picked = records.filter("valid").groupBy(F.col("ebook").alias("pk")).agg(F.max_by(F.struct(*fields), order).alias("new"))
    sub = picked.select("pk", *[F.col(f"new.{c}").alias(f"new_{c}") for c in fields])
    has_pub = F.coalesce(F.nullif(F.col("publisher"), F.lit("")), F.nullif(F.col("country"), F.lit(""))).isNotNull()
    given = lambda name: F.nullif(F.col(f"new_{name}"), F.lit(""))
    lang_open = ~has_pub & (F.col("first_language").isNull() | (F.col("first_language") == "en"))
    fills: dict[str, Column] = {
        "language": F.when(lang_open, given("language")),
        "publisher": F.when(~has_pub, given("publisher")),
        "country": F.when(~has_pub, given("country")),
        "years": F.when(~has_pub & (F.size("new_years") > 0), F.col("new_years")),
        "scan_urls": F.when(F.col("scan_url").isNull(), F.col("new_scan_urls")),
        "request_key": F.when(F.nullif(F.col("request_key"), F.lit("")).isNull(), given("request_key")),
        "credit": F.when(F.nullif(F.col("credit"), F.lit("")).isNull(), given("credit")),
    }
    joined = meta.join(sub, "pk")
    filled = joined.select("pk", *[column.alias(name) for name, column in fills.items()])
    return filled.withColumn("changed", F.coalesce(*[F.when(F.col(n).isNotNull(), True) for n in fills], F.lit(False)))


def submission_rank(path: Column, ebook: Column) -> Column:
    """The newest form of a submission ranks highest: the current file, a plain text note, backups
    9 to 0, the first backup. Null for other names."""
    name, number = base_name(path), ebook.cast("string")
    in_backup = path.contains("/backup/")
    revision = F.regexp_extract(name, r"\.json\.([0-9])$", 1).try_cast("int")
    current = F.when(name == F.concat(number, F.lit(".json")), 100).when(name == F.concat(number, F.lit(".txt")), 99)
    backup = F.when(name == F.concat(number, F.lit(".json")), 1).when(name.startswith(F.concat(number, F.lit("."))), revision + 10)
    return F.when(in_backup, backup).otherwise(current)


def pick_newest(submissions: DataFrame) -> DataFrame:
    ranked = submissions.withColumn("_rank", submission_rank(F.col("path"), F.col("ebook"))).filter(F.col("_rank").isNotNull())
    best = F.max_by(F.struct("path", "content"), "_rank").alias("best")
    return ranked.groupBy("ebook").agg(best).select("ebook", "best.*")


def reload_workflow(submissions: DataFrame) -> DataFrame:
    """The newest submission of each book as metadata to overwrite with; `valid` is false where it cannot be read."""
    newest = pick_newest(submissions)
    return workflow_records(newest.select("ebook", "path", F.col("content").alias("text")))


def assign_revisions(arrivals: DataFrame, existing: DataFrame) -> DataFrame:
    """A backup slot for each arriving file: the plain name (-1) if free, then revisions 0 to 9.

    Arrivals beyond the free slots get none and are not archived. `arrivals` is (name, seq),
    `existing` is (name, slot).
    """
    slots = F.sequence(F.lit(-1), F.lit(BACKUP_SLOTS - 1))
    used = existing.groupBy("name").agg(F.collect_set("slot").alias("_used"))  # eleven values at most
    order = order_key([(F.col("seq"), False, False)], F.lit(0))
    ranked = skew_safe_rank(arrivals, ["name"], order, "_nth")
    free = F.array_except(slots, F.coalesce("_used", F.array().cast("array<int>")))
    slot = F.get(free, (F.col("_nth") - 1).cast("int"))
    return ranked.join(used, "name", "left").select("name", "seq", slot.alias("slot"))


def contacts(records: DataFrame, profile: LibraryProfile = DEFAULT) -> DataFrame:
    """Addresses a submission names: the submitter's and the manager's."""
    pairs = F.array(
        F.struct(F.lit("notify").alias("role"), F.col("notify").alias("_email")),
        F.struct(F.lit("ww").alias("role"), F.col("ww").alias("_email")),
    )
    long = records.select("ebook", F.inline(pairs))
    return long.select("ebook", "role", normal_email(F.col("_email"), profile).alias("email")).filter(F.col("email").isNotNull())


def address_book(emails: DataFrame, profile: LibraryProfile = DEFAULT) -> DataFrame:
    """Latest address per (book, role) from rows (seq, ebook, role, email); entries without a number or address do not count."""
    clean = emails.select(
        "seq", F.col("ebook").try_cast("bigint").alias("ebook"), "role", normal_email(F.col("email"), profile).alias("email")
    ).filter(F.col("ebook").isNotNull() & F.col("email").isNotNull())
    return clean.groupBy("ebook", "role").agg(F.max_by("email", "seq").alias("email"))


def address_map(book: DataFrame) -> DataFrame:
    """The nested view: book to (role to address). A book has a handful of roles."""
    return book.groupBy("ebook").agg(F.map_from_entries(F.collect_list(F.struct("role", "email"))).alias("addresses"))


def header_rows(files: DataFrame) -> DataFrame:
    """Header fields of each parseable file of (ebook, path, text); the text itself is dropped here."""
    ext = extension(F.col("path"))
    readable = F.when(ext.isin(*HTML_EXTENSIONS), html_body_text(F.col("text"))).otherwise(F.col("text"))
    parsed = files.filter(is_parseable(F.col("path"))).withColumn("_readable", readable)
    fields = [column.alias(name) for name, column in header_fields(F.col("_readable")).items()]
    return parsed.select("ebook", "path", metadata_key(F.col("path")).alias("sort_key"), *fields)


def check_trigger(headers: DataFrame) -> DataFrame:
    """Whether the id in a header is the id of its folder."""
    status = (
        F.when(F.col("book_id") == F.col("ebook"), "match").when(F.col("book_id").isNotNull(), "mismatch").otherwise("no id")
    )
    return headers.withColumn("status", status)


def best_headers(headers: DataFrame) -> DataFrame:
    """The first file, best metadata first, whose id is right."""
    fields = F.struct("path", "title", "authors", "released", "language", "credit")
    right = check_trigger(headers).filter(F.col("status") == "match")
    return right.groupBy("ebook").agg(F.min_by(fields, F.struct("sort_key", "path")).alias("best")).select("ebook", "best.*")


def intake(triggers: DataFrame, records: DataFrame, files: DataFrame) -> DataFrame:
    """Metadata per trigger: a valid submission wins, else the best header; otherwise nothing was found."""
    subs = records.filter("valid").select("ebook", F.col("title").alias("s_title"), F.col("language").alias("s_language"), F.col("credit").alias("s_credit"), F.lit(True).alias("_sub"))
    joined = triggers.join(subs, "ebook", "left").join(best_headers(header_rows(files)), "ebook", "left")
    has_sub = F.coalesce("_sub", F.lit(False))
    choose = lambda a, b: F.when(has_sub, F.col(a)).otherwise(F.col(b))
    origin = F.when(has_sub, "workflow").when(F.col("path").isNotNull(), "header").otherwise("none")
    return joined.select(
        "ebook",
        origin.alias("origin"),
        F.when(~has_sub, F.col("path")).alias("path"),
        choose("s_title", "title").alias("title"),
        choose("s_language", "language").alias("language"),
        choose("s_credit", "credit").alias("credit"),
    )


UPDATED_PREFIX = "Updated:"


def longest_credits(attributes: DataFrame) -> DataFrame:
    """Length of the longest credit of each book, update notes aside."""
    own = scan_attributes(attributes, CREDIT_CODE).filter(~F.col("text").startswith(UPDATED_PREFIX))
    return own.groupBy("fk_books").agg(F.max(F.length("text")).alias("longest"), F.count(F.lit(1)).alias("n_credits"))


def credits_to_delete(attributes: DataFrame) -> DataFrame:
    """Update notes, and credits shorter than the longest of their book."""
    credits = scan_attributes(attributes, CREDIT_CODE).join(longest_credits(attributes), "fk_books", "left")
    update = F.col("text").startswith(UPDATED_PREFIX)
    shorter = F.coalesce(F.length("text") < F.col("longest"), F.lit(False))
    return credits.filter(update | shorter).select(*attributes.columns, F.when(update, "update note").otherwise("shorter").alias("why"))


def creditless(attributes: DataFrame) -> DataFrame:
    """Books with attributes but no credit, newest first."""
    with_credit = scan_attributes(attributes, CREDIT_CODE).select("fk_books")
    return attributes.select("fk_books").distinct().join(with_credit, "fk_books", "left_anti").orderBy(F.desc("fk_books"))


def fill_credits(attributes: DataFrame, categories: DataFrame, cands: DataFrame, texts: DataFrame) -> DataFrame:
    """Credits to add for creditless text books, read from the text of the best source: `texts` is (fk_books, path, raw)."""
    sources = best_sources(cands).select("fk_books", F.coalesce("html_first", "text_first").alias("source"))
    open_books = creditless(attributes).join(categories.select("fk_books"), "fk_books", "left_anti")
    chosen = open_books.join(sources.filter(F.col("source").isNotNull()), "fk_books")
    credit = header_fields(F.col("raw"))["credit"]
    found = texts.select("fk_books", F.col("path").alias("_path"), credit.alias("text")).filter(F.col("text") != "")
    keyed = chosen.withColumn("_path", F.col("source.archive_path")).join(found, ["fk_books", "_path"])
    return keyed.select("fk_books", F.lit(CREDIT_CODE).alias("fk_attriblist"), "text", F.col("source.archive_path").alias("source_path"))
