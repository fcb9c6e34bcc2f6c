"""Announcements and notices: what is due, to whom, in which words. Sending is left to the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import POST_FROM, POST_TITLE_ROOM
from ..functions.titles import pretty_title
from ..profile import DEFAULT, LibraryProfile


def post_candidates(books: DataFrame, first_books: dict[str, int] = POST_FROM) -> DataFrame:
    """(book, medium) pairs new enough for the medium."""
    media = F.array_compact(F.array(*[F.when(F.col("pk") >= low, F.lit(m)) for m, low in first_books.items()]))
    return books.select("*", F.explode(media).alias("media"))


def unposted(pairs: DataFrame, posts: DataFrame) -> DataFrame:
    done = posts.select(F.col("fk_books").alias("pk"), "media")
    return pairs.join(done, ["pk", "media"], "left_anti")


def with_post_text(rows: DataFrame, profile: LibraryProfile = DEFAULT) -> DataFrame:
    """Adds the message, its link and the bytes of the link, from pk, media, title, authors, lang."""
    link = F.concat(F.lit(profile.book_url()), F.col("pk").cast("string"))
    medium = F.col("media")
    line = {m: pretty_title(F.col("title"), F.col("authors"), room) for m, room in POST_TITLE_ROOM.items()}
    quoted = F.replace(line["Bluesky"], F.lit('"'), F.lit('\\"'))
    text = (
        F.when(medium == "Bluesky", F.concat(F.lit(profile.filled(profile.new_book)), quoted, F.lit(" "), link))
        .when(medium == "Mastodon", F.concat(F.lit(profile.filled(profile.new_book_short)), line["Mastodon"], F.lit(" "), link))
        .otherwise(F.lit(profile.filled(profile.free_book)))
    )
    made = rows.select("pk", "media", "lang", link.alias("link"), text.alias("message"))
    end = F.when(F.col("media") == "Bluesky", F.octet_length("message"))
    return made.withColumn("byte_end", end).withColumn("byte_start", end - F.length("link"))


def post_outbox(books: DataFrame, posts: DataFrame, first_books: dict[str, int] = POST_FROM, profile: LibraryProfile = DEFAULT) -> DataFrame:
    """Posts to send, never one that was sent. `books` is (pk, title, authors, lang)."""
    return with_post_text(unposted(post_candidates(books, first_books), posts), profile)


def notice_text(template: str, ebook: Column, records: Column | None = None, profile: LibraryProfile = DEFAULT) -> Column:
    """The template with the library, the book and, last, the log records filled in."""
    text = F.lit(template.replace("{name}", profile.name).replace("{site}", profile.site))
    text = F.replace(text, F.lit("{ebook}"), ebook.cast("string"))
    return text if records is None else F.replace(text, F.lit("{records}"), records)


def with_address(messages: DataFrame, addresses: DataFrame) -> DataFrame:
    """Messages (ebook, role, ...) with the address for the role; null if nobody is named."""
    return messages.join(addresses, ["ebook", "role"], "left")


def undelivered(messages: DataFrame) -> DataFrame:
    """Archive lines of messages nobody can be sent."""
    kept = messages.filter(F.col("email").isNull())
    at = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss")
    line = F.concat(F.col("role"), F.lit(": "), at, F.lit("\nSubject: "), F.col("subject"), F.lit("\n"), F.col("message"), F.lit("\n"))
    return kept.select("ebook", line.alias("value"))


def not_critical(processed: DataFrame, notices: DataFrame) -> DataFrame:
    return processed.join(notices.select("ebook"), "ebook", "left_anti")


def notice_outbox(
    notices: DataFrame, processed: DataFrame | None, addresses: DataFrame, asof: str, profile: LibraryProfile = DEFAULT
) -> DataFrame:
    """Critical notices for the managers; with `processed` also good news for books without one."""
    message = notice_text(profile.critical_text, F.col("ebook"), F.col("record"), profile)
    sent = notices.filter(F.col("record") != "").select("ebook", F.lit("critical").alias("kind"), message.alias("message"))
    if processed is not None:
        good = not_critical(processed, notices)
        sent = sent.unionByName(good.select("ebook", F.lit("processed").alias("kind"), notice_text(profile.processed_text, F.col("ebook"), None, profile).alias("message")))
    addressed = with_address(sent.withColumn("role", F.lit("ww")), addresses)
    subject = F.lit(f"{profile.name} backend notifications")
    return addressed.withColumn("subject", subject).withColumn("time", F.lit(asof).cast("timestamp_ntz"))
