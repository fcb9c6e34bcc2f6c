"""Text analytics of books: readability scores, summaries, requests for new summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    EASE_FORMULAS,
    MODEL_TAG,
    NOTE_CODE,
    OPENING_TOKENS,
    REFUSAL_PHRASES,
    REFUSAL_STARTS,
    SCORED_LANGUAGES,
    SCORE_CODE,
    SUMMARY_CODE,
    WIKI_CAPTION,
    WIKI_LINK_PATTERN,
    WIKI_SKIPPED_LANGUAGES,
    WIKI_SKIPPED_TITLES,
    WIKI_TAG,
)
from ..functions.texts import (
    is_partial,
    opening_part,
    reading_ease,
    score_text,
    sentence_count,
    syllable_count,
    without_wrapper,
    word_count,
)
from ..functions.titles import pretty_title
from ..operators.lists import ordered_list
from ..operators.scans import scan_attributes
from ..profile import DEFAULT, LibraryProfile
from ..sinks.snapshots import append_attributes, upsert_attribute
from .catalog_feed import main_languages


def text_stats(texts: DataFrame, column: str = "text") -> DataFrame:
    """Sentences, words and syllables of each text (fk_books, lang, text); the text is dropped."""
    text = F.col(column)
    kept = [c for c in texts.columns if c != column]
    return texts.select(
        *kept, sentence_count(text).alias("sentences"), word_count(text).alias("words"), syllable_count(text, F.col("lang")).alias("syllables")
    )


def with_score(stats: DataFrame) -> DataFrame:
    return stats.withColumn("score", reading_ease(*[F.col(c) for c in ("lang", "sentences", "words", "syllables")]))


def readability_scores(texts: DataFrame, categories: DataFrame, existing: DataFrame) -> DataFrame:
    """What to do with the score attribute of each text book: insert, replace, delete, or nothing.

    `existing` holds attribute rows; books in a language without a formula lose a stale score.
    """
    kept = texts.join(categories.select("fk_books"), "fk_books", "left_anti")
    lang = F.coalesce(F.col("lang"), F.lit("en"))
    scored = with_score(text_stats(kept.select("fk_books", lang.alias("lang"), without_wrapper(F.col("text")).alias("text"))))
    old = scan_attributes(existing, SCORE_CODE).groupBy("fk_books").agg(F.min("pk").alias("old_pk"))
    supported, has_old = F.col("lang").isin(*EASE_FORMULAS), F.col("old_pk").isNotNull()
    action = (
        F.when(~supported & has_old, "delete")
        .when(~supported | F.col("score").isNull(), "none")
        .when(has_old, "replace")
        .otherwise("insert")
    )
    text = F.when(action.isin("insert", "replace"), score_text(F.col("score")))
    return scored.join(old, "fk_books", "left").select("fk_books", "old_pk", action.alias("action"), text.alias("text"), "score")


def supported_books(books: DataFrame, languages: DataFrame) -> DataFrame:
    return main_languages(books, languages).filter(F.col("lang").isin(*SCORED_LANGUAGES))


def wiki_link(text: Column) -> Column:
    """Language and title of an encyclopedia link, null for none and for those not to be trusted."""
    lang = F.regexp_extract(text, WIKI_LINK_PATTERN, 1)
    title = F.regexp_extract(text, WIKI_LINK_PATTERN, 2)
    bad = lang.isin(*WIKI_SKIPPED_LANGUAGES)
    for part in WIKI_SKIPPED_TITLES:
        bad = bad | title.contains(part)
    return F.when((lang != "") & ~bad, F.struct(lang.alias("lang"), title.alias("title")))


def wiki_links(attributes: DataFrame) -> DataFrame:
    """Encyclopedia links noted for a book."""
    notes = scan_attributes(attributes, NOTE_CODE).filter(F.col("text").startswith(WIKI_CAPTION))
    found = notes.select("pk", "fk_books", wiki_link(F.col("text")).alias("link"))
    return found.filter(F.col("link").isNotNull()).select("pk", "fk_books", "link.lang", "link.title")


def pick_wiki_link(links: DataFrame, book_languages: DataFrame) -> DataFrame:
    """First link in the book's language or English; failing that the last link.

    Links shrink to the first and the last per (book, language) before they meet the books.
    """
    place = F.struct("pk", "lang", "title")
    ends = links.groupBy("fk_books", "lang").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    joined = ends.join(book_languages.select(F.col("pk").alias("fk_books"), F.col("lang").alias("book_lang")), "fk_books")
    fits = (F.col("lang") == F.col("book_lang")) | (F.col("lang") == "en")
    best = F.coalesce(F.min(F.when(fits, F.col("_first"))), F.max("_last"))
    return joined.groupBy("fk_books").agg(best.alias("link")).select("fk_books", "link.lang", "link.title")


def new_links(verified: DataFrame, known: DataFrame) -> DataFrame:
    return verified.join(known.select("fk_books", "lang", "title"), ["fk_books", "lang", "title"], "left_anti")


def link_note(lang: Column, title: Column) -> Column:
    return F.concat(F.lit(f"{WIKI_CAPTION}: https://"), lang, F.lit(".wikipedia.org/wiki/"), title)


def existing_summaries(attributes: DataFrame, profile: LibraryProfile = DEFAULT) -> DataFrame:
    """First tagged summary of each book with its kind; untagged ones do not count."""
    text = F.col("text")
    kind = F.when(text.contains(MODEL_TAG), "LLM").when(text.contains(WIKI_TAG), "WIKI").when(text.contains(profile.staff_tag), "EDITED")
    tagged = scan_attributes(attributes, SUMMARY_CODE).select("fk_books", "pk", kind.alias("kind"), "text").filter(F.col("kind").isNotNull())
    first = F.min_by(F.struct("kind", "text"), F.struct("pk", "text")).alias("first")
    return tagged.groupBy("fk_books").agg(first).select("fk_books", "first.*")


def is_refusal(summary: Column) -> Column:
    test = F.lit(False)
    for start in REFUSAL_STARTS:
        test = test | summary.startswith(start)
    for phrase in REFUSAL_PHRASES:
        test = test | summary.contains(phrase)
    return test


def apply_summaries(attributes: DataFrame, finished: DataFrame) -> DataFrame:
    """Attributes after storing finished summaries (fk_books, kind, text, lang, title; kind is WIKI or LLM).

    Refused and empty ones are dropped, the others get the tag of their kind and become the book's summary. The link of
    an article that is not noted yet is added once, as a note; lang and title are null for a summary without one.
    Several summaries of a book: the article's before the model's, then the first in order.
    """
    text = F.trim(F.coalesce("text", F.lit("")))
    good = finished.filter((text != "") & ~is_refusal(text))
    best = F.min_by(F.struct("kind", text.alias("text")), F.struct(F.col("kind") != "WIKI", text)).alias("best")
    tagged = good.groupBy("fk_books").agg(best).select("fk_books", F.concat("best.text", F.when(F.col("best.kind") == "WIKI", WIKI_TAG).otherwise(MODEL_TAG)).alias("text"))
    stored = upsert_attribute(attributes, tagged, SUMMARY_CODE)
    linked = good.filter((F.col("kind") == "WIKI") & F.col("lang").isNotNull() & F.col("title").isNotNull()).select("fk_books", "lang", "title").distinct()
    fresh = new_links(linked, wiki_links(attributes)).select("fk_books", link_note(F.col("lang"), F.col("title")).alias("text"))
    return append_attributes(stored, fresh, NOTE_CODE)


@dataclass(frozen=True)
class Prompts:
    """Wording of the requests; replace it with your own. `{title}` and `{excerpt}` are filled in."""

    system: str = "You write short, clear notes on books for library readers."
    opening: str = "Write two paragraphs on {title}: what kind of work it is and when it was written, then what its opening tells."
    whole: str = "Write two paragraphs on {title}: what kind of work it is and when it was written, then what it tells."
    reply: str = "Understood. Please send the text."
    check_system: str = "You judge whether an encyclopedia excerpt is about a certain work."
    check: str = "Work: {title}\nExcerpt:\n{excerpt}\nIs the excerpt about this very work? Answer VERDICT: [YES/NO]"


def _filled(template: str, **values: Column) -> Column:
    text = F.lit(template)
    for name, value in values.items():
        text = F.replace(text, F.lit("{" + name + "}"), value)
    return text


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def summary_messages(title: Column, text: Column, limit: int = OPENING_TOKENS, prompts: Prompts = Prompts()) -> Column:
    """Messages that ask for a summary: of the opening of a long text, of a short one as a whole."""
    partial = is_partial(text, limit)
    scope = F.when(partial, "Opening of the book").otherwise("The book")
    body = F.concat(scope, F.lit(", between the marks:\n<<<\n"), opening_part(text, limit), F.lit("\n>>>"))
    ask = F.when(partial, _filled(prompts.opening, title=title)).otherwise(_filled(prompts.whole, title=title))
    return F.array(
        _message("system", F.lit(prompts.system)), _message("user", ask), _message("assistant", F.lit(prompts.reply)), _message("user", body)
    )


def check_messages(title: Column, excerpt: Column, prompts: Prompts = Prompts()) -> Column:
    return F.array(
        _message("system", F.lit(prompts.check_system)), _message("user", _filled(prompts.check, title=title, excerpt=excerpt))
    )


def title_lines(titles: DataFrame, book_authors: DataFrame, authors: DataFrame, room: int = 1000) -> DataFrame:
    """`title by a, b` of each book with a title."""
    named = book_authors.join(authors.select(F.col("id").alias("fk_authors"), "name"), "fk_authors")
    listed = ordered_list(named, ["fk_books"], "heading", "name", "names", ", ")
    return titles.join(listed, "fk_books", "left").select("fk_books", pretty_title(F.col("title"), F.col("names"), room).alias("title_line"))


def summary_work(
    books: DataFrame,
    categories: DataFrame,
    attributes: DataFrame,
    languages: DataFrame,
    titles: DataFrame,
    texts: DataFrame,
    limit: int = OPENING_TOKENS,
    profile: LibraryProfile = DEFAULT,
) -> DataFrame:
    """What each book needs: nothing, an article's summary, or a search and then a request on its text.

    `titles` is (fk_books, title_line). The text joins last and only for books that need it.
    """
    langs = main_languages(books.select("pk"), languages)
    link = pick_wiki_link(wiki_links(attributes), langs).select(F.col("fk_books").alias("pk"), F.col("lang").alias("wiki_lang"), F.col("title").alias("wiki_title"))
    kinds = existing_summaries(attributes, profile).select(F.col("fk_books").alias("pk"), "kind")
    marked = categories.select(F.col("fk_books").alias("pk")).distinct().withColumn("_marked", F.lit(True))
    joined = langs.join(marked, "pk", "left").join(kinds, "pk", "left").join(link, "pk", "left")
    action = (
        F.when(F.col("_marked"), "skip_non_text")
        .when(F.col("kind") == "EDITED", "keep_edited")
        .when(F.col("wiki_title").isNotNull(), "wiki")
        .otherwise("search")
    )
    decided = joined.withColumn("action", action).join(titles.withColumnRenamed("fk_books", "pk"), "pk", "left")
    body = without_wrapper(F.col("text"))
    searching = F.col("action") == "search"
    needed = joined.filter(action == "search").select(F.col("pk").alias("fk_books"))
    sized = texts.join(needed, "fk_books", "left_semi").select(F.col("fk_books").alias("pk"), is_partial(body, limit).alias("partial"))
    return decided.join(sized, "pk", "left").select(
        "pk",
        "action",
        "kind",
        F.when(F.col("action") == "wiki", F.col("wiki_lang")).alias("wiki_lang"),
        F.when(F.col("action") == "wiki", F.col("wiki_title")).alias("wiki_title"),
        F.when(searching, F.concat(F.coalesce("title_line", F.lit("")), F.lit(" wikipedia"))).alias("search_for"),
        F.when(searching, F.coalesce(F.when(F.col("partial"), "opening").otherwise(F.when(~F.col("partial"), "whole")), F.lit("no text"))).alias("text_job"),
    )
