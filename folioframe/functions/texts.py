"""Book texts: wrapper, header fields, HTML, opening part, readability."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import (
    CYRILLIC_SYLLABLE_PATTERN,
    EASE_FORMULAS,
    OPENING_TOKENS,
    SCORE_BANDS,
    SENTENCE_PATTERN,
    SYLLABLE_PATTERN,
    WORD_PATTERN,
)

ENTITIES = {
    "&nbsp;": " ",
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&lsquo;": "‘",
    "&rsquo;": "’",
    "&ldquo;": "“",
    "&rdquo;": "”",
    "&mdash;": "—",
    "&ndash;": "–",
    "&amp;": "&",
}


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def decoded(content: Column) -> Column:
    """Bytes as UTF-8, else as ISO-8859-1, which takes any byte."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))


def without_wrapper(text: Column) -> Column:
    """Body between the last START line and the first END line after which nothing is read."""
    before_end = F.split(text, r"(?:^|\n)\*\*\* END OF", 2)[0]
    after_start = F.regexp_replace(before_end, r"(?s)^(?:.*\n)?\*\*\* START OF[^\n]*", "")
    return trimmed(after_start)


def header_field(text: Column, label: str) -> Column:
    """Value of a `Label: value` line; '' if there is no such line."""
    return trimmed(F.regexp_extract(text, rf"(?:^|\n){label}:?[ \t]+([^\n]*)", 1))


def header_authors(text: Column) -> Column:
    """Authors: the labelled line and the indented lines below it."""
    block = F.regexp_extract(text, r"(?:^|\n)Authors?:[ \t]*([^\n]*(?:\n[ \t]+[^\n]+)*)", 1)
    names = F.transform(F.split(block, "\n"), lambda line: trimmed(line))
    return F.filter(names, lambda name: name != "")


def header_book_id(text: Column) -> Column:
    return F.regexp_extract(text, r"\[E[Bb]ook #([0-9]+)\]", 1).try_cast("bigint")


def header_fields(text: Column) -> dict[str, Column]:
    return {
        "title": header_field(text, "Title"),
        "authors": F.array_join(header_authors(text), "; "),
        "released": trimmed(F.regexp_extract(text, r"(?:^|\n)Release [Dd]ate:[ \t]*([^\[\n]*)", 1)),
        "book_id": header_book_id(text),
        "language": header_field(text, "Language"),
        "credit": header_field(text, "Produced by"),
    }


COMMON_REFERENCES = ("amp", "lt", "gt", "quot", "nbsp", "mdash", "ndash", "ldquo", "rdquo", "lsquo", "rsquo", "hellip", "eacute", "egrave")


def html_body_text(html: Column) -> Column:
    """Readable text of a page body: scripts, styles and comments out first (an unclosed one ends with the page), then what
    stands before the first body, then tags; character references decoded last."""
    plain = F.regexp_replace(html, r"(?is)<script.*?(?:</script>|$)|<style.*?(?:</style>|$)|<!--.*?(?:-->|$)", "")
    body = F.when(plain.rlike("(?i)<body[^>]*>"), F.regexp_extract(plain, "(?is)<body[^>]*>(.*)", 1)).otherwise(plain)
    return trimmed(decoded_references(F.regexp_replace(body, r"(?s)<[^>]*>", "")))


def decoded_references(text: Column) -> Column:
    """Numeric and named character references (`&#8217;`, `&#x2014;`, `&eacute;`) as characters, once; unknown ones stay.

    Texts without any are passed by, and the few names that make up most references are tried before the long table.
    """
    names = {name.removesuffix(";"): char for name, char in html5.items() if name.endswith(";")}
    names |= {entity.strip("&;"): char for entity, char in ENTITIES.items()}
    table = F.from_json(F.lit(json.dumps(names)), "map<string,string>")

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        number = F.when(F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substring(name, 3, 6), 16, 10)).otherwise(F.substring(name, 2, 7)).try_cast("int")
        sound = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        point = F.decode(F.unhex(F.lpad(F.hex(F.when(sound, number).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        char = F.when(name == "", F.lit(None))
        for common in COMMON_REFERENCES:
            char = char.when(name == common, names[common])
        char = char.when(name.startswith("#"), point).otherwise(F.try_element_at(table, name))
        return F.coalesce(F.concat(char, F.substr(part, F.length(name) + 2)), F.concat(F.lit("&"), part))

    parts = F.split(text, "&")
    joined = F.concat(parts[0], F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), decoded), ""))
    return F.when(text.contains("&"), joined).otherwise(text)


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def opening_part(text: Column, limit: int = OPENING_TOKENS) -> Column:
    """First `limit` white-space tokens of a long text, the whole text otherwise."""
    words = tokens(text)
    return F.when(F.size(words) > limit, F.array_join(F.slice(words, 1, limit), " ")).otherwise(text)


def is_partial(text: Column, limit: int = OPENING_TOKENS) -> Column:
    return F.regexp_count(text, F.lit(r"\S+")) > limit


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_PATTERN)).cast("bigint")


def sentence_count(text: Column) -> Column:
    """Runs of closing marks; a text with words has one sentence at least."""
    return F.greatest(F.regexp_count(text, F.lit(SENTENCE_PATTERN)).cast("bigint"), F.lit(1).cast("bigint"))


def syllable_count(text: Column, lang: Column) -> Column:
    """Vowel groups, with Cyrillic vowels for Russian. A dictionary would score a little differently."""
    latin = F.regexp_count(text, F.lit(SYLLABLE_PATTERN))
    return F.when(lang == "ru", F.regexp_count(text, F.lit(CYRILLIC_SYLLABLE_PATTERN))).otherwise(latin).cast("bigint")


def reading_ease(lang: Column, sentences: Column, words: Column, syllables: Column) -> Column:
    """Flesch-type score; null for a language without a formula and for a text without words."""
    score = F.lit(None).cast("double")
    for code, (base, per_sentence, per_word) in EASE_FORMULAS.items():
        value = F.lit(base) - F.lit(per_sentence) * (words / sentences) - F.lit(per_word) * (syllables / words)
        score = F.when((lang == code) & (words > 0), value).otherwise(score)
    return score


def _band(score: Column, field: int) -> Column:
    chain = F.when(score >= SCORE_BANDS[0][0], SCORE_BANDS[0][field])
    for band in SCORE_BANDS[1:-1]:
        chain = chain.when(score >= band[0], band[field])
    return F.when(score.isNotNull(), chain.otherwise(SCORE_BANDS[-1][field]))


def grade(score: Column) -> Column:
    """Grade of a score; outside 0..100 the nearest band holds, a shared edge belongs to the upper band."""
    return _band(score, 1)


def grade_text(score: Column) -> Column:
    return _band(score, 2)


def score_text(score: Column) -> Column:
    """The stored sentence. Scores half-way between two tenths (.25, .75) go to the even one."""
    halfway = score * 4 == F.floor(score * 4)
    shown = F.when(halfway, F.bround(score, 1)).otherwise(score)
    return F.format_string("Reading ease score: %.1f (%s). %s", shown, grade(score), grade_text(score))


def verdict(answer: Column) -> Column:
    """True for `VERDICT: YES` in any case; a missing verdict is not valid."""
    return F.upper(F.regexp_extract(answer, r"(?i)VERDICT:\s*(YES|NO)", 1)) == "YES"
