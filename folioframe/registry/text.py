"""Registered queries: texts, readability, summaries, encyclopedia links."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import EASE_FORMULAS, MODEL_TAG, REFUSAL_STARTS, SCORE_BANDS, SENTENCE_PATTERN, SYLLABLE_PATTERN, WIKI_CAPTION, WIKI_TAG, WORD_PATTERN
from ..functions import texts
from ..plans import catalog_feed, inventory, reading
from .base import Entry

ROOM = 40
TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
BODY = """bodies AS (
  SELECT fk_books, lang, array_to_string(list_slice(lines, start_at + 1, end_at - 1), chr(10)) AS inner_text FROM (
    SELECT *, coalesce(list_max([i FOR i IN range(1, end_at) IF starts_with(lines[i], '*** START OF')]), 0) AS start_at FROM (
      SELECT fk_books, lang, lines, coalesce(list_min([i FOR i IN range(1, len(lines) + 1) IF starts_with(lines[i], '*** END OF')]), len(lines) + 1) AS end_at
      FROM (SELECT fk_books, lang, string_split(raw, chr(10)) AS lines FROM {{v_wrapped_texts}})))),
body AS (SELECT fk_books, lang, regexp_replace(inner_text, '^\\s+|\\s+$', '', 'g') AS text FROM bodies)"""
ENTITY_SQL = "{0}"
# the references that the pages hold, the ampersand last
for _entity, _char in {"&copy;": "©", "&middot;": "·", **texts.ENTITIES}.items():
    ENTITY_SQL = f"replace({ENTITY_SQL}, '{_entity}', '{_char.replace(chr(39), chr(39) * 2)}')"
HTML = ENTITY_SQL.format(r"regexp_replace(regexp_replace(html, '(?is)^.*<body[^>]*>', ''), '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>', '', 'g')")
WORDS = r"([t FOR t IN regexp_split_to_array({0}, '\s+') IF t <> ''])"
COUNTS = f"""CAST(greatest(len(regexp_extract_all(text, '{SENTENCE_PATTERN}')), 1) AS BIGINT) AS sentences,
  CAST(len(regexp_extract_all(text, '{WORD_PATTERN}')) AS BIGINT) AS words, CAST(len(regexp_extract_all(text, '{SYLLABLE_PATTERN}')) AS BIGINT) AS syllables"""
SCORE = "CASE lang " + " ".join(
    f"WHEN '{c}' THEN CAST({b} AS DOUBLE) - CAST({s} AS DOUBLE) * (CAST(words AS DOUBLE) / CAST(sentences AS DOUBLE)) - CAST({w} AS DOUBLE) * (CAST(syllables AS DOUBLE) / CAST(words AS DOUBLE))"
    for c, (b, s, w) in EASE_FORMULAS.items()
) + " END"


def band(score: str, field: int) -> str:
    return "CASE " + " ".join(f"WHEN {score} >= {b[0]} THEN '{b[field]}'" for b in SCORE_BANDS[:-1]) + f" ELSE '{SCORE_BANDS[-1][field]}' END"


SCORE_TEXT = f"printf('Reading ease score: %.1f (%s). %s', score, {band('score', 1)}, {band('score', 2)})"
LINKS = r"""links AS (
  SELECT pk, fk_books, regexp_extract(text, '(?i)https?://([a-z]{2,3})\.wikipedia\.org/wiki/([/!@i^*$a-z0-9_\(\)-]+)', 1) AS lang,
         regexp_extract(text, '(?i)https?://([a-z]{2,3})\.wikipedia\.org/wiki/([/!@i^*$a-z0-9_\(\)-]+)', 2) AS title
  FROM {{v_attributes}} WHERE fk_attriblist = 500 AND text LIKE 'Wikipedia page about this book%'),
good AS (SELECT * FROM links WHERE lang <> 'sco' AND lang <> '' AND title NOT LIKE '%(disambiguation)%'),
firsts AS (SELECT pk AS book, coalesce((SELECT arg_min(lang, (pos, lang)) FROM {{v_languages}} WHERE fk_books = pk), 'en') AS book_lang FROM {{v_books}}),
picked AS (
  SELECT * FROM (SELECT g.*, row_number() OVER (PARTITION BY fk_books ORDER BY CASE WHEN g.lang IN (book_lang, 'en') THEN 0 ELSE 1 END,
      CASE WHEN g.lang IN (book_lang, 'en') THEN pk END, CASE WHEN g.lang IN (book_lang, 'en') THEN g.lang END, CASE WHEN g.lang IN (book_lang, 'en') THEN title END,
      pk DESC, g.lang DESC, title DESC) AS rn FROM good g JOIN firsts ON fk_books = book) WHERE rn = 1),
tagged AS (
  SELECT fk_books, pk, text, CASE WHEN text LIKE '%(This is an automatically generated summary.)%' THEN 'LLM' WHEN text LIKE '%(This summary is from Wikipedia.)%' THEN 'WIKI'
         WHEN text LIKE '%(Summary by library staff.)%' THEN 'EDITED' END AS kind FROM {{v_attributes}} WHERE fk_attriblist = 520),
kinds AS (SELECT fk_books, arg_min(kind, (pk, text)) AS kind, arg_min(text, (pk, text)) AS text FROM tagged WHERE kind IS NOT NULL GROUP BY 1)"""
LINE = """lines AS (
  SELECT t.fk_books, replace(CASE WHEN n.names IS NULL THEN title ELSE concat(title, ' by ', names) END, chr(10), ' ') AS line FROM {{v_titles}} t LEFT JOIN
    (SELECT fk_books, string_agg(name, ', ' ORDER BY heading, name) AS names FROM {{v_book_authors}} JOIN {{v_authors}} ON fk_authors = id GROUP BY 1) n USING (fk_books))"""
_P = reading.Prompts()


def _wrapped(c):
    return c["v_wrapped_texts"].select("fk_books", "lang", F.col("raw").alias("text"))


def _scored(c):
    return reading.with_score(reading.text_stats(c["v_texts"].select("fk_books", "lang", "text")))


def _langs(c):
    return catalog_feed.main_languages(c["v_books"].select("pk"), c["v_languages"])


def _lines(c, room=1000):
    return reading.title_lines(c["v_titles"], c["v_book_authors"], c["v_authors"], room)


def _answers(c):
    answer = F.when(F.col("role") == "user", F.concat(F.lit("Verdict:  yes. "), F.col("text"))).when(F.col("turn") > 1, F.concat(F.col("text"), F.lit(" VERDICT: NO"))).otherwise(F.col("text"))
    return c["conversations"].select("conv_id", "turn", "role", texts.verdict(answer).alias("valid"))


def _replies(c):
    lead = F.when(F.col("source") == "src1", "It appears that ").when(F.col("source") == "src2", "Sorry, no content provided. ").otherwise("")
    return c["documents"].select("doc_id", F.concat(lead, F.col("text")).alias("summary"))


def _old_scores(c):
    return c["documents"].filter(F.col("source") < "src14").select((F.col("doc_id") * 10).alias("pk"), F.col("doc_id").alias("fk_books"), F.lit(908).alias("fk_attriblist"), F.lit("old").alias("text"), F.lit(0).alias("nonfiling"))


def _messages(c):
    text, line = texts.without_wrapper(F.col("raw")), F.concat(F.lit("Book "), F.col("fk_books"))
    both = F.concat(reading.summary_messages(line, text, 300), reading.check_messages(line, F.col("raw")))
    return c["v_wrapped_texts"].select("fk_books", F.posexplode(both).alias("pos", "message")).select("fk_books", "pos", "message.*")


def _finished(c):
    """Summaries as they come back: one of three from an article, some refused, some empty."""
    book = F.col("pk")
    text = F.when(book % 7 == 0, F.lit(REFUSAL_STARTS[0] + " no")).when(book % 11 == 0, F.lit(" ")).otherwise(F.concat(F.lit("On book "), book))
    wiki = book % 3 == 0
    return c["v_books"].select(book.alias("fk_books"), F.when(wiki, "WIKI").otherwise("LLM").alias("kind"), text.alias("text"), F.when(wiki, "en").alias("lang"), F.when(wiki, F.concat(F.lit("Book_"), book)).alias("title"))


APPLIED = f"""done AS (SELECT pk AS fk_books, pk % 3 = 0 AS wiki, concat('On book ', pk, CASE WHEN pk % 3 = 0 THEN '{WIKI_TAG}' ELSE '{MODEL_TAG}' END) AS text
  FROM {{{{v_books}}}} WHERE pk % 7 <> 0 AND pk % 11 <> 0),
held AS (SELECT *, row_number() OVER (PARTITION BY fk_books, fk_attriblist ORDER BY pk, text) AS rn FROM {{{{v_attributes}}}})
SELECT h.fk_books, h.fk_attriblist, CASE WHEN h.fk_attriblist = 520 AND rn = 1 THEN coalesce(d.text, h.text) ELSE h.text END AS text, h.nonfiling FROM held h LEFT JOIN done d USING (fk_books)
UNION ALL SELECT fk_books, 520, text, 0 FROM done WHERE fk_books NOT IN (SELECT fk_books FROM held WHERE fk_attriblist = 520)
UNION ALL SELECT fk_books, 500, concat('{WIKI_CAPTION}: https://en.wikipedia.org/wiki/Book_', fk_books), 0 FROM done WHERE wiki
  AND concat('{WIKI_CAPTION}: https://en.wikipedia.org/wiki/Book_', fk_books) NOT IN (SELECT text FROM {{{{v_attributes}}}} WHERE fk_attriblist = 500)"""


ENTRIES: dict[str, Entry] = {
    "fn_strip_wrapper": Entry(
        lambda c: c["v_wrapped_texts"].select("fk_books", texts.without_wrapper(F.col("raw")).alias("text")), f"WITH {BODY} SELECT fk_books, text FROM body"
    ),
    "fn_html_to_text": Entry(
        lambda c: c["pages"].select("page_id", texts.html_body_text(F.col("html")).alias("text")), f"SELECT page_id, {TRIM.format(HTML)} AS text FROM {{{{pages}}}}"
    ),
    "fn_opening_chunk": Entry(
        lambda c: c["v_texts"].select("fk_books", texts.opening_part(F.col("text"), 200).alias("opening"), texts.is_partial(F.col("text"), 200).alias("is_partial")),
        f"""SELECT fk_books, CASE WHEN len({WORDS.format('text')}) > 200 THEN array_to_string({WORDS.format('text')}[1:200], ' ') ELSE text END AS opening, len({WORDS.format('text')}) > 200 AS is_partial FROM {{{{v_texts}}}}""",
    ),
    "fn_prompt_messages": Entry(
        _messages,
        f"""WITH {BODY}, parts AS (SELECT fk_books, text, len({WORDS.format('text')}) > 300 AS partial, CASE WHEN len({WORDS.format('text')}) > 300 THEN array_to_string({WORDS.format('text')}[1:300], ' ') ELSE text END AS opening FROM body)
        SELECT fk_books, 0 AS pos, 'system' AS role, '{_P.system}' AS content FROM parts
        UNION ALL SELECT fk_books, 1, 'user', replace(CASE WHEN partial THEN '{_P.opening}' ELSE '{_P.whole}' END, '{{title}}', concat('Book ', fk_books)) FROM parts
        UNION ALL SELECT fk_books, 2, 'assistant', '{_P.reply}' FROM parts
        UNION ALL SELECT fk_books, 3, 'user', concat(CASE WHEN partial THEN 'Opening of the book' ELSE 'The book' END, ', between the marks:', chr(10), '<<<', chr(10), CASE WHEN partial THEN opening ELSE text END, chr(10), '>>>') FROM parts
        UNION ALL SELECT fk_books, 4, 'system', '{_P.check_system}' FROM parts
        UNION ALL SELECT fk_books, 5, 'user', replace(replace('{_P.check}', '{{title}}', concat('Book ', fk_books)), '{{excerpt}}', raw) FROM {{{{v_wrapped_texts}}}}""",
    ),
    "apply_summaries": Entry(
        lambda c: reading.apply_summaries(c["v_attributes"], _finished(c)).select("fk_books", "fk_attriblist", "text", "nonfiling"), f"WITH {APPLIED}"
    ),
    "fn_parse_verdict": Entry(_answers, "SELECT conv_id, turn, role, role = 'user' AS valid FROM {{conversations}}"),
    "agg_readability_stats": Entry(
        lambda c: reading.text_stats(c["v_texts"].select("fk_books", "lang", "text")), f"SELECT fk_books, lang, {COUNTS} FROM {{{{v_texts}}}}"
    ),
    "fn_readability": Entry(
        lambda c: _scored(c).select("fk_books", F.round("score", 4).alias("score")),
        f"WITH s AS (SELECT fk_books, lang, {COUNTS} FROM {{{{v_texts}}}}) SELECT fk_books, round({SCORE}, 4) AS score FROM s",
    ),
    "fn_readability_text": Entry(
        lambda c: _scored(c).select("fk_books", texts.score_text(F.col("score")).alias("text")),
        f"WITH s AS (SELECT fk_books, lang, {COUNTS} FROM {{{{v_texts}}}}), t AS (SELECT fk_books, {SCORE} AS score FROM s) SELECT fk_books, {SCORE_TEXT} AS text FROM t",
    ),
    "range_score_band": Entry(
        lambda c: c["customer"].select("c_custkey", texts.grade(F.col("c_acctbal") / 90).alias("grade"), texts.grade_text(F.col("c_acctbal") / 90).alias("description")),
        f"SELECT c_custkey, {band('c_acctbal / 90', 1)} AS grade, {band('c_acctbal / 90', 2)} AS description FROM {{{{customer}}}}",
    ),
    "filter_supported_lang": Entry(
        lambda c: reading.supported_books(c["v_books"].select("pk"), c["v_languages"]),
        "SELECT pk, lang FROM (SELECT pk, coalesce((SELECT arg_min(lang, (pos, lang)) FROM {{v_languages}} WHERE fk_books = pk), 'en') AS lang FROM {{v_books}}) WHERE lang <> 'fi'",
    ),
    "readability_scores": Entry(
        lambda c: reading.readability_scores(
            _wrapped(c).withColumn("lang", F.when(F.col("lang") == "es", "fi").otherwise(F.col("lang"))), c["v_categories"], _old_scores(c)
        ).select("fk_books", "action", F.coalesce("text", F.lit("")).alias("text")),
        f"""WITH {BODY}, s AS (SELECT fk_books, lang, {COUNTS} FROM body WHERE fk_books NOT IN (SELECT fk_books FROM {{{{v_categories}}}})), t AS (SELECT *, {SCORE} AS score FROM s),
        a AS (SELECT fk_books, score, CASE WHEN t.lang = 'es' AND source < 'src14' THEN 'delete' WHEN t.lang = 'es' OR score IS NULL THEN 'none' WHEN source < 'src14' THEN 'replace' ELSE 'insert' END AS action FROM t JOIN {{{{documents}}}} ON doc_id = fk_books)
        SELECT fk_books, action, CASE WHEN action IN ('insert', 'replace') THEN {SCORE_TEXT} ELSE '' END AS text FROM a""",
    ),
    "filter_wiki_links": Entry(lambda c: reading.wiki_links(c["v_attributes"]), f"WITH {LINKS} SELECT * FROM good"),
    "pick_wiki_link": Entry(
        lambda c: reading.pick_wiki_link(reading.wiki_links(c["v_attributes"]), _langs(c)), f"WITH {LINKS} SELECT fk_books, lang, title FROM picked"
    ),
    "anti_new_wiki_link": Entry(
        lambda c: reading.new_links(reading.wiki_links(c["v_attributes"]).select("fk_books", F.lit("en").alias("lang"), "title"), reading.wiki_links(c["v_attributes"])),
        f"WITH {LINKS} SELECT fk_books, 'en' AS lang, title FROM good g WHERE NOT EXISTS (SELECT 1 FROM good k WHERE k.fk_books = g.fk_books AND k.lang = 'en' AND k.title = g.title)",
    ),
    "pick_existing_summary": Entry(lambda c: reading.existing_summaries(c["v_attributes"]), f"WITH {LINKS} SELECT fk_books, kind, text FROM kinds"),
    "filter_bad_summary": Entry(
        lambda c: _replies(c).filter(~reading.is_refusal(F.col("summary"))).select("doc_id"), "SELECT doc_id FROM {{documents}} WHERE source NOT IN ('src1', 'src2')"
    ),
    "fn_pretty_title": Entry(
        lambda c: _lines(c, ROOM), f"WITH {LINE} SELECT fk_books, CASE WHEN length(line) > {ROOM} THEN concat(left(line, {ROOM - 1}), '…') ELSE line END AS title_line FROM lines"
    ),
    "summary_resolution": Entry(
        lambda c: reading.summary_work(c["v_books"], c["v_categories"], c["v_attributes"], c["v_languages"], _lines(c), _wrapped(c), 300).select(
            "pk", "action", *[F.coalesce(n, F.lit("")).alias(n) for n in ("kind", "wiki_lang", "wiki_title", "search_for", "text_job")]
        ),
        f"""WITH {LINKS}, {LINE}, {BODY}, t AS (SELECT fk_books, CASE WHEN len({WORDS.format('text')}) > 300 THEN 'opening' ELSE 'whole' END AS job FROM body),
        a AS (SELECT b.pk, CASE WHEN b.pk IN (SELECT fk_books FROM {{{{v_categories}}}}) THEN 'skip_non_text' WHEN kind = 'EDITED' THEN 'keep_edited' WHEN p.title IS NOT NULL THEN 'wiki' ELSE 'search' END AS action,
          coalesce(kind, '') AS kind, coalesce(p.lang, '') AS lang, coalesce(p.title, '') AS title, coalesce(line, '') AS line, coalesce(job, 'no text') AS job
          FROM {{{{v_books}}}} b LEFT JOIN picked p ON p.fk_books = b.pk LEFT JOIN kinds k ON k.fk_books = b.pk LEFT JOIN lines l ON l.fk_books = b.pk LEFT JOIN t ON t.fk_books = b.pk)
        SELECT pk, action, kind, CASE action WHEN 'wiki' THEN lang ELSE '' END AS wiki_lang, CASE action WHEN 'wiki' THEN title ELSE '' END AS wiki_title,
          CASE action WHEN 'search' THEN concat(line, ' wikipedia') ELSE '' END AS search_for, CASE action WHEN 'search' THEN job ELSE '' END AS text_job FROM a""",
    ),
    "fn_content_hash": Entry(
        lambda c: c["pages"].select("page_id", inventory.content_hash(F.encode("html", "UTF-8")).alias("hash"), F.octet_length("html").cast("bigint").alias("n_bytes")),
        "SELECT page_id, sha256(html) AS hash, CAST(strlen(html) AS BIGINT) AS n_bytes FROM {{pages}}",
    ),
}
