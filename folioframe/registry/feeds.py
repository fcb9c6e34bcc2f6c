"""Registered queries: catalog feed, MARC fields and records, RDF triples, names, titles, paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import paths, people, titles
from ..operators.lists import ordered_list
from ..plans import catalog_feed, marc_feed, rdf_feed
from .base import Entry

DAY = "2024-06-30"


def life(first: str, second: str) -> str:
    return f"""(SELECT CASE WHEN y IS NULL THEN '' ELSE concat(CASE WHEN y < 0 THEN abs(y - 1) ELSE y END, CASE WHEN unsure THEN '?' ELSE '' END, CASE WHEN y < 0 THEN ' BCE' ELSE '' END) END
      FROM (SELECT CASE WHEN one IS NULL THEN two WHEN two IS NOT NULL AND two <> one THEN greatest(one, two) ELSE one END AS y,
                   (one IS NULL AND two IS NOT NULL) OR (one <> two AND two IS NOT NULL) AS unsure
            FROM (SELECT nullif({first}, 0) AS one, nullif({second}, 0) AS two)))"""


BORN_DIED = f"concat({life('birthdate', 'birthdate2')}, '-', {life('deathdate', 'deathdate2')})"
DATED = "(coalesce(birthdate, 0) <> 0 OR coalesce(deathdate, 0) <> 0)"
BRACKET = r"regexp_extract(name, '(\s*\([^)]*\))', 1)"
COMMA = f"CASE WHEN {DATED} THEN ',' ELSE '' END"
NAME_A = f"CASE WHEN {BRACKET} = '' THEN concat(name, {COMMA}) ELSE replace(name, {BRACKET}, '') END"
NAME_Q = f"CASE WHEN {BRACKET} <> '' THEN concat(trim({BRACKET}), {COMMA}) END"
SHOWN = f"""concat(name, CASE WHEN {DATED} THEN concat(', ', {BORN_DIED}) ELSE '' END,
  CASE marcrel WHEN 'aut' THEN '' WHEN 'cre' THEN '' WHEN 'edt' THEN ' [Editor]' WHEN 'trl' THEN ' [Translator]' ELSE concat(' [', marcrel, ']') END)"""
LISTS = f"""rel AS (
  SELECT fk_books, kind, pos, value FROM {{{{v_book_terms}}}}
  UNION ALL SELECT fk_books, 'author', heading, {SHOWN} FROM {{{{v_book_authors}}}} JOIN {{{{v_authors}}}} ON fk_authors = id),
lists AS (SELECT fk_books, {', '.join(f"coalesce(string_agg(value, '; ' ORDER BY pos, value) FILTER (WHERE kind = '{k}'), '') AS {n}" for k, n in catalog_feed.RELATIONS.items())} FROM rel GROUP BY 1)"""
MAIN_A = "CASE WHEN instr(text, chr(10)) > 0 THEN concat(split_part(text, chr(10), 1), ' :') ELSE text END"
REST_B = "CASE WHEN instr(text, chr(10)) > 0 THEN replace(substr(text, instr(text, chr(10)) + 1), chr(10), ' ') END"
FIXED_008 = "concat('240630', 'r', strftime(release_date, '%Y'), coalesce(published, '||||'), 'utu|||||o|||||||||||||| d')"
FIRST_DATED = """dated AS (
  SELECT fk_books, arg_min(text, (pk, text)) FILTER (WHERE fk_attriblist = 906) AS published, arg_min(text, (pk, text)) FILTER (WHERE fk_attriblist = 260) AS imprint
  FROM {{v_attributes}} WHERE fk_attriblist IN (260, 906) GROUP BY 1)"""
CHOSEN = """chosen AS (SELECT pk, release_date FROM {{v_books}} WHERE pk >= 1 AND pk <> 99999 AND pk NOT IN (SELECT fk_books FROM {{v_categories}}))"""
HEADED = """headed AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY fk_books ORDER BY heading, fk_authors) = 1 THEN '100' ELSE '700' END AS tag FROM {{v_book_authors}})"""
_ATT = "\n  UNION ALL ".join(
    f"SELECT fk_books AS pk, '{tag}' AS tag, 0 AS grp, pk AS ord, concat('{ind[0]}', {'coalesce(nonfiling, 0)' if ind[1] == 'n' else repr(ind[1])}) AS ind, "
    + (f"concat('$a', {MAIN_A}, coalesce('$b' || {REST_B}, ''))" if tag == "245" else f"concat('${sub}', {'replace(text, chr(10), chr(32))' if tag == '500' else 'text'})")
    + f" AS content FROM {{{{v_attributes}}}} WHERE fk_attriblist = {code}"
    for code, tag, ind, sub in marc_feed.ATTRIBUTE_FIELDS
)
_BOOK = "\n  UNION ALL ".join(
    f"SELECT pk, '{tag}', {grp}, 0, '{ind}', {content} FROM chosen LEFT JOIN dated ON pk = fk_books"
    for tag, grp, ind, content in (
        ("001", 0, "", "CAST(pk AS VARCHAR)"),
        ("003", 0, "", "'XxExLib'"),
        ("006", 0, "", "'m'"),
        ("007", 0, "", "'cr n'"),
        ("008", 0, "", FIXED_008),
        ("040", 0, "  ", "'$aXxExLib'"),
        ("264", 0, " 1", "concat('$aExample City :$bExample Library,$c', strftime(release_date, '%Y'))"),
        ("300", 1, "  ", "'$a1 online resource :$bmultiple file formats'"),
        ("336", 1, "  ", "'$atext$btxt$2rdacontent'"),
        ("337", 1, "  ", "'$acomputer$bc$2rdamedia'"),
        ("338", 1, "  ", "'$aonline resource$bcr$2rdacarrier'"),
        ("500", 1, "  ", "concat('$aRelease date is ', strftime(release_date, '%Y-%m-%d'))"),
        ("534", 0, "  ", "CASE WHEN imprint IS NULL THEN '$nOriginal publication data not identified' ELSE concat('$pOriginally published:$c', imprint) END"),
        ("856", 1, "40", "concat('$uhttps://library.example.org/ebooks/', pk)"),
    )
)
MARC = f"""{CHOSEN}, {FIRST_DATED}, {HEADED},
related AS ({_ATT}
  UNION ALL SELECT fk_books, tag, 0, heading, '1 ', concat('$a', {NAME_A}, coalesce('$q' || {NAME_Q}, ''), CASE WHEN {DATED} THEN concat('$d', {BORN_DIED}) ELSE '' END)
    FROM headed JOIN {{{{v_authors}}}} ON fk_authors = id
  UNION ALL SELECT fk_books, '653', 0, pos, '  ', concat('$a', value) FROM {{{{v_book_terms}}}} WHERE kind = 'subject'
  UNION ALL SELECT fk_books, '041', 0, 0, ' 7', concat(string_agg('$a' || value, '' ORDER BY pos, value), '$2iso639-1') FROM {{{{v_book_terms}}}} WHERE kind = 'lang' GROUP BY 1
  UNION ALL SELECT fk_books, '050', 0, 0, ' 4', string_agg('$a' || value, '' ORDER BY pos, value) FROM {{{{v_book_terms}}}} WHERE kind = 'locc' GROUP BY 1),
marc(pk, tag, grp, ord, ind, content) AS (
  SELECT pk, tag, grp, ord, ind, content FROM related WHERE pk IN (SELECT pk FROM chosen)
  UNION ALL {_BOOK})"""


def marc(c, asof: str = DAY):
    return marc_feed.marc_fields(
        c["v_books"], c["v_categories"], c["v_attributes"], c["v_book_authors"], c["v_authors"], c["v_book_terms"], asof
    )


def _shown_fields(fields):
    return fields.select(
        "pk", "tag", "grp", "ord", F.concat("ind1", "ind2").alias("ind"), F.coalesce("data", marc_feed.subfield_text(F.col("subfields"))).alias("content")
    )


def _line(f):
    return F.concat(f["tag"], f["ind1"], f["ind2"], F.coalesce(f["data"], marc_feed.subfield_text(f["subfields"])))


LINES = "string_agg(concat(tag, ind, content), chr(10) ORDER BY concat(tag, ind, content))"


def catalog(c):
    return catalog_feed.catalog(c["v_books"], c["v_attributes"], c["v_book_terms"], c["v_book_authors"], c["v_authors"])


def triples(c, by_book: bool = False):
    return rdf_feed.rdf_triples(
        c["v_books"], c["v_attributes"], c["v_book_authors"], c["v_authors"], c["v_author_aliases"], c["v_author_webpages"], c["v_book_terms"], c["v_files"],
        by_book=by_book,
    )


_D, _R, _O, _X = rdf_feed.DCTERMS, rdf_feed.RDF, "https://library.example.org/terms/", rdf_feed.XSD
_B = "concat('https://library.example.org/ebooks/', {})"
_NODE = "concat('_:n', substr(sha256(concat_ws('|', {}, {}, {})), 1, 24))"
_A = "concat('https://library.example.org/agents/', fk_authors)"


def _rows(source: str, book: str, *rows: tuple) -> str:
    made = []
    for s, p, o, kind, datatype, *where in rows:
        made.append(f"SELECT {book} AS book, {s} AS s, {p} AS p, CAST({o} AS VARCHAR) AS o, '{kind}' AS o_kind, {datatype} AS datatype FROM {source}" + (f" WHERE {where[0]}" if where else ""))
    return "\nUNION ALL ".join(made)


_SITE = "'https://library.example.org/'"
_KIND = lambda i: "CASE kind " + " ".join(
    f"WHEN '{k}' THEN '{v[i]}'"
    for k, v in {
        "lang": (_D + "language", "", _D + "RFC4646"),
        "subject": (_D + "subject", _D + "LCSH", ""),
        "locc": (_D + "subject", _D + "LCC", ""),
        "type": (_D + "type", _D + "DCMIType", ""),
        "shelf": (_O + "bookshelf", _O + "Bookshelf", ""),
    }.items()
) + " END"
_BF = _B.format("fk_books")
_TN = _NODE.format(_BF, "kind", "value")
_URL = "concat('https://library.example.org/', archive_path)"
_MEDIA = "CASE fk_filetypes WHEN 'txt' THEN 'text/plain' WHEN 'html' THEN 'text/html' WHEN 'rst' THEN 'text/x-rst' END"
_MN = _NODE.format(_URL, "'format'", _MEDIA)
TRIPLES_SQL = "\nUNION ALL ".join(
    [
        _rows(
            "{{v_books}}", "pk",
            (_SITE, f"'{rdf_feed.CC}license'", "'https://creativecommons.org/publicdomain/zero/1.0/'", "uri", "''"),
            (_SITE, f"'{_R}type'", f"'{rdf_feed.CC}Work'", "uri", "''"),
            (_SITE, f"'{rdf_feed.RDFS}comment'", "'Archives of all RDF files are published at https://library.example.org/'", "literal", "''"),
            (_B.format("pk"), f"'{_R}type'", f"'{_O}ebook'", "uri", "''"),
            (_B.format("pk"), f"'{_D}publisher'", "'Example Library'", "literal", "''"),
            (_B.format("pk"), f"'{_D}license'", "'https://library.example.org/license'", "uri", "''"),
            (_B.format("pk"), f"'{_D}issued'", "release_date", "literal", f"'{_X}date'"),
            (_B.format("pk"), f"'{_D}rights'", "rights", "literal", "''"),
            (_B.format("pk"), f"'{_O}downloads'", "downloads", "literal", f"'{_X}integer'"),
        ),
        _rows(
            "{{v_book_authors}} JOIN {{v_authors}} ON fk_authors = id", "fk_books",
            (_A, f"'{_R}type'", f"'{_O}agent'", "uri", "''"),
            (_A, f"'{_O}name'", "name", "literal", "''"),
            (_A, f"'{_O}birthdate'", "birthdate", "literal", f"'{_X}integer'", "birthdate <> 0"),
            (_A, f"'{_O}deathdate'", "deathdate", "literal", f"'{_X}integer'", "deathdate <> 0"),
            (_BF, f"CASE WHEN marcrel IN ('aut', 'cre') THEN '{_D}creator' ELSE '{rdf_feed.MARCREL}' || marcrel END", _A, "uri", "''"),
        ),
        _rows("{{v_book_authors}} JOIN {{v_author_aliases}} USING (fk_authors)", "fk_books", (_A, f"'{_O}alias'", "alias", "literal", "''")),
        _rows(
            "{{v_book_authors}} JOIN {{v_author_webpages}} USING (fk_authors)", "fk_books",
            ("url", f"'{_D}description'", "description", "literal", "''"),
            (_A, f"'{_O}webpage'", "url", "uri", "''"),
        ),
        _rows(
            "(SELECT DISTINCT fk_books, fk_attriblist, text FROM {{v_attributes}})", "fk_books",
            (_BF, f"CASE fk_attriblist WHEN 240 THEN '{_D}alternative' WHEN 245 THEN '{_D}title' WHEN 246 THEN '{_D}alternative' WHEN 500 THEN '{_D}description' WHEN 505 THEN '{_D}tableOfContents' ELSE concat('{_O}marc', fk_attriblist) END", "text", "literal", "''"),
        ),
        _rows(
            "(SELECT DISTINCT fk_books, kind, value FROM {{v_book_terms}})", "fk_books",
            (_BF, _KIND(0), _TN, "blank", "''"),
            (_TN, f"'{rdf_feed.DCAM}memberOf'", _KIND(1), "uri", "''", "kind <> 'lang'"),
            (_TN, f"'{_R}value'", "value", "literal", _KIND(2)),
        ),
        _rows(
            "(SELECT DISTINCT fk_books, archive_path, fk_filetypes, extent, modified FROM {{v_files}})", "fk_books",
            (_URL, f"'{_R}type'", f"'{_O}file'", "uri", "''"),
            (_BF, f"'{_D}hasFormat'", _URL, "uri", "''"),
            (_URL, f"'{_D}isFormatOf'", _BF, "uri", "''"),
            (_URL, f"'{_D}extent'", "extent", "literal", f"'{_X}integer'"),
            (_URL, f"'{_D}modified'", "strftime(modified, '%Y-%m-%dT%H:%M:%S')", "literal", f"'{_X}dateTime'"),
            (_URL, f"'{_D}format'", _MN, "blank", "''", "fk_filetypes IS NOT NULL"),
            (_MN, f"'{rdf_feed.DCAM}memberOf'", f"'{_D}IMT'", "uri", "''", "fk_filetypes IS NOT NULL"),
            (_MN, f"'{_R}value'", _MEDIA, "literal", f"'{_D}IMT'", "fk_filetypes IS NOT NULL"),
        ),
    ]
)


def _life_columns():
    return [F.col(c) for c in ("birthdate", "birthdate2", "deathdate", "deathdate2")]


def _dated():
    return people.has_dates(F.col("birthdate"), F.col("deathdate"))


CATALOG_SQL = f"""WITH {LISTS}
SELECT pk AS text_no, coalesce(types, '') AS type, strftime(release_date, '%Y-%m-%d') AS issued, coalesce(title, '') AS title, coalesce(languages, '') AS language,
       coalesce(authors, '') AS authors, coalesce(subjects, '') AS subjects, coalesce(loccs, '') AS locc, coalesce(shelves, '') AS bookshelves
FROM {{{{v_books}}}} b LEFT JOIN lists l ON l.fk_books = pk LEFT JOIN {{{{v_titles}}}} t ON t.fk_books = pk WHERE pk <> 99999"""

ENTRIES: dict[str, Entry] = {
    "catalog_csv": Entry(catalog, CATALOG_SQL),
    "agg_joined_list": Entry(
        lambda c: ordered_list(c["v_book_terms"].filter(F.col("kind") == "subject"), ["fk_books"], "pos", "value", "subjects"),
        "SELECT fk_books, string_agg(value, '; ' ORDER BY pos, value) AS subjects FROM {{v_book_terms}} WHERE kind = 'subject' GROUP BY 1",
    ),
    "join_book_relations": Entry(
        lambda c: catalog_feed.book_relations(c["v_books"].select("pk", "downloads"), c["v_book_terms"], c["v_book_authors"], c["v_authors"]),
        f"""WITH {LISTS} SELECT pk, downloads, {', '.join(f"coalesce({n}, '') AS {n}" for n in catalog_feed.RELATIONS.values())}
        FROM {{{{v_books}}}} LEFT JOIN lists ON fk_books = pk""",
    ),
    "agg_feed_summary": Entry(
        lambda c: catalog_feed.feed_summary(c["v_books"], c["v_languages"], c["v_categories"]).select(F.coalesce("lang", F.lit("all")).alias("lang"), F.coalesce("non_text", F.lit(-1)).alias("non_text"), F.coalesce("year", F.lit(-1)).alias("year"), "level", "n_books", "downloads"),
        """WITH firsts AS (SELECT fk_books, arg_min(lang, (pos, lang)) AS lang FROM {{v_languages}} GROUP BY 1),
        rows AS (SELECT coalesce(lang, 'en') AS lang, CASE WHEN pk IN (SELECT fk_books FROM {{v_categories}}) THEN 1 ELSE 0 END AS non_text, year(release_date) AS year, downloads
                 FROM {{v_books}} LEFT JOIN firsts ON pk = fk_books)
        SELECT coalesce(lang, 'all') AS lang, CAST(coalesce(non_text, -1) AS INTEGER) AS non_text, CAST(coalesce(year, -1) AS INTEGER) AS year, CAST(grouping(lang, non_text, year) AS INTEGER) AS level,
               CAST(count(*) AS BIGINT) AS n_books, CAST(sum(downloads) AS BIGINT) AS downloads FROM rows GROUP BY CUBE (lang, non_text, year)""",
    ),
    "rank_main_language": Entry(
        lambda c: catalog_feed.main_languages(c["v_books"].select("pk"), c["v_languages"]),
        "SELECT pk, coalesce((SELECT arg_min(lang, (pos, lang)) FROM {{v_languages}} WHERE fk_books = pk), 'en') AS lang FROM {{v_books}}",
    ),
    "rank_authors": Entry(
        lambda c: marc_feed.heading_order(c["v_book_authors"]),
        f"WITH {HEADED} SELECT * FROM headed",
    ),
    "first_dated_attr": Entry(
        lambda c: marc_feed.first_dated(c["v_attributes"]).select("pk", F.coalesce("published", F.lit("")).alias("published"), F.coalesce("imprint", F.lit("")).alias("imprint")),
        f"WITH {FIRST_DATED} SELECT fk_books AS pk, coalesce(published, '') AS published, coalesce(imprint, '') AS imprint FROM dated",
    ),
    "marc_fields": Entry(lambda c: _shown_fields(marc(c)), f"WITH {MARC} SELECT pk, tag, grp, ord, ind, content FROM marc"),
    "order_marc_fields": Entry(
        lambda c: _shown_fields(marc_feed.in_record_order(marc(c))), f"WITH {MARC} SELECT pk, tag, grp, ord, ind, content FROM marc ORDER BY pk, tag, grp, ord, content"
    ),
    "agg_marc_record": Entry(
        lambda c: marc_feed.records(marc(c)).select(
            "pk",
            "n_bytes",
            F.size("fields").cast("bigint").alias("n_fields"),
            F.array_join(F.transform("fields", lambda f: f["tag"]), " ").alias("tags"),
            F.array_join(F.array_sort(F.transform("fields", _line)), "\n").alias("content"),
        ),
        f"""WITH {MARC} SELECT pk, CAST(26 + sum(13 + strlen(replace(replace(content, '$', '-'), '', '')) + length(ind)) AS BIGINT) AS n_bytes,
        CAST(count(*) AS BIGINT) AS n_fields, string_agg(tag, ' ' ORDER BY tag) AS tags, {LINES} AS content FROM marc GROUP BY pk""",
    ),
    "rdf_triples": Entry(triples, TRIPLES_SQL),
    "lookup_marc_predicate": Entry(
        lambda c: c["v_attributes"].select("pk", "text", rdf_feed.marc_predicate(F.col("fk_attriblist")).alias("predicate")),
        f"""SELECT pk, text, CASE fk_attriblist WHEN 245 THEN '{_D}title' WHEN 500 THEN '{_D}description' WHEN 505 THEN '{_D}tableOfContents'
        WHEN 240 THEN '{_D}alternative' WHEN 246 THEN '{_D}alternative' ELSE concat('{_O}marc', fk_attriblist) END AS predicate FROM {{{{v_attributes}}}}""",
    ),
    "fn_author_name_parts": Entry(
        lambda c: c["v_authors"].select("id", people.heading_name(F.col("name"), _dated()).alias("a"), F.coalesce(people.heading_fuller_name(F.col("name"), _dated()), F.lit("")).alias("q")),
        f"SELECT id, {NAME_A} AS a, coalesce({NAME_Q}, '') AS q FROM {{{{v_authors}}}}",
    ),
    "fn_author_dates": Entry(
        lambda c: c["v_authors"].select("id", people.life_dates(*_life_columns()).alias("dates")),
        f"SELECT id, {BORN_DIED} AS dates FROM {{{{v_authors}}}}",
    ),
    "fn_author_display": Entry(
        lambda c: catalog_feed.author_terms(c["v_book_authors"], c["v_authors"]).select("fk_books", "pos", "value"),
        f"SELECT fk_books, heading AS pos, {SHOWN} AS value FROM {{{{v_book_authors}}}} JOIN {{{{v_authors}}}} ON fk_authors = id",
    ),
    "fn_title_split": Entry(
        lambda c: c["v_titles"].select("fk_books", titles.main_title(F.col("title")).alias("a"), F.coalesce(titles.rest_of_title(F.col("title")), F.lit("")).alias("b")),
        f"SELECT fk_books, {MAIN_A.replace('text', 'title')} AS a, coalesce({REST_B.replace('text', 'title')}, '') AS b FROM {{{{v_titles}}}}",
    ),
    "fn_clean_title": Entry(
        lambda c: c["documents"].select("doc_id", titles.clean_title(F.col("text")).alias("title")),
        r"SELECT doc_id, regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s*\n\s*', chr(10), 'g') AS title FROM {{documents}}",
    ),
    "fn_flatten_note": Entry(
        lambda c: c["documents"].select("doc_id", titles.flatten(F.col("text")).alias("note")),
        "SELECT doc_id, replace(text, chr(10), ' ') AS note FROM {{documents}}",
    ),
    "fn_rights_flag": Entry(
        lambda c: c["v_books"].select("pk", titles.rights_flag(F.col("rights")).alias("rights")),
        "SELECT pk, CASE WHEN rights ILIKE '%copyright%' THEN '1' ELSE rights END AS rights FROM {{v_books}}",
    ),
    "fn_marc_008": Entry(
        lambda c: c["v_books"].join(marc_feed.first_dated(c["v_attributes"]), "pk", "left").select("pk", titles.fixed_field_008(DAY, F.col("release_date"), F.col("published")).alias("field_008")),
        f"WITH {FIRST_DATED} SELECT pk, {FIXED_008} AS field_008 FROM {{{{v_books}}}} LEFT JOIN dated ON pk = fk_books",
    ),
    "fn_iso_date": Entry(
        lambda c: c["v_books"].select("pk", titles.iso_date(F.col("release_date")).alias("issued"), F.date_format("release_date", "yyyy").alias("year")),
        "SELECT pk, strftime(release_date, '%Y-%m-%d') AS issued, strftime(release_date, '%Y') AS year FROM {{v_books}}",
    ),
    "fn_path_parts": Entry(
        lambda c: c["v_files"].select("id", *[f(F.col("archive_path")).alias(n) for n, f in (("base", paths.base_name), ("ext", paths.extension), ("dir", paths.dir_name), ("include", paths.include_glob))]),
        r"""SELECT id, regexp_extract(archive_path, '[^/]*$') AS base, regexp_extract(archive_path, '\.[a-z]+$') AS ext, regexp_replace(archive_path, '/[^/]*$', '') AS dir,
        regexp_replace(archive_path, '[^/]*$', '*') AS include FROM {{v_files}}""",
    ),
    "fn_sort_key_names": Entry(
        lambda c: c["v_files"].select("id", paths.metadata_key(F.col("archive_path")).alias("sort_key")),
        r"""SELECT id, concat(CASE regexp_extract(archive_path, '\.[a-z]+$') WHEN '.rst' THEN '00 ' WHEN '.html' THEN '01 ' WHEN '.htm' THEN '02 ' WHEN '.tex' THEN '03 ' WHEN '.txt' THEN '04 ' ELSE '99' END,
        regexp_replace(archive_path, '\.[a-z]+$', ''), '-z') AS sort_key FROM {{v_files}}""",
    ),
    "fn_url_join": Entry(
        lambda c: c["v_img_log"].select("src", "img_id", "rel_url", paths.join_url(F.col("src"), F.col("rel_url")).alias("url")),
        """SELECT src, img_id, rel_url, regexp_replace(src, '[^/]*$', '') || replace(replace(rel_url, './', ''), 'images/.images', 'images') AS url
        FROM (SELECT src, img_id, rel_url FROM {{v_img_log}})""",
    ),
}
