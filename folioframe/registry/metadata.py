"""Registered queries: file listings, submissions, headers, contacts, credits."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import submissions as sub
from ..functions import texts
from ..operators.candidates import candidates
from ..plans import intake
from ..sources import files as src
from .base import Entry
from .selection import CANDS, GLOBS, RANKED

NL = "chr(10)"


@F.pandas_udf(T.BinaryType())
def _zipped(name: pd.Series, text: pd.Series, bad: pd.Series) -> pd.Series:
    """Archives for the reader to open: a text, a page, and a picture that is not parseable."""
    made = []
    for n, t, broken in zip(name, text, bad):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(f"{n}/{n}-0.txt", t)
            archive.writestr(f"{n}/images/cover.jpg", b"\xff\xd8")
            archive.writestr(f"{n}/{n}-h.htm", f"<html>{t}</html>")
        made.append(b"PK" + t.encode()[:40] if broken else buffer.getvalue())
    return pd.Series(made)


def _archives(c):
    made = _zipped(F.col("fk_books").cast("string"), F.col("raw"), F.col("lang") == "es")
    return c["v_wrapped_texts"].select("fk_books", made.alias("content"))


def _members(c):
    return src.zip_members(_archives(c)).select(
        "fk_books", F.coalesce("name", F.lit("")).alias("name"), F.coalesce(F.sha2("text", 256), F.lit("")).alias("text_hash"), F.coalesce("sort_key", F.lit("")).alias("sort_key"), F.coalesce("problem", F.lit("")).alias("problem")
    )


ZIP_SQL = """SELECT fk_books, concat(fk_books, '/', fk_books, '-0.txt') AS name, sha256(raw) AS text_hash, concat('04 ', fk_books, '/', fk_books, '-0-z') AS sort_key, '' AS problem FROM {{v_wrapped_texts}} WHERE lang <> 'es'
UNION ALL SELECT fk_books, concat(fk_books, '/', fk_books, '-h.htm'), sha256(concat('<html>', raw, '</html>')), concat('02 ', fk_books, '/', fk_books, '-h-z'), '' FROM {{v_wrapped_texts}} WHERE lang <> 'es'
UNION ALL SELECT fk_books, '', '', '', 'BadZipFile' FROM {{v_wrapped_texts}} WHERE lang = 'es'"""


def _artifact_listing(c):
    folder = F.when(F.col("type") == "summary", F.concat(F.col("fk_books"), F.lit(".delete"))).when(F.col("type") == "kindle.images", F.concat(F.lit("DELETE"), F.col("fk_books"))).otherwise(F.col("fk_books").cast("string"))
    name = F.when(F.col("type") == "rdf", "pg{}.rdf").when(F.col("type") == "cover.medium", "pg{}.jpg").otherwise("pg{}.txt")
    path = F.concat(F.lit("/cache/epub/"), folder, F.lit("/"), F.replace(name, F.lit("{}"), F.col("fk_books").cast("string")))
    return c["v_targets"].select(path.alias("path"), F.length("type").cast("bigint").alias("length"))


ARTIFACTS = """listing AS (SELECT concat('/cache/epub/', CASE type WHEN 'summary' THEN concat(fk_books, '.delete') WHEN 'kindle.images' THEN concat('DELETE', fk_books) ELSE CAST(fk_books AS VARCHAR) END, '/pg', fk_books,
  CASE type WHEN 'rdf' THEN '.rdf' WHEN 'cover.medium' THEN '.jpg' ELSE '.txt' END) AS path, CAST(length(type) AS BIGINT) AS length, type FROM {{v_targets}})"""


def _spool(c):
    """Files of a spool folder made from the submissions."""
    return c["v_submissions"].select("path", F.col("content").alias("text"))


def _workflow_files(c):
    return c["v_workflow"].select("ebook", F.col("json").alias("text"))


def _shown(records):
    return records.select(
        "ebook", "valid", *[F.coalesce(n, F.lit("")).alias(n) for n in ("title", "language", "publisher", "credit", "notify", "ww")],
        F.coalesce(sub.events_text(F.col("years")), F.lit("")).alias("years"), F.coalesce(F.array_join("scan_urls", ";"), F.lit("")).alias("scan_urls"),
    )


def _j(field: str, source: str = "json") -> str:
    return f"coalesce(json_extract_string({source}, '$.DATA.{field}'), '')"


YEARS = """CASE json_type(json, '$.DATA.SOURCE_PUBLICATION_YEARS') WHEN 'VARCHAR' THEN replace(json_extract_string(json, '$.DATA.SOURCE_PUBLICATION_YEARS'), ':', '=')
  ELSE 'copyright=1920;reprint=1955;copyright=1972' END"""
RECORD = f"""ebook, true AS valid, {_j('TITLE')} AS title, {_j('LANGUAGE')} AS language, {_j('PUBLISHER')} AS publisher, {_j('CREDIT')} AS credit,
{_j('NOTIFY')} AS notify, {_j('WW')} AS ww, {YEARS} AS years, {_j('SCANS_ARCHIVE_URL')} AS scan_urls"""
MAIL = "CASE WHEN instr({0}, '@') > 0 THEN {0} ELSE concat(trim({0}), '@library.example.org') END"
SUB_RANK = r"""CASE WHEN path LIKE '%/backup/%' THEN CASE WHEN regexp_matches(path, '/[0-9]+\.json$') THEN 1 WHEN regexp_matches(path, '/[0-9]+\.json\.[0-9]$') THEN 10 + CAST(right(path, 1) AS INTEGER) END
  WHEN path LIKE '%.json' THEN 100 WHEN path LIKE '%.txt' THEN 99 END"""
NEWEST = f"""ranked AS (SELECT *, {SUB_RANK} AS rnk FROM {{{{v_submissions}}}}),
newest AS (SELECT ebook, arg_max(path, rnk) AS path, arg_max(content, rnk) AS content FROM ranked WHERE rnk IS NOT NULL GROUP BY 1)"""
HEAD = r"""heads AS (SELECT ebook, path, concat(CASE WHEN path LIKE '%.htm' THEN '02 ' ELSE '04 ' END, regexp_replace(path, '\.[a-z]+$', ''), '-z') AS sort_key,
  concat('Book ', ebook) AS title, 'Ann Author; Bob Second' AS authors, '2021-07-21' AS released, n_chars, source, lang,
  CASE WHEN n_chars > 9000 THEN ebook + 1 ELSE ebook END AS book_id, lang AS language, CASE WHEN source < 'src15' THEN concat('Helper ', source) ELSE '' END AS credit
  FROM {{v_header_files}} JOIN {{documents}} ON doc_id = ebook)"""


def _header_rows(c):
    return intake.header_rows(c["v_header_files"])


def _file_texts(c):
    """A text for each candidate file of a book, whose credit names the file."""
    raw = F.regexp_replace("raw", F.lit("(Helper src[0-9]+)"), F.concat(F.lit("$1 of "), F.col("path")))
    files = candidates(c["v_files"]).select("fk_books", F.col("archive_path").alias("path")).distinct()
    return files.join(c["v_wrapped_texts"], "fk_books").select("fk_books", "path", raw.alias("raw"))


def _arrivals(c):
    return c["events"].filter(F.col("event_type") == "signup").select(F.concat("user_id", F.lit(".json")).alias("name"), F.col("event_id").alias("seq"))


def _slots(c):
    return c["events"].filter((F.col("event_type") == "click") & (F.col("value") < 9)).select(F.concat("user_id", F.lit(".json")).alias("name"), (F.floor("value") - 1).cast("int").alias("slot"))


def _creditless_sql(body: str) -> str:
    return f"WITH creditless AS (SELECT fk_books FROM {{{{v_attributes}}}} EXCEPT SELECT fk_books FROM {{{{v_attributes}}}} WHERE fk_attriblist = 508) {body}"


CREDITS = """credits AS (SELECT *, max(CASE WHEN text NOT LIKE 'Updated:%' THEN length(text) END) OVER (PARTITION BY fk_books) AS longest FROM {{v_attributes}} WHERE fk_attriblist = 508)"""

ENTRIES: dict[str, Entry] = {
    "scan_artifacts": Entry(
        lambda c: src.scan_artifacts(_artifact_listing(c), "txt"),
        f"WITH {ARTIFACTS} SELECT path, length FROM listing WHERE type NOT IN ('summary', 'kindle.images', 'rdf', 'cover.medium') ORDER BY path",
    ),
    "scan_book_dir": Entry(
        lambda c: src.scan_book_dir(c["v_header_files"].select(F.concat("path", F.when(F.length("text") > 3000, ".rst").otherwise("")).alias("path"), F.length("text").cast("bigint").alias("length"))).drop("length"),
        r"""WITH f AS (SELECT ebook, CASE WHEN length(text) > 3000 THEN concat(path, '.rst') ELSE path END AS path FROM {{v_header_files}})
        SELECT path, ebook, concat(CASE right(path, 4) WHEN '.rst' THEN '00 ' WHEN '.htm' THEN '02 ' ELSE '04 ' END, left(path, length(path) - 4), '-z') AS sort_key FROM f""",
    ),
    "read_zip_members": Entry(_members, ZIP_SQL),
    "udtf_zip_members": Entry(
        lambda c: _archives(c).lateralJoin(src.ZipMembers(F.col("content").outer())).select("fk_books", F.coalesce("name", F.lit("")).alias("name"), F.coalesce(F.octet_length("data"), F.lit(-1)).cast("bigint").alias("n_bytes")),
        """SELECT fk_books, concat(fk_books, '/', fk_books, '-0.txt') AS name, CAST(strlen(raw) AS BIGINT) AS n_bytes FROM {{v_wrapped_texts}} WHERE lang <> 'es'
        UNION ALL SELECT fk_books, concat(fk_books, '/', fk_books, '-h.htm'), CAST(strlen(raw) + 13 AS BIGINT) FROM {{v_wrapped_texts}} WHERE lang <> 'es'
        UNION ALL SELECT fk_books, concat(fk_books, '/images/cover.jpg'), 2 FROM {{v_wrapped_texts}} WHERE lang <> 'es' UNION ALL SELECT fk_books, '', -1 FROM {{v_wrapped_texts}} WHERE lang = 'es'""",
    ),
    "read_workflow_json": Entry(
        lambda c: _shown(intake.workflow_records(src.spool_books(_spool(c).filter(~F.col("path").contains("/backup/")), r"\.json").drop("path"))),
        f"""WITH cur AS (SELECT ebook, content, CASE WHEN json_valid(content) THEN content ELSE '{{}}' END AS json FROM {{{{v_submissions}}}} WHERE path LIKE '%.json' AND path NOT LIKE '%/backup/%')
        SELECT {RECORD.replace("true AS valid", "json_valid(content) AS valid").replace("ELSE 'copyright=1920;reprint=1955;copyright=1972' END AS years", "WHEN 'ARRAY' THEN 'copyright=1920;reprint=1955;copyright=1972' ELSE '' END AS years")} FROM cur""",
    ),
    "read_trigger_files": Entry(
        lambda c: src.trigger_books(c["v_notice_queue"].select(F.concat(F.lit("/logs/dopush/"), F.col("ebook"), F.when(F.col("record").contains("1"), ".zip.trig").otherwise(".zip")).alias("path"))),
        "SELECT ebook, concat('/logs/dopush/', ebook, '.zip.trig') AS path FROM {{v_notice_queue}} WHERE record LIKE '%1%'",
    ),
    "read_notice_queue": Entry(
        lambda c: src.notice_queue(c["v_notice_queue"].select(F.concat(F.lit("/logs/notify/"), F.col("ebook"), F.lit(".txt")).alias("path"), F.when(F.col("record").contains("3"), "").otherwise(F.col("record")).alias("text"))),
        "SELECT ebook, record FROM {{v_notice_queue}} WHERE record NOT LIKE '%3%'",
    ),
    "decode_text": Entry(
        lambda c: c["v_texts"].select("fk_books", texts.decoded(F.when(F.col("lang") == "en", F.encode("text", "UTF-8")).otherwise(F.encode("text", "ISO-8859-1"))).alias("text")),
        r"SELECT fk_books, CASE WHEN lang = 'en' THEN text ELSE regexp_replace(text, '[^\x{00}-\x{FF}]', '?', 'g') END AS text FROM {{v_texts}}",
    ),
    "fn_scalar_or_list": Entry(
        lambda c: _workflow_files(c).select("ebook", F.array_join(sub.list_at(F.try_parse_json("text"), "$.DATA.SOURCE_PUBLICATION_YEARS"), ";").alias("years"), F.size(sub.list_at(F.try_parse_json("text"), "$.DATA.SCANS_ARCHIVE_URL")).alias("n_scans")),
        "SELECT p_partkey AS ebook, CASE WHEN p_size % 3 = 0 THEN 'copyright:1920' ELSE 'copyright:1920;reprint:1955;1972' END AS years, 1 AS n_scans FROM {{part}}",
    ),
    "fn_publication_events": Entry(
        lambda c: c["part"].select("p_partkey", sub.events_text(sub.publication_events(F.split(F.concat_ws(",", F.lit("reprint:1955"), F.col("p_size"), F.concat(F.col("p_name"), F.lit(":"), F.col("p_size")), F.when(F.col("p_size") > 20, "a:b:c").otherwise("")), ","))).alias("events")),
        "SELECT p_partkey, concat('reprint=1955;copyright=', p_size, ';', p_name, '=', p_size) AS events FROM {{part}}",
    ),
    "fn_normalize_email": Entry(
        lambda c: c["v_emails"].select("seq", F.coalesce(sub.normal_email(F.col("email")), F.lit("")).alias("email")),
        f"SELECT seq, CASE WHEN coalesce(email, '') = '' THEN '' ELSE {MAIL.format('email')} END AS email FROM {{{{v_emails}}}}",
    ),
    "join_workflow_catalog": Entry(
        lambda c: intake.workflow_records(_workflow_files(c)).filter("valid").join(c["v_books"].select(F.col("pk").alias("ebook"), "downloads"), "ebook").select("ebook", "title", "downloads"),
        f"SELECT ebook, {_j('TITLE')} AS title, downloads FROM {{{{v_workflow}}}} JOIN {{{{v_books}}}} ON ebook = pk",
    ),
    "merge_workflow": Entry(
        lambda c: intake.merge_workflow(c["v_book_meta"], intake.workflow_records(_workflow_files(c))).select(
            "pk", *[F.coalesce(n, F.lit("")).alias(n) for n in ("language", "publisher", "country", "request_key", "credit")],
            F.coalesce(sub.events_text(F.col("years")), F.lit("")).alias("years"), F.coalesce(F.array_join("scan_urls", ";"), F.lit("")).alias("scan_urls"), "changed"),
        f"""WITH s AS (SELECT {RECORD} FROM {{{{v_workflow}}}}),
        m AS (SELECT pk, CASE WHEN b.publisher IS NULL AND coalesce(first_language, 'en') = 'en' THEN s.language ELSE '' END AS language,
          CASE WHEN b.publisher IS NULL THEN s.publisher ELSE '' END AS publisher, '' AS country, '' AS request_key, CASE WHEN b.credit IS NULL THEN s.credit ELSE '' END AS credit,
          CASE WHEN b.publisher IS NULL THEN s.years ELSE '' END AS years, CASE WHEN scan_url IS NULL THEN s.scan_urls ELSE '' END AS scan_urls
          FROM {{{{v_book_meta}}}} b JOIN s ON pk = ebook)
        SELECT *, concat(language, publisher, credit, years, scan_urls) <> '' AS changed FROM m""",
    ),
    "pick_newest_workflow": Entry(
        lambda c: intake.pick_newest(c["v_submissions"]).select("ebook", "path"), f"WITH {NEWEST} SELECT ebook, path FROM newest"
    ),
    "reload_workflow": Entry(
        lambda c: _shown(intake.reload_workflow(c["v_submissions"])).select("ebook", "valid", "title", "language", "credit"),
        f"""WITH {NEWEST}, safe AS (SELECT ebook, json_valid(content) AS valid, CASE WHEN json_valid(content) THEN content ELSE '{{}}' END AS json FROM newest)
        SELECT ebook, valid, {_j('TITLE')} AS title, {_j('LANGUAGE')} AS language, {_j('CREDIT')} AS credit FROM safe""",
    ),
    "assign_revision": Entry(
        lambda c: intake.assign_revisions(_arrivals(c), _slots(c)).select("name", "seq", F.coalesce("slot", F.lit(-9)).alias("slot")),
        """WITH slots(slot) AS (SELECT CAST(x AS INTEGER) FROM generate_series(-1, 9) s(x)),
        used AS (SELECT DISTINCT concat(user_id, '.json') AS name, CAST(floor(value) - 1 AS INTEGER) AS slot FROM {{events}} WHERE event_type = 'click' AND value < 9),
        arrivals AS (SELECT concat(user_id, '.json') AS name, event_id AS seq, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM {{events}} WHERE event_type = 'signup'),
        free AS (SELECT n.name, s.slot, row_number() OVER (PARTITION BY n.name ORDER BY s.slot) AS nth FROM (SELECT DISTINCT name FROM arrivals) n CROSS JOIN slots s WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.name = n.name AND u.slot = s.slot))
        SELECT a.name, a.seq, coalesce(f.slot, -9) AS slot FROM arrivals a LEFT JOIN free f ON a.name = f.name AND a.nth = f.nth""",
    ),
    "contacts_from_workflow": Entry(
        lambda c: intake.contacts(intake.workflow_records(_workflow_files(c))),
        f"""WITH s AS (SELECT {RECORD} FROM {{{{v_workflow}}}})
        SELECT ebook, 'notify' AS role, {MAIL.format('notify')} AS email FROM s WHERE notify <> '' UNION ALL SELECT ebook, 'ww', {MAIL.format('ww')} FROM s WHERE ww <> ''""",
    ),
    "agg_address_book": Entry(
        lambda c: intake.address_book(c["v_emails"]),
        f"SELECT CAST(ebook AS BIGINT) AS ebook, role, arg_max({MAIL.format('email')}, seq) AS email FROM {{{{v_emails}}}} WHERE email IS NOT NULL GROUP BY 1, 2",
    ),
    "fn_parse_header": Entry(
        lambda c: c["v_wrapped_texts"].select("fk_books", *[col.alias(n) for n, col in texts.header_fields(F.col("raw")).items()]),
        """SELECT fk_books, concat('Book ', fk_books) AS title, 'Ann Author; Bob Second' AS authors, '2021-07-21' AS released, CASE WHEN n_chars > 9000 THEN fk_books + 1 ELSE fk_books END AS book_id,
        w.lang AS language, CASE WHEN source < 'src15' THEN concat('Helper ', source) ELSE '' END AS credit FROM {{v_wrapped_texts}} w JOIN {{documents}} ON doc_id = fk_books""",
    ),
    "join_header_trigger": Entry(
        lambda c: intake.check_trigger(_header_rows(c)).select("ebook", "path", "book_id", "status"),
        f"WITH {HEAD} SELECT ebook, path, book_id, CASE WHEN book_id = ebook THEN 'match' ELSE 'mismatch' END AS status FROM heads",
    ),
    "rank_metadata_source": Entry(
        lambda c: intake.best_headers(_header_rows(c)).select("ebook", "path"),
        f"WITH {HEAD} SELECT ebook, arg_min(path, sort_key) AS path FROM heads WHERE book_id = ebook GROUP BY 1",
    ),
    "intake_headers": Entry(
        lambda c: intake.intake(c["documents"].select(F.col("doc_id").alias("ebook")), intake.reload_workflow(c["v_submissions"]), c["v_header_files"]).select("ebook", "origin", *[F.coalesce(n, F.lit("")).alias(n) for n in ("path", "title", "language", "credit")]),
        f"""WITH {HEAD}, {NEWEST}, subs AS (SELECT ebook, content AS json FROM newest WHERE json_valid(content)),
        best AS (SELECT ebook, arg_min(path, sort_key) AS path, any_value(title) AS title, any_value(language) AS language, any_value(credit) AS credit FROM heads WHERE book_id = ebook GROUP BY 1)
        SELECT doc_id AS ebook, CASE WHEN s.json IS NOT NULL THEN 'workflow' WHEN b.path IS NOT NULL THEN 'header' ELSE 'none' END AS origin, CASE WHEN s.json IS NULL THEN coalesce(path, '') ELSE '' END AS path,
        CASE WHEN s.json IS NULL THEN coalesce(title, '') ELSE {_j('TITLE')} END AS title, CASE WHEN s.json IS NULL THEN coalesce(b.language, '') ELSE {_j('LANGUAGE')} END AS language,
        CASE WHEN s.json IS NULL THEN coalesce(credit, '') ELSE {_j('CREDIT')} END AS credit
        FROM {{{{documents}}}} LEFT JOIN subs s ON s.ebook = doc_id LEFT JOIN best b ON b.ebook = doc_id""",
    ),
    "agg_longest_credit": Entry(
        lambda c: intake.longest_credits(c["v_attributes"]),
        "SELECT fk_books, CAST(max(length(text)) AS INTEGER) AS longest, CAST(count(*) AS BIGINT) AS n_credits FROM {{v_attributes}} WHERE fk_attriblist = 508 AND text NOT LIKE 'Updated:%' GROUP BY 1",
    ),
    "clean_credits": Entry(
        lambda c: intake.credits_to_delete(c["v_attributes"]),
        f"""WITH {CREDITS} SELECT pk, fk_books, fk_attriblist, text, nonfiling, CASE WHEN text LIKE 'Updated:%' THEN 'update note' ELSE 'shorter' END AS why
        FROM credits WHERE text LIKE 'Updated:%' OR length(text) < longest""",
    ),
    "anti_creditless": Entry(lambda c: intake.creditless(c["v_attributes"]), _creditless_sql("SELECT fk_books FROM creditless ORDER BY fk_books DESC")),
    "fill_credits": Entry(
        lambda c: intake.fill_credits(c["v_attributes"], c["v_categories"], candidates(c["v_files"]), _file_texts(c)),
        _creditless_sql(f""", {CANDS}, {GLOBS}, {RANKED}
        SELECT r.fk_books, 508 AS fk_attriblist, concat('Helper ', source, ' of ', r.archive_path) AS text, r.archive_path AS source_path FROM ranked r JOIN creditless USING (fk_books) JOIN {{{{documents}}}} ON doc_id = r.fk_books
        WHERE family = 'html_first' AND place = 1 AND source < 'src15' AND r.fk_books NOT IN (SELECT fk_books FROM {{{{v_categories}}}})"""),
    ),
}
