"""The driver's tables presented in the catalog schema.

Each adapter is SQL both engines accept, so that the very same text feeds Spark and the DuckDB
check. `{{name}}` stands for a table or another adapter. Where the dialects part, the text holds
a `[[token]]` from DIALECT.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DIALECT = {
    "spark": {
        "digits": "regexp_replace(left(CAST(l_orderkey AS STRING), length(CAST(l_orderkey AS STRING)) - 1), '(.)', '$1/')",
        "bytes": "encode({0}, 'UTF-8')",
    },
    "duckdb": {
        "digits": r"regexp_replace(left(CAST(l_orderkey AS STRING), length(CAST(l_orderkey AS STRING)) - 1), '(.)', '\1/', 'g')",
        "bytes": "encode({0})",
    },
}

ADAPTERS: dict[str, str] = {
    "v_books": """
SELECT o_orderkey AS pk, CAST(o_orderdate AS DATE) AS release_date,
       CAST(floor(o_totalprice) AS BIGINT) AS downloads,
       CASE WHEN o_orderstatus = 'P' THEN 'Copyrighted.' ELSE 'Public domain in the USA.' END AS rights
FROM {{orders}}""",
    "v_categories": """
SELECT o_orderkey AS fk_books, 'Sound' AS category FROM {{orders}} WHERE o_orderpriority = '1-URGENT'""",
    "v_files": """
SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS fk_books,
       coalesce(concat(CASE l_suppkey % 4
                WHEN 0 THEN concat('cache/epub/', CAST(l_orderkey AS STRING))
                WHEN 1 THEN concat('etext', CAST(l_orderkey AS STRING))
                WHEN 2 THEN concat(CASE WHEN l_orderkey < 10 THEN '0/' ELSE [[digits]] END, CAST(l_orderkey AS STRING))
                ELSE CAST(l_orderkey AS STRING) END, '/',
              CASE WHEN l_partkey % 9 = 0 THEN 'glossary' ELSE CAST(l_orderkey AS STRING) END,
              CASE WHEN l_linenumber % 3 = 0 THEN '-h.htm' WHEN l_linenumber % 3 = 1 THEN '-0.txt' ELSE '.rst' END), '') AS archive_path,
       CASE WHEN l_linenumber % 3 = 0 THEN 'html' WHEN l_linenumber % 3 = 1 THEN 'txt' WHEN l_linenumber = 5 THEN NULL ELSE 'rst' END AS fk_filetypes,
       CASE l_returnflag WHEN 'A' THEN 'iso-8859-1' WHEN 'N' THEN 'utf-8' ELSE NULL END AS fk_encodings,
       CASE WHEN l_discount >= 0.09 THEN 'zip' ELSE 'none' END AS compression,
       CASE WHEN l_tax >= 0.08 THEN 5 ELSE 0 END AS diskstatus,
       CASE WHEN l_quantity >= 45 THEN 1 ELSE 0 END AS obsoleted,
       l_shipdate AS modified,
       CAST(floor(l_extendedprice * 800) AS BIGINT) AS extent,
       l_suppkey % 4 = 0 AS generated
FROM {{lineitem}}""",
    "v_disk_listing": """
SELECT DISTINCT archive_path FROM {{v_files}} WHERE extent > 8000000""",
    "v_targets": """
SELECT l_orderkey AS fk_books,
       CASE l_linenumber WHEN 1 THEN 'epub3.images' WHEN 2 THEN 'html.images' WHEN 3 THEN 'txt.utf-8'
            WHEN 4 THEN 'kindle.images' WHEN 5 THEN 'cover.medium' WHEN 6 THEN 'rdf' ELSE 'summary' END AS type,
       max(l_shipdate) AS built
FROM {{lineitem}} GROUP BY 1, 2""",
    "v_authors": """
SELECT s_suppkey AS id,
       CASE WHEN s_suppkey % 3 = 0 THEN concat('Sup, ', s_name, ' (Alias ', CAST(s_suppkey AS STRING), ')') ELSE concat('Sup, ', s_name) END AS name,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 7 = 0 THEN -43 ELSE 1700 + s_suppkey % 200 END AS birthdate,
       CASE WHEN s_suppkey % 4 = 0 THEN 1705 + s_suppkey % 200 ELSE NULL END AS birthdate2,
       CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE 1760 + s_suppkey % 200 END AS deathdate,
       CASE WHEN s_suppkey % 6 = 1 THEN 1765 + s_suppkey % 200 ELSE NULL END AS deathdate2
FROM {{supplier}}""",
    "v_author_aliases": """
SELECT s_suppkey AS fk_authors, concat('Alias of ', s_name) AS alias FROM {{supplier}} WHERE s_acctbal < 0""",
    "v_author_webpages": """
SELECT s_suppkey AS fk_authors, concat('https://people.example.org/', CAST(s_suppkey AS STRING)) AS url,
       concat('About ', s_name) AS description FROM {{supplier}} WHERE s_acctbal > 5000""",
    "v_book_authors": """
SELECT l_orderkey AS fk_books, l_suppkey AS fk_authors, min(l_linenumber) AS heading,
       min(CASE WHEN l_linenumber = 1 THEN 'aut' WHEN l_returnflag = 'A' THEN 'edt' WHEN l_returnflag = 'R' THEN 'trl' ELSE 'cre' END) AS marcrel
FROM {{lineitem}} GROUP BY 1, 2""",
    "v_attributes": """
SELECT DISTINCT l_orderkey * 10 + l_linenumber AS pk, l_orderkey AS fk_books,
       CASE l_linenumber WHEN 1 THEN 245 WHEN 2 THEN 508 WHEN 3 THEN 508 WHEN 4 THEN 520 WHEN 5 THEN 500 WHEN 6 THEN 260 ELSE 906 END AS fk_attriblist,
       CASE WHEN l_linenumber IN (2, 3) AND l_quantity > 40 THEN concat('Updated: ', p_name)
            WHEN l_linenumber = 4 THEN concat(p_name, CASE l_returnflag WHEN 'A' THEN ' (This is an automatically generated summary.)' WHEN 'N' THEN ' (This summary is from Wikipedia.)' ELSE ' (Summary by library staff.)' END)
            WHEN l_linenumber = 5 THEN concat('Wikipedia page about this book: https://', CASE l_returnflag WHEN 'A' THEN 'en' WHEN 'N' THEN 'sco' ELSE 'de' END, '.wikipedia.org/wiki/', replace(p_name, ' ', '_'), CASE WHEN l_quantity > 45 THEN '_(disambiguation)' ELSE '' END)
            WHEN l_linenumber = 7 THEN CAST(1800 + p_size AS STRING)
            WHEN l_linenumber = 1 AND p_size > 25 THEN concat(p_name, chr(10), 'or, ', p_type)
            ELSE p_name END AS text,
       CASE WHEN l_linenumber = 1 THEN p_size % 5 ELSE 0 END AS nonfiling
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "v_changelog": """
SELECT event_id AS id, ts AS time,
       CASE event_type
         WHEN 'purchase' THEN concat('update mn_books_authors set fk_roles = 1 where fk_books = ', CAST(user_id AS STRING))
         WHEN 'error' THEN concat('delete from mn_books_authors where fk_books = ', CAST(user_id AS STRING))
         WHEN 'signup' THEN concat('insert into mn_books_authors (fk_books, fk_authors) values (', CAST(user_id AS STRING), ', 7)')
         WHEN 'view' THEN concat('update attributes set  "fk_attriblist" = 245 where pk = ', CAST(user_id * 10 + 1 AS STRING))
         ELSE 'update books set downloads = 1' END AS sql
FROM {{events}}""",
    "v_posts": """
SELECT event_id AS id, CAST(floor(value * 10) AS BIGINT) + user_id AS fk_books,
       CASE event_type WHEN 'click' THEN 'Facebook' WHEN 'view' THEN 'Bluesky' ELSE 'Mastodon' END AS media, ts AS time
FROM {{events}} WHERE event_type IN ('click', 'view', 'signup')""",
    "v_texts": """
SELECT doc_id AS fk_books, lang, source, text FROM {{documents}}""",
    "v_wrapped_texts": """
SELECT doc_id AS fk_books, lang,
       concat('Title: Book ', CAST(doc_id AS STRING), chr(10), 'Author: Ann Author', chr(10), '        Bob Second', chr(10),
              'Release Date: 2021-07-21 [EBook #', CAST(CASE WHEN n_chars > 9000 THEN doc_id + 1 ELSE doc_id END AS STRING), ']', chr(10),
              'Language: ', lang, chr(10), CASE WHEN source < 'src15' THEN concat('Produced by Helper ', source, chr(10)) ELSE '' END,
              '*** START OF THIS EBOOK ***', chr(10), text, chr(10),
              CASE WHEN source < 'src11' THEN '' ELSE concat('*** END OF THIS EBOOK ***', chr(10), 'License text.') END) AS raw
FROM {{documents}}""",
    "v_workflow": """
SELECT p_partkey AS ebook, p_size % 3 AS rev,
       concat('{"GENERATED":"2024-01-01","DATA":{"TITLE":"', p_name, '","LANGUAGE":"', CASE WHEN p_size % 2 = 0 THEN 'English' ELSE 'French' END,
              '","SOURCE_PUBLICATION_YEARS":', CASE WHEN p_size % 3 = 0 THEN '"copyright:1920"' ELSE '["copyright:1920","reprint:1955","1972"]' END,
              ',"SCANS_ARCHIVE_URL":"https://scans.example.org/', CAST(p_partkey AS STRING), '"',
              CASE WHEN p_size % 4 = 0 THEN '' ELSE concat(',"NOTIFY":"', CASE WHEN p_size % 5 = 0 THEN 'anna' ELSE 'bo@example.org' END, '"') END,
              CASE WHEN p_size % 7 = 0 THEN '' ELSE concat(',"PUBLISHER":"House ', p_brand, '"') END,
              ',"WW":" carl ","CREDIT":"', p_brand, '"}}') AS json
FROM {{part}}""",
    "v_submissions": """
SELECT CAST(floor(p_partkey / 4) AS BIGINT) AS ebook, p_partkey AS seq,
       concat('/logs/json/', CASE p_partkey % 4 WHEN 0 THEN '' WHEN 3 THEN '' ELSE 'backup/' END, CAST(CAST(floor(p_partkey / 4) AS BIGINT) AS STRING),
              CASE p_partkey % 4 WHEN 0 THEN CASE WHEN p_size > 25 THEN '.json' ELSE '.draft' END WHEN 1 THEN concat('.json.', CAST(p_size % 10 AS STRING))
                   WHEN 2 THEN '.json' ELSE CASE WHEN p_size > 40 THEN '.txt' ELSE '.bak' END END) AS path,
       CASE WHEN p_size % 6 = 0 THEN left(json, 40) WHEN p_partkey % 4 = 3 THEN ' dora ' ELSE json END AS content
FROM {{part}} JOIN {{v_workflow}} ON p_partkey = ebook""",
    "v_book_meta": """
SELECT o_orderkey AS pk, CASE WHEN o_orderstatus = 'F' THEN 'Old House' ELSE NULL END AS publisher, CAST(NULL AS STRING) AS country,
       CASE o_orderpriority WHEN '2-HIGH' THEN 'fr' WHEN '3-MEDIUM' THEN 'en' WHEN '4-NOT SPECIFIED' THEN 'en' ELSE NULL END AS first_language,
       CASE WHEN o_totalprice > 200000 THEN 'https://scans.example.org/old' ELSE NULL END AS scan_url, CAST(NULL AS STRING) AS request_key,
       CASE WHEN o_orderstatus = 'O' THEN 'Old credit' ELSE NULL END AS credit
FROM {{orders}}""",
    "v_header_files": """
SELECT fk_books AS ebook, concat('/srv/library/files/', CAST(fk_books AS STRING), '/', CAST(fk_books AS STRING), '-0.txt') AS path, raw AS text FROM {{v_wrapped_texts}}
UNION ALL
SELECT fk_books, concat('/srv/library/files/', CAST(fk_books AS STRING), '/', CAST(fk_books AS STRING), '-h.htm'),
       concat('<html><head><title>x</title></head><body class="b"><pre>', replace(replace(replace(raw, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '</pre></body></html>')
FROM {{v_wrapped_texts}} WHERE lang <> 'en'""",
    "v_img_log": """
SELECT l_shipdate AS datetime,
       CASE WHEN l_linenumber = 7 THEN 'https://files.example.org/other.htm' ELSE concat('https://files.example.org/files/', CAST(l_orderkey AS STRING), '/', CAST(l_orderkey AS STRING), '-h.htm') END AS src,
       concat('img', CAST(l_linenumber AS STRING)) AS img_id,
       CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_linestatus END AS alt_txt,
       concat(CASE WHEN l_quantity < 3 THEN './images/../images/p' ELSE 'images/p' END, CAST(l_partkey AS STRING), '.jpg') AS rel_url,
       CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS in_a_figure
FROM {{lineitem}}""",
    "v_images": """
SELECT concat('/srv/library/cache/epub/', CAST(l_orderkey AS STRING), '/images/p', CAST(l_partkey AS STRING), '.jpg') AS path,
       unhex(concat('89504E470D0A1A0A0000000D49484452', lpad(hex(l_partkey + 1), 8, '0'), lpad(hex(l_orderkey + 300), 8, '0'), '0802000000')) AS content,
       l_partkey + 1 AS width, l_orderkey + 300 AS height
FROM {{lineitem}} WHERE l_discount < 0.06 GROUP BY l_orderkey, l_partkey""",
    "v_notice_queue": """
SELECT event_id AS id, user_id AS ebook, concat('CRITICAL ', event_type, ' ', props) AS record, ts AS time
FROM {{events}} WHERE event_type = 'error'""",
    "v_emails": """
SELECT event_id AS seq, CAST(user_id AS STRING) AS ebook,
       CASE WHEN event_type = 'click' THEN 'notify' ELSE 'ww' END AS role,
       CASE WHEN value < 5 THEN NULL WHEN value < 50 THEN concat(' user', CAST(event_id AS STRING), ' ') ELSE concat('u', CAST(event_id AS STRING), '@mail.example.org') END AS email
FROM {{events}} WHERE event_type IN ('click', 'purchase')""",
    "v_email_log": """
SELECT event_id AS seq, CAST(user_id AS STRING) AS ebook, CASE WHEN event_type = 'click' THEN 'notify' ELSE 'ww' END AS role,
       concat('u', CAST(event_id AS STRING), '@mail.example.org') AS email, value < 30 AS deleted
FROM {{events}} WHERE event_type IN ('click', 'purchase')""",
    "v_triggers": """
SELECT event_id AS id, user_id AS ebook, ts AS time FROM {{events}} WHERE event_type = 'error'""",
    "v_arrivals": """
SELECT event_id AS seq, user_id AS ebook, ts AS time, CASE WHEN value < 10 THEN left(json, 40) ELSE json END AS text
FROM {{events}} JOIN {{v_workflow}} ON ebook = user_id WHERE event_type = 'purchase'""",
    "v_log_lines": """
SELECT user_id AS log_id, event_id AS line_no,
       concat(CAST(event_id AS STRING), CASE event_type WHEN 'error' THEN ' ERROR ' WHEN 'signup' THEN ' CRITICAL ' ELSE ' INFO ' END,
              CASE WHEN value > 90 THEN 'Failed to build file' WHEN value < 3 THEN 'This is an ERROR for white-washed files' ELSE 'step done' END) AS line
FROM {{events}}""",
    "v_requests": """
SELECT c_custkey AS req_id,
       concat(CAST(c_custkey AS STRING), ',', CAST(c_custkey AS STRING), '-', CAST(c_custkey + c_nationkey AS STRING), ',',
              CASE c_mktsegment WHEN 'BUILDING' THEN 'x' WHEN 'MACHINERY' THEN '9-2' WHEN 'AUTOMOBILE' THEN '-4' WHEN 'HOUSEHOLD' THEN '' ELSE '1-2-3' END) AS range_text,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'everything' WHEN 'MACHINERY' THEN 'all' WHEN 'AUTOMOBILE' THEN 'kindle' WHEN 'HOUSEHOLD' THEN 'pdf' ELSE 'cover' END AS target
FROM {{customer}}""",
}

# Relations of a book as one long table. Spark unpivots one pass over the join; DuckDB unions.
_TERM_KINDS = (("subject", "p_type"), ("shelf", "p_brand"), ("locc", "l_returnflag"))
_LANG = "CASE l_suppkey % 6 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'fr' WHEN 3 THEN 'en' WHEN 4 THEN 'fi' ELSE 'es' END"
_TYPE = "SELECT o_orderkey AS fk_books, 'type' AS kind, 1 AS pos, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Sound' ELSE 'Text' END AS value FROM {{orders}}"
_SPARK_TERMS = f"""
SELECT * FROM (
  SELECT l_orderkey AS fk_books,
         stack(4, 'subject', p_type, 'shelf', p_brand, 'locc', l_returnflag,
               'lang', CASE WHEN l_linestatus = 'F' AND l_linenumber < 4 THEN {_LANG} END) AS (kind, value),
         l_linenumber AS pos
  FROM {{{{lineitem}}}} JOIN {{{{part}}}} ON l_partkey = p_partkey) WHERE value IS NOT NULL"""
_DUCK_TERMS = "\nUNION ALL ".join(
    [f"SELECT l_orderkey AS fk_books, '{k}' AS kind, {c} AS value, l_linenumber AS pos FROM {{{{lineitem}}}} JOIN {{{{part}}}} ON l_partkey = p_partkey" for k, c in _TERM_KINDS]
    + [f"SELECT l_orderkey, 'lang', {_LANG}, l_linenumber FROM {{{{lineitem}}}} WHERE l_linestatus = 'F' AND l_linenumber < 4"]
)
DIALECT["spark"]["terms"] = _SPARK_TERMS
DIALECT["duckdb"]["terms"] = _DUCK_TERMS
ADAPTERS["v_book_terms"] = f"SELECT fk_books, kind, pos, value FROM ([[terms]]) t UNION ALL {_TYPE}"
ADAPTERS["v_titles"] = "SELECT fk_books, min(text) AS title FROM {{v_attributes}} WHERE fk_attriblist = 245 GROUP BY fk_books"
ADAPTERS["v_languages"] = "SELECT fk_books, pos, value AS lang FROM {{v_book_terms}} WHERE kind = 'lang'"

_NAME = re.compile(r"\{\{(\w+)\}\}")
_TOKEN = re.compile(r"\[\[(\w+)\]\]")


def _text(name: str, dialect: str) -> str:
    return _TOKEN.sub(lambda m: DIALECT[dialect][m.group(1)], ADAPTERS[name])


def oracle(sql: str) -> str:
    """DuckDB text of a check: every adapter it names, in order, as a common table expression."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in _NAME.findall(text):
            if name in ADAPTERS and name not in order:
                need(_text(name, "duckdb"))
                order.append(name)

    need(sql)
    plain = lambda text: _NAME.sub(r"\1", text)
    ctes = ",\n".join(f"{n} AS ({plain(_text(n, 'duckdb'))})" for n in order)
    body = plain(sql).strip()
    if not ctes:
        return body
    if body[:4].upper() == "WITH":
        head, rest = body.split(None, 1)
        recursive = ""
        if rest[:9].upper() == "RECURSIVE":
            recursive, rest = "RECURSIVE ", rest[9:]
        return f"WITH {recursive}{ctes},\n{rest}"
    return f"WITH {ctes}\n{body}"


class Catalog:
    """Tables and adapters of one data folder as lazy DataFrames."""

    def __init__(self, spark: SparkSession, folder: str, **frames: DataFrame):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._frames: dict[str, DataFrame] = dict(frames)

    def streaming(self, table: str) -> Catalog:
        """The same catalog with one table read as a stream."""
        reader = self.spark.readStream.schema(self[table].schema).option("pathGlobFilter", f"{table}.parquet")
        return Catalog(self.spark, self.folder, **{table: reader.parquet(self.folder)})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                text = _text(name, "spark")
                inputs = {n: self[n] for n in _NAME.findall(text)}
                parts = _NAME.split(text)  # text, name, text, name, ...
                for i, part in enumerate(parts):
                    parts[i] = f"{{{part}}}" if i % 2 else part.replace("{", "{{").replace("}", "}}")
                self._frames[name] = self.spark.sql("".join(parts), **inputs)
        return self._frames[name]
