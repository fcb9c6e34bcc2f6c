"""Registered queries: announcements, notices, logs and images."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import catalog_feed, intake, inventory, outbox
from ..profile import DEFAULT
from .base import ASOF, Entry
from .metadata import MAIL

FIRST = {"Facebook": 450, "Bluesky": 750, "Mastodon": 708}
PAIRS = "pairs AS (SELECT pk, media FROM {{v_books}}, (VALUES ('Facebook', 450), ('Bluesky', 750), ('Mastodon', 708)) m(media, low) WHERE pk >= low)"
DUE = PAIRS + ", due AS (SELECT * FROM pairs WHERE NOT EXISTS (SELECT 1 FROM {{v_posts}} p WHERE p.fk_books = pk AND p.media = pairs.media))"


def _cut(room: int) -> str:
    return f"CASE WHEN length(line) > {room} THEN concat(left(line, {room - 1}), '…') ELSE line END"


POSTS = f"""titled AS (
  SELECT pk, replace(CASE WHEN downloads > 100000 THEN concat(coalesce(title, 'Untitled'), ' "é" by ', 'Ann, Bob') ELSE coalesce(title, 'Untitled') END, chr(10), ' ') AS line,
         coalesce((SELECT arg_min(lang, (pos, lang)) FROM {{{{v_languages}}}} l WHERE l.fk_books = pk), 'en') AS lang
  FROM {{{{v_books}}}} LEFT JOIN {{{{v_titles}}}} ON pk = fk_books),
posts AS (
  SELECT d.pk, d.media, lang, concat('https://library.example.org/ebooks/', d.pk) AS link,
    CASE d.media WHEN 'Bluesky' THEN concat('Just added to Example Library: ', replace({_cut(216)}, '"', '\\"'), ' https://library.example.org/ebooks/', d.pk)
      WHEN 'Mastodon' THEN concat('Just added by @library@social.example: ', {_cut(416)}, ' https://library.example.org/ebooks/', d.pk)
      ELSE 'Example Library gives this book away.' END AS message
  FROM {{0}} d JOIN titled t ON t.pk = d.pk)
SELECT *, CASE media WHEN 'Bluesky' THEN CAST(strlen(message) AS INTEGER) ELSE -1 END AS byte_end, CASE media WHEN 'Bluesky' THEN CAST(strlen(message) - length(link) AS INTEGER) ELSE -1 END AS byte_start FROM posts"""


def _titled(c):
    named = c["v_books"].join(c["v_titles"].withColumnRenamed("fk_books", "pk"), "pk", "left")
    base = F.coalesce("title", F.lit("Untitled"))
    loud = F.col("downloads") > 100000
    books = named.select("pk", F.when(loud, F.concat(base, F.lit(' "é"'))).otherwise(base).alias("title"), F.when(loud, "Ann, Bob").otherwise("").alias("authors"))
    return catalog_feed.main_languages(books, c["v_languages"])


def _posts_shown(rows):
    return rows.select("pk", "media", "lang", "link", "message", F.coalesce("byte_end", F.lit(-1)).alias("byte_end"), F.coalesce("byte_start", F.lit(-1)).alias("byte_start"))


def critical_sql(ebook: str, record: str) -> str:
    text = DEFAULT.critical_text.replace("{name}", "Example Library").replace("{site}", "https://library.example.org/")
    return f"replace(replace('{text}', '{{ebook}}', CAST({ebook} AS VARCHAR)), '{{records}}', {record})"


PROCESSED_SQL = "replace('" + DEFAULT.processed_text.replace("{name}", "Example Library") + "', '{ebook}', CAST(pk AS VARCHAR))"
BOOK = f"addr AS (SELECT CAST(ebook AS BIGINT) AS ebook, role, arg_max({MAIL.format('email')}, seq) AS email FROM {{{{v_emails}}}} WHERE email IS NOT NULL GROUP BY 1, 2)"


def _addresses(c):
    return intake.address_book(c["v_emails"])


def _ww(c):
    return _addresses(c).filter((F.col("role") == "ww") & F.col("email").contains("@mail."))


WW = "addr2 AS (SELECT * FROM addr WHERE role = 'ww' AND email LIKE '%@mail.%')"


def _outbox(c):
    processed = c["v_books"].select(F.col("pk").alias("ebook"))
    return outbox.notice_outbox(c["v_notice_queue"], processed, _ww(c), ASOF)


def _lines(c):
    """All log lines as one long log."""
    return c["v_log_lines"].select(F.lit("converter.log").alias("file"), (F.col("line_no") + 1).alias("line_no"), "line")


LOGS = "lines AS (SELECT 'converter.log' AS file, line_no + 1 AS line_no, line FROM {{v_log_lines}})"
REPORTS = "reports(report, phrase) AS (VALUES ('critical', 'CRITICAL'), ('error', 'ERROR'), ('failures', 'Failed'), ('whitewash', 'This is an ERROR for white-washed files'))"
IMAGES = """rows AS (SELECT split_part(split_part(src, 'files/', 2), '/', 1) AS item, img_id, coalesce(alt_txt, '') AS alt_txt, concat('images/p', regexp_extract(rel_url, 'p([0-9]+)', 1), '.jpg') AS img_url, in_a_figure
  FROM {{v_img_log}} WHERE src LIKE '%/files/%')""".replace("split_part(split_part(src, 'files/', 2), '/', 1)", "regexp_extract(src, '/files/([0-9]+)/', 1)")

ENTRIES: dict[str, Entry] = {
    "filter_post_threshold": Entry(lambda c: outbox.post_candidates(c["v_books"].select("pk"), FIRST), f"WITH {PAIRS} SELECT * FROM pairs"),
    "anti_unposted": Entry(lambda c: outbox.unposted(outbox.post_candidates(c["v_books"].select("pk"), FIRST), c["v_posts"]), f"WITH {DUE} SELECT * FROM due"),
    "fn_post_text": Entry(
        lambda c: _posts_shown(outbox.with_post_text(outbox.post_candidates(_titled(c), FIRST))), f"WITH {PAIRS}, {POSTS.replace('{0}', 'pairs')}"
    ),
    "post_outbox": Entry(lambda c: _posts_shown(outbox.post_outbox(_titled(c), c["v_posts"], FIRST)), f"WITH {DUE}, {POSTS.replace('{0}', 'due')}"),
    "fn_notice_text": Entry(
        lambda c: c["v_notice_queue"].select("id", outbox.notice_text(DEFAULT.critical_text, F.col("ebook"), F.col("record")).alias("message")),
        f"SELECT id, {critical_sql('ebook', 'record')} AS message FROM {{{{v_notice_queue}}}}",
    ),
    "join_notice_address": Entry(
        lambda c: outbox.with_address(c["v_notice_queue"].select("id", "ebook", F.lit("ww").alias("role")), _addresses(c)).select("id", "ebook", F.coalesce("email", F.lit("")).alias("email")),
        f"WITH {BOOK} SELECT id, n.ebook, coalesce(email, '') AS email FROM {{{{v_notice_queue}}}} n LEFT JOIN addr a ON a.ebook = n.ebook AND a.role = 'ww'",
    ),
    "anti_not_critical": Entry(
        lambda c: outbox.not_critical(c["v_books"].select(F.col("pk").alias("ebook")), c["v_notice_queue"]),
        "SELECT pk AS ebook FROM {{v_books}} WHERE pk NOT IN (SELECT ebook FROM {{v_notice_queue}})",
    ),
    "notice_outbox": Entry(
        lambda c: _outbox(c).select("ebook", "kind", "role", "message", F.coalesce("email", F.lit("")).alias("email")),
        f"""WITH {BOOK}, {WW}, m AS (SELECT ebook, 'critical' AS kind, {critical_sql('ebook', 'record')} AS message FROM {{{{v_notice_queue}}}} WHERE record <> ''
          UNION ALL SELECT pk, 'processed', {PROCESSED_SQL} FROM {{{{v_books}}}} WHERE pk NOT IN (SELECT ebook FROM {{{{v_notice_queue}}}}))
        SELECT m.ebook, kind, 'ww' AS role, message, coalesce(email, '') AS email FROM m LEFT JOIN addr2 a ON a.ebook = m.ebook""",
    ),
    "filter_log_level": Entry(
        lambda c: inventory.log_hits(c["v_log_lines"]), f"WITH {REPORTS} SELECT log_id, line_no, line, report FROM {{{{v_log_lines}}}} JOIN reports ON contains(line, phrase)"
    ),
    "log_context": Entry(
        lambda c: inventory.with_context(_lines(c)),
        f"""WITH {LOGS}, marked AS (SELECT *, max(CASE WHEN contains(line, 'This is an ERROR for white-washed files') THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near FROM lines)
        SELECT file, line_no, line FROM marked WHERE near = 1""",
    ),
    "log_report": Entry(
        lambda c: inventory.log_report(_lines(c)),
        f"WITH {LOGS}, {REPORTS} SELECT file, report, CAST(count(*) AS BIGINT) AS n_lines, CAST(min(line_no) AS BIGINT) AS first_line FROM lines JOIN reports ON contains(line, phrase) GROUP BY 1, 2",
    ),
    "fn_image_key": Entry(
        lambda c: inventory.image_rows(c["v_img_log"]).select("item", "img_id", "alt_txt", "img_url", "in_a_figure"), f"WITH {IMAGES} SELECT * FROM rows"
    ),
    "join_image_bytes": Entry(
        lambda c: inventory.image_rows(c["v_img_log"]).join(c["v_images"].select("path", F.octet_length("content").alias("n_bytes")), "path", "left").select("path", "img_id", F.coalesce("n_bytes", F.lit(-1)).cast("bigint").alias("n_bytes")),
        f"WITH {IMAGES} SELECT concat('/srv/library/cache/epub/', item, '/', img_url) AS path, img_id, CAST(coalesce(octet_length(content), -1) AS BIGINT) AS n_bytes FROM rows LEFT JOIN {{{{v_images}}}} i ON i.path = concat('/srv/library/cache/epub/', item, '/', img_url)",
    ),
    "image_inventory": Entry(
        lambda c: inventory.image_inventory(c["v_img_log"], c["v_images"]).select("item", "img_id", "alt_txt", "img_url", "in_a_figure", *[F.coalesce(n, F.lit(-1)).cast("bigint").alias(n) for n in ("x", "y", "len")], F.coalesce("hash", F.lit("")).alias("hash")),
        f"""WITH {IMAGES} SELECT r.*, CAST(coalesce(width, -1) AS BIGINT) AS x, CAST(coalesce(height, -1) AS BIGINT) AS y, CAST(coalesce(octet_length(content), -1) AS BIGINT) AS len, coalesce(sha256(content), '') AS hash
        FROM rows r LEFT JOIN {{{{v_images}}}} i ON i.path = concat('/srv/library/cache/epub/', item, '/', img_url)""",
    ),
}
