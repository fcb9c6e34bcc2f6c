"""Registered queries: streams drained over the tables, each equal to its batch twin on closed windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import intake
from ..session import scratch_path
from ..streaming import changes, spools
from ..streaming.runner import drain_to_files
from ..streaming.state import rocksdb_state
from .base import Entry
from .metadata import MAIL
from .outbox import BOOK, critical_sql
from .selection import CLASSIFY

CHANGES = rf"""changes AS (
  SELECT id, time, {CLASSIFY} AS kind, TRY_CAST(CASE {CLASSIFY} WHEN 'author_change' THEN regexp_extract(sql, 'fk_books = (\d\d+)', 1)
    WHEN 'author_add' THEN regexp_extract(sql, 'values \((\d\d+),', 1) END AS BIGINT) AS book,
    TRY_CAST(CASE {CLASSIFY} WHEN 'title_change' THEN regexp_extract(sql, 'where pk = (\d\d+)', 1) END AS BIGINT) AS attribute FROM {{{{v_changelog}}}}),
mark AS (SELECT date_trunc('millisecond', max(time)) - INTERVAL 1 HOUR AS mark FROM changes)"""
HOUR = "date_trunc('hour', time)"
STAMPS = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {1}"


def _changes(c):
    return changes.timed_changes(c.streaming("events")["v_changelog"])


def _drained(c, stream, label):
    return drain_to_files(stream, scratch_path(c.spark, label))


def _landed(c, frame, label):
    """Rows put into a folder as files, then read from there as a stream."""
    folder = scratch_path(c.spark, f"{label}-in")
    frame.write.parquet(folder)
    return c.spark.readStream.schema(frame.schema).parquet(folder)


def _submissions(c):
    files = c["v_submissions"].select("path", F.col("content").alias("text")).filter(~F.col("path").contains("/backup/"))
    stream = spools.submissions(_landed(c, files, "spool")).select("ebook", "valid", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("credit", F.lit("")).alias("credit"))
    return _drained(c, stream, "spool")


def _matched(c):
    """Triggers and submissions as two streams over the events they come from."""
    triggers = c.streaming("events")["v_triggers"]
    records = intake.workflow_records(c.streaming("events")["v_arrivals"])
    pairs = _drained(c, spools.with_submissions(triggers, records), "matched")
    best = spools.best_submissions(pairs)
    return best.select("id", "ebook", "seq", "valid", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("credit", F.lit("")).alias("credit"))


def _settled(c):
    with rocksdb_state(c.spark):
        hours = _drained(c, changes.settled_rebuilds(_changes(c)), "rebuild")
    shown = lambda n: F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(n)
    return hours.select("book", shown("first"), shown("last"), "n_changes")


def _notices(c):
    folder = scratch_path(c.spark, "notices")
    spools.notices_by_book(_landed(c, c["v_notice_queue"].drop("time"), "notices"), intake.address_book(c["v_emails"]), folder)
    return c.spark.read.parquet(f"{folder}/rows").select("ebook", "message", F.coalesce("email", F.lit("")).alias("email"))


def _addresses(c, view="v_emails"):
    folder = scratch_path(c.spark, "addresses")
    spools.latest_addresses(c.streaming("events")[view], folder)
    return spools.current_addresses(c.spark, folder)


def _posts(c):
    folder = scratch_path(c.spark, "posts")
    known = c["v_posts"].filter(F.col("media") == "Mastodon")
    sent = c.streaming("events")["v_posts"].select("fk_books", "media", F.col("time").cast("timestamp").alias("time"))
    spools.post_once(sent, known, folder)
    return c.spark.read.parquet(f"{folder}/rows").select("fk_books", "media", "time")


def _late(c):
    """On-time changes arrive first, deletions afterwards: those too old are late."""
    folder, landing = scratch_path(c.spark, "late"), scratch_path(c.spark, "late-in")
    log = changes.timed_changes(c["v_changelog"]).select("id", "time", "kind")
    deletion = F.coalesce(F.col("kind") == "author_change", F.lit(False))
    for part in (log.filter(~deletion), log.filter(deletion)):
        part.write.mode("append").parquet(landing)
        changes.split_late(c.spark.readStream.schema(log.schema).parquet(landing), folder)
    return c.spark.read.parquet(f"{folder}/rows").filter(F.col("kept_as") == "late").select("id", "kind")


ENTRIES: dict[str, Entry] = {
    "stream_changelog_rebuild": Entry(
        _settled,
        f"""WITH RECURSIVE {CHANGES}, markb AS (SELECT date_trunc('millisecond', max(time)) - INTERVAL 1 HOUR AS mark FROM changes WHERE book IS NOT NULL),
        hours AS (
          SELECT book, min(time) AS first FROM changes WHERE book IS NOT NULL GROUP BY book
          UNION ALL SELECT h.book, min(c.time) FROM hours h JOIN changes c ON c.book = h.book AND c.time >= h.first + INTERVAL 1 HOUR GROUP BY h.book)
        SELECT h.book, strftime(first, '%Y-%m-%d %H:%M:%S.%f') AS first, strftime(max(time), '%Y-%m-%d %H:%M:%S.%f') AS last, CAST(count(*) AS BIGINT) AS n_changes
        FROM hours h JOIN changes c ON c.book = h.book AND c.time >= first AND c.time < first + INTERVAL 1 HOUR, markb WHERE first + INTERVAL 1 HOUR <= mark GROUP BY h.book, first""",
    ),
    "stream_rebuild_once": Entry(
        lambda c: _drained(c, changes.rebuilds_at_once(_changes(c)).select("book"), "once"),
        f"WITH {CHANGES} SELECT DISTINCT book FROM changes WHERE book IS NOT NULL",
    ),
    "stream_change_counts": Entry(
        lambda c: _drained(c, changes.change_counts(_changes(c)), "counts"),
        f"""WITH {CHANGES} SELECT {STAMPS.format("date_trunc('hour', time)", 'start')}, {STAMPS.format("date_trunc('hour', time) + INTERVAL 1 HOUR", '"end"')}, coalesce(kind, 'other') AS kind, CAST(count(*) AS BIGINT) AS n_changes
        FROM changes, mark WHERE date_trunc('hour', time) + INTERVAL 1 HOUR <= mark GROUP BY 1, 2, 3""",
    ),
    "stream_activity_sliding": Entry(
        lambda c: _drained(c, changes.sliding_activity(_changes(c)), "sliding"),
        f"""WITH {CHANGES}, w AS (SELECT time_bucket(INTERVAL 6 HOUR, time) - to_hours(CAST(k * 6 AS BIGINT)) AS s FROM changes, generate_series(0, 3) g(k))
        SELECT {STAMPS.format('s', 'start')}, {STAMPS.format('s + INTERVAL 1 DAY', '"end"')}, CAST(count(*) AS BIGINT) AS n_changes FROM w, mark WHERE s + INTERVAL 1 DAY <= mark GROUP BY s""",
    ),
    "stream_edit_sessions": Entry(
        lambda c: _drained(c, changes.edit_sessions(_changes(c)), "sessions"),
        f"""WITH {CHANGES}, markb AS (SELECT date_trunc('millisecond', max(time)) - INTERVAL 1 HOUR AS mark FROM changes WHERE book IS NOT NULL),
        l AS (SELECT book, time, CASE WHEN time <= lag(time) OVER (PARTITION BY book ORDER BY time) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM changes WHERE book IS NOT NULL),
        s AS (SELECT *, sum(opens) OVER (PARTITION BY book ORDER BY time ROWS UNBOUNDED PRECEDING) AS n FROM l)
        SELECT book, {STAMPS.format('min(time)', 'start')}, {STAMPS.format("max(time) + INTERVAL 30 MINUTE", '"end"')}, CAST(count(*) AS BIGINT) AS n_changes FROM s GROUP BY book, n HAVING max(time) + INTERVAL 30 MINUTE <= (SELECT mark FROM markb)""",
    ),
    "stream_static_join": Entry(
        lambda c: _drained(c, changes.edited_titles(_changes(c), c["v_attributes"]), "titles"),
        f"WITH {CHANGES} SELECT DISTINCT id, fk_books FROM changes JOIN {{{{v_attributes}}}} a ON a.pk = attribute",
    ),
    "stream_late_changes": Entry(
        _late,
        f"WITH {CHANGES} SELECT id, kind FROM changes WHERE kind = 'author_change' AND time <= (SELECT date_trunc('millisecond', max(time)) FROM changes WHERE coalesce(kind, '') <> 'author_change') - INTERVAL 1 HOUR",
    ),
    "stream_trigger_intake": Entry(
        _submissions,
        """SELECT ebook, json_valid(content) AS valid, CASE WHEN json_valid(content) THEN json_extract_string(content, '$.DATA.TITLE') ELSE '' END AS title,
        CASE WHEN json_valid(content) THEN json_extract_string(content, '$.DATA.CREDIT') ELSE '' END AS credit FROM {{v_submissions}} WHERE path LIKE '%.json' AND path NOT LIKE '%/backup/%'""",
    ),
    "stream_trigger_match": Entry(
        _matched,
        """WITH span AS (SELECT (SELECT date_trunc('millisecond', max(time)) FROM {{v_triggers}}) AS t, (SELECT date_trunc('millisecond', max(time)) FROM {{v_arrivals}}) AS s),
        mark AS (SELECT least(t, s) - INTERVAL 1 HOUR AS mark FROM span),
        met AS (SELECT t.id, t.ebook, t.time, a.seq, json_valid(a.text) AS valid, CASE WHEN json_valid(a.text) THEN a.text ELSE '{}' END AS text, a.time AS arrived
          FROM {{v_triggers}} t LEFT JOIN {{v_arrivals}} a ON a.ebook = t.ebook AND a.time BETWEEN t.time - INTERVAL 12 HOUR AND t.time + INTERVAL 12 HOUR),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY valid DESC, arrived DESC, seq DESC) AS rn FROM met)
        SELECT id, ebook, seq, CASE WHEN seq IS NOT NULL THEN valid END AS valid, coalesce(json_extract_string(text, '$.DATA.TITLE'), '') AS title, coalesce(json_extract_string(text, '$.DATA.CREDIT'), '') AS credit
        FROM ranked, mark WHERE rn = 1 AND (seq IS NOT NULL OR time + INTERVAL 12 HOUR < mark)""",
    ),
    "stream_address_deletes": Entry(
        lambda c: _addresses(c, "v_email_log"),
        "SELECT CAST(ebook AS BIGINT) AS ebook, role, arg_max(email, seq) AS email FROM {{v_email_log}} GROUP BY 1, 2 HAVING NOT arg_max(deleted, seq)",
    ),
    "stream_notices": Entry(
        _notices,
        f"""WITH {BOOK}, n AS (SELECT ebook, string_agg(record, chr(10) ORDER BY id) AS records FROM {{{{v_notice_queue}}}} GROUP BY 1)
        SELECT n.ebook, {critical_sql('n.ebook', 'records')} AS message, coalesce(email, '') AS email FROM n LEFT JOIN addr a ON a.ebook = n.ebook AND a.role = 'ww'""",
    ),
    "stream_address_book": Entry(
        _addresses,
        f"SELECT CAST(ebook AS BIGINT) AS ebook, role, arg_max({MAIL.format('email')}, seq) AS email FROM {{{{v_emails}}}} WHERE email IS NOT NULL GROUP BY 1, 2",
    ),
    "stream_post_once": Entry(
        _posts,
        "SELECT fk_books, media, strftime(min(time), '%Y-%m-%d %H:%M:%S') AS time FROM {{v_posts}} WHERE media <> 'Mastodon' GROUP BY 1, 2",
    ),
}
