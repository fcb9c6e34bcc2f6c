"""Registered queries: scans, lookups, candidates, ranges, changes, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import BOOKS_PER_DAY, BUILD_ORDER, SOURCE_FAMILIES
from ..functions import paths
from ..operators import candidates as cand
from ..operators import changes, ranking, reconcile, scans, selection
from ..session import scratch_path
from ..sinks.bucket_store import BucketStore
from .base import ASOF, EVENTS_ASOF, Entry

STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
FILES_OUT = "id, fk_books, archive_path, fk_filetypes, fk_encodings, " + STAMP.format("modified") + " AS modified, extent"
LIVE = "compression = 'none' AND diskstatus = 0 AND obsoleted = 0"
DIGIT_DIR = (
    "concat(CASE WHEN fk_books < 10 THEN '0/' ELSE regexp_replace(left(CAST(fk_books AS VARCHAR), "
    r"length(CAST(fk_books AS VARCHAR)) - 1), '(.)', '\1/', 'g') END, CAST(fk_books AS VARCHAR))"
)
SHELF = (
    f"CASE WHEN starts_with(archive_path, {DIGIT_DIR}) THEN replace(archive_path, {DIGIT_DIR}, concat('files/', CAST(fk_books AS VARCHAR))) "
    "WHEN starts_with(archive_path, 'etext') THEN concat('dirs/', archive_path) ELSE archive_path END"
)
CANDS = f"""cands AS (
  SELECT id, fk_books, {SHELF} AS archive_path, fk_filetypes, fk_encodings, modified, extent, generated, archive_path AS stored_path,
         concat(fk_filetypes, '/', coalesce(nullif(fk_encodings, ''), 'unknown')) AS format
  FROM {{{{v_files}}}}
  WHERE {LIVE} AND fk_filetypes IS NOT NULL
    AND NOT (fk_books > 10000 AND fk_filetypes = 'html'
             AND NOT starts_with(regexp_extract(archive_path, '[^/]*$'), CAST(fk_books AS VARCHAR))))"""
GLOBS = "globs(family, prio, pat) AS (VALUES " + ", ".join(
    f"('{f}', {i}, '{g}')" for f, globs in SOURCE_FAMILIES.items() for i, g in enumerate(globs)
) + ")"
TYPES = "types(type, build_rank, family) AS (VALUES " + ", ".join(
    f"('{t}', {i}, {repr(f) if f else 'NULL'})" for i, (t, f) in enumerate(BUILD_ORDER)
) + ")"
RANKED = """scored AS (
  SELECT c.*, g.family, min(g.prio) AS prio FROM cands c JOIN globs g ON c.format GLOB g.pat
  GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY fk_books, family ORDER BY prio, fk_filetypes ASC NULLS LAST, fk_encodings ASC NULLS LAST,
                               modified DESC NULLS FIRST, id, archive_path, extent) AS place FROM scored)"""
PAYLOAD_OUT = "id, archive_path, format, " + STAMP.format("modified") + " AS modified, extent"
TABLE_ROWS = ("id", "fk_books", "archive_path", "fk_filetypes", "fk_encodings", "modified", "extent")
CLASSIFY = r"""CASE WHEN starts_with(sql, 'update mn_books_authors ') OR starts_with(sql, 'delete from mn_books_authors ') THEN 'author_change'
       WHEN starts_with(sql, 'insert into mn_books_authors (fk_books,') THEN 'author_add'
       WHEN starts_with(sql, 'update attributes set  "fk_attriblist" = 245') THEN 'title_change' END"""
CLASSIFIED = rf"""classified AS (
  SELECT *, {CLASSIFY} AS kind,
         TRY_CAST(CASE {CLASSIFY} WHEN 'author_change' THEN regexp_extract(sql, 'fk_books = (\d\d+)', 1)
              WHEN 'author_add' THEN regexp_extract(sql, 'values \((\d\d+),', 1) END AS BIGINT) AS book,
         TRY_CAST(CASE {CLASSIFY} WHEN 'title_change' THEN regexp_extract(sql, 'where pk = (\d\d+)', 1) END AS BIGINT) AS attribute
  FROM {{{{v_changelog}}}} WHERE time >= TIMESTAMP '{EVENTS_ASOF}' - INTERVAL 720 HOUR)"""
REBUILD = """rebuild AS (
  SELECT book AS ebook FROM classified WHERE book IS NOT NULL
  UNION SELECT fk_books FROM classified JOIN {{v_attributes}} a ON attribute = a.pk)"""
ISLANDS = """
SELECT min(pk) AS first_id, max(pk) AS last_id, CAST(count(*) AS BIGINT) AS n_ids,
       CASE WHEN count(*) = 1 THEN CAST(min(pk) AS VARCHAR) WHEN count(*) = 2 THEN concat(min(pk), ' ', max(pk)) ELSE concat(min(pk), '-', max(pk)) END AS text
FROM (SELECT pk, pk - row_number() OVER (ORDER BY pk) AS grp FROM ids) GROUP BY grp"""
ROOT = r"CASE WHEN starts_with(archive_path, '/') THEN 'absolute' WHEN starts_with(archive_path, 'cache') OR starts_with(archive_path, 'dirs') THEN 'public' WHEN regexp_matches(archive_path, '^[0-9][0-9]') THEN 'files' ELSE 'dirs' END"
RESOLVED = rf"CASE {ROOT} WHEN 'absolute' THEN archive_path WHEN 'public' THEN concat('/srv/library/', archive_path) WHEN 'files' THEN concat('/srv/library/files/', archive_path) ELSE concat('/srv/library/dirs/', archive_path) END"
CHANGED = f"""changed AS (
  SELECT DISTINCT fk_books FROM {{{{v_files}}}}
  WHERE modified >= TIMESTAMP '{ASOF}' - INTERVAL 900 DAY AND archive_path NOT LIKE 'cache/%' AND diskstatus <> 5 AND fk_books IS NOT NULL)"""
RANGE_ITEMS = r"""pieces AS (
  SELECT req_id, range_text, CAST(i - 1 AS BIGINT) AS item_pos, parts[i] AS item
  FROM (SELECT req_id, range_text, string_split(range_text, ',') AS parts FROM {{v_requests}}), generate_series(1, len(parts)) s(i)),
items AS (
  SELECT *, CASE WHEN regexp_full_match(item, '\d*-\d*') THEN coalesce(TRY_CAST(split_part(item, '-', 1) AS BIGINT), 1) ELSE TRY_CAST(item AS BIGINT) END AS low,
         CASE WHEN regexp_full_match(item, '\d*-\d*') THEN coalesce(TRY_CAST(split_part(item, '-', 2) AS BIGINT), (SELECT max(pk) FROM {{v_books}})) ELSE TRY_CAST(item AS BIGINT) END AS high
  FROM pieces)"""


def _items(c):
    return changes.parse_range_items(c["v_requests"], "range_text", scans.max_book(c["v_books"]))


def _classified(c):
    return changes.classify_changelog(scans.scan_changelog_window(c["v_changelog"], EVENTS_ASOF, 720))


def _pick(c):
    best = cand.best_sources(cand.candidates(c["v_files"]))
    return cand.sources_by_type(best).select("fk_books", "type", "source.*").drop("fk_filetypes", "fk_encodings", "generated")


def _on_disk(c):
    return changes.full_paths(c["v_disk_listing"], "/srv/library").select("full_path")


def _selected_ids(c):
    """Books with a live file."""
    return c["v_files"].filter("diskstatus = 0 AND obsoleted = 0").select(F.col("fk_books").alias("pk"))


def _audited_again(c):
    """The second of two audits: some paths have left the listing since the first."""
    store = BucketStore(c.spark, scratch_path(c.spark, "audit"))
    reconcile.audit_presence(c["v_files"], _on_disk(c), "/srv/library", store)
    fewer = changes.full_paths(c["v_disk_listing"].filter(~F.col("archive_path").endswith("77-h.htm")), "/srv/library").select("full_path")
    found, _ = reconcile.audit_presence(c["v_files"], fewer, "/srv/library", store)
    return found.select("id", "full_path")


LIVE_IDS = "fk_books AS pk FROM {{v_files}} WHERE diskstatus = 0 AND obsoleted = 0"

ENTRIES: dict[str, Entry] = {
    "scan_books": Entry(lambda c: scans.scan_books(c["v_books"]), "SELECT pk FROM {{v_books}} WHERE pk <> 99999"),
    "scan_text_books_range": Entry(
        lambda c: scans.scan_text_books_range(c["v_books"], c["v_categories"], 1).select("pk"),
        "SELECT pk FROM {{v_books}} WHERE pk >= 1 AND pk <> 99999 AND pk NOT IN (SELECT fk_books FROM {{v_categories}})",
    ),
    "scan_live_files": Entry(
        lambda c: scans.live_files(c["v_files"]).select(*TABLE_ROWS).orderBy("fk_books", *scans.live_file_order()),
        f"SELECT {FILES_OUT} FROM {{{{v_files}}}} WHERE {LIVE}",
    ),
    "scan_attributes": Entry(
        lambda c: scans.scan_attributes(c["v_attributes"], 520),
        "SELECT * FROM {{v_attributes}} WHERE fk_attriblist = 520",
    ),
    "scan_changelog_window": Entry(
        lambda c: scans.scan_changelog_window(c["v_changelog"], EVENTS_ASOF, 720).select("id", "sql"),
        f"SELECT id, sql FROM {{{{v_changelog}}}} WHERE time >= TIMESTAMP '{EVENTS_ASOF}' - INTERVAL 720 HOUR",
    ),
    "scan_posts": Entry(
        lambda c: scans.scan_posts(c["v_posts"], "Bluesky").select("id", "fk_books"),
        "SELECT id, fk_books FROM {{v_posts}} WHERE media = 'Bluesky'",
    ),
    "lookup_max_book": Entry(lambda c: scans.max_book(c["v_books"]), "SELECT max(pk) AS last_book FROM {{v_books}}"),
    "lookup_recent_books": Entry(
        lambda c: scans.recent_books(c["v_books"], "1999-06-30"),
        "SELECT pk FROM {{v_books}} WHERE release_date >= DATE '1999-06-30'",
    ),
    "lookup_top_books": Entry(
        lambda c: scans.top_books(c["v_books"], 500),
        "SELECT pk, downloads FROM {{v_books}} ORDER BY downloads DESC, pk LIMIT 500",
    ),
    "lookup_filetype_books": Entry(
        lambda c: scans.filetype_books(c["v_files"], "html"),
        "SELECT DISTINCT fk_books AS pk FROM {{v_files}} WHERE fk_filetypes = 'html'",
    ),
    "lookup_nontext": Entry(
        lambda c: scans.nontext_books(c["v_books"], c["v_categories"]),
        "SELECT pk FROM {{v_books}} WHERE pk IN (SELECT fk_books FROM {{v_categories}})",
    ),
    "filter_primary_html": Entry(
        lambda c: cand.filter_primary_html(c["v_files"]).select(*TABLE_ROWS),
        f"""SELECT {FILES_OUT} FROM {{{{v_files}}}}
            WHERE NOT (fk_books > 10000 AND coalesce(fk_filetypes, '') = 'html' AND regexp_extract(archive_path, '[^/]*$') NOT LIKE concat(fk_books, '%'))""",
    ),
    "filter_typed": Entry(
        lambda c: cand.filter_typed(c["v_files"]).select(*TABLE_ROWS),
        f"SELECT {FILES_OUT} FROM {{{{v_files}}}} WHERE fk_filetypes IS NOT NULL",
    ),
    "project_paths": Entry(
        lambda c: cand.project_paths(c["v_files"]).select("id", "archive_path", "extent"),
        f"SELECT id, {SHELF} AS archive_path, extent FROM {{{{v_files}}}}",
    ),
    "project_format": Entry(
        lambda c: cand.filter_typed(c["v_files"]).select("id", cand.source_format().alias("format"), "extent"),
        "SELECT id, fk_filetypes || '/' || CASE WHEN coalesce(fk_encodings, '') = '' THEN 'unknown' ELSE fk_encodings END AS format, extent FROM {{v_files}} WHERE fk_filetypes IS NOT NULL",
    ),
    "filter_parseable": Entry(
        lambda c: c["v_files"].filter(paths.is_parseable(F.col("archive_path"))).select("id", "archive_path"),
        r"SELECT id, archive_path FROM {{v_files}} WHERE regexp_matches(archive_path, '\.(rst|html|htm|tex|txt)$')",
    ),
    "filter_readable": Entry(
        lambda c: c["pages"].filter(paths.is_readable(F.replace(F.col("url"), F.lit("//m."), F.lit("//.")))).select("page_id", "url"),
        "SELECT page_id, url FROM {{pages}} WHERE instr(replace(url, '//m.', '//.'), '/.') = 0",
    ),
    "filter_named_files": Entry(
        lambda c: selection.named_files(selection.spool_names(c["v_notice_queue"])),
        r"""WITH names AS (SELECT id, unnest([concat(ebook, '.json'), concat(ebook, '.txt'), concat(ebook, '.zip.trig'), concat('x', ebook, '.txt'), concat(ebook, '.json.1')]) AS name FROM {{v_notice_queue}})
        SELECT id, name, CASE WHEN name LIKE '%.json' THEN 'workflow' WHEN name LIKE '%.txt' THEN 'notice' ELSE 'trigger' END AS kind, CAST(split_part(name, '.', 1) AS BIGINT) AS ebook
        FROM names WHERE regexp_matches(name, '^[0-9]+\.(json|txt|zip\.trig)$')""",
    ),
    "classify_path_root": Entry(
        lambda c: c["v_files"].select("id", "archive_path", paths.root_kind(F.col("archive_path")).alias("root"), paths.resolved_path(F.col("archive_path"), "/srv/library").alias("full_path")),
        f"SELECT id, archive_path, {ROOT} AS root, {RESOLVED} AS full_path FROM {{{{v_files}}}}",
    ),
    "filter_changed_books": Entry(
        lambda c: changes.changed_books(c["v_files"], ASOF, 900), f"WITH {CHANGED} SELECT fk_books FROM changed"
    ),
    "anti_missing_files": Entry(
        lambda c: changes.missing_files(c["v_files"], _on_disk(c), "/srv/library").select("id", "full_path"),
        f"SELECT id, {RESOLVED} AS full_path FROM {{{{v_files}}}} WHERE diskstatus <> 5 AND {RESOLVED} NOT IN (SELECT {RESOLVED} FROM {{{{v_disk_listing}}}})",
    ),
    "reconcile_presence": Entry(
        _audited_again,
        f"""SELECT id, {RESOLVED} AS full_path FROM {{{{v_files}}}} WHERE diskstatus <> 5
            AND {RESOLVED} NOT IN (SELECT {RESOLVED} FROM {{{{v_disk_listing}}}} WHERE archive_path NOT LIKE '%77-h.htm')""",
    ),
    "presence_audit": Entry(
        lambda c: changes.missing_files(
            c["v_files"].join(changes.changed_books(c["v_files"], ASOF, 900), "fk_books", "left_semi"), _on_disk(c), "/srv/library"
        ).select("fk_books", "id", "full_path", F.lit(5).alias("new_diskstatus")),
        f"""WITH {CHANGED} SELECT fk_books, id, {RESOLVED} AS full_path, 5 AS new_diskstatus FROM {{{{v_files}}}}
            WHERE diskstatus <> 5 AND fk_books IN (SELECT fk_books FROM changed) AND archive_path NOT IN (SELECT archive_path FROM {{{{v_disk_listing}}}})""",
    ),
    "fn_glob_to_regex": Entry(
        lambda c: selection.glob_hits(c["v_files"], selection.CHECK_GLOBS),
        "WITH globs(pat) AS (VALUES " + ", ".join(f"('{g}')" for g in selection.CHECK_GLOBS) + """)
        SELECT pat AS "glob", CAST(count(*) AS BIGINT) AS hits, min(archive_path) AS first_path FROM {{v_files}} JOIN globs ON archive_path GLOB pat GROUP BY pat""",
    ),
    "theta_format_preference": Entry(
        lambda c: selection.format_preferences(cand.candidates(c["v_files"])),
        f"""WITH {CANDS}, {GLOBS}, {TYPES}
        SELECT format, type, CAST(min(prio) AS INTEGER) AS prio FROM (SELECT DISTINCT format FROM cands) JOIN globs ON format GLOB pat JOIN types USING (family) GROUP BY 1, 2""",
    ),
    "agg_best_pattern": Entry(
        lambda c: selection.best_pattern_per_file(cand.candidates(c["v_files"]), "html_first"),
        f"""WITH {CANDS}, {GLOBS} SELECT id, archive_path, format, extent,
            CAST((SELECT min(prio) FROM globs WHERE family = 'html_first' AND cands.format GLOB pat) AS INTEGER) AS prio
            FROM cands WHERE EXISTS (SELECT 1 FROM globs WHERE family = 'html_first' AND cands.format GLOB pat)""",
    ),
    "rank_candidates": Entry(
        lambda c: cand.rank_candidates(cand.candidates(c["v_files"])).select("fk_books", "family", "place", "id", "archive_path", "format", "modified", "extent"),
        f"WITH {CANDS}, {GLOBS}, {RANKED} SELECT fk_books, family, CAST(place AS BIGINT) AS place, {PAYLOAD_OUT} FROM ranked",
    ),
    "rank_by_column": Entry(
        lambda c: cand.rank_candidates(cand.candidates(c["v_files"]), F.when(F.col("generated"), "skip_this").otherwise(F.col("format"))).select("fk_books", "family", "place", "id", "archive_path", "extent"),
        f"""WITH {CANDS.replace("AS format", "AS plain, CASE WHEN generated THEN 'skip_this' ELSE plain END AS format")}, {GLOBS}, {RANKED}
            SELECT fk_books, family, CAST(place AS BIGINT) AS place, id, archive_path, extent FROM ranked""",
    ),
    "pick_candidate": Entry(
        _pick,
        f"WITH {CANDS}, {GLOBS}, {TYPES}, {RANKED} SELECT fk_books, type, {PAYLOAD_OUT} FROM ranked JOIN types USING (family) WHERE place = 1",
    ),
    "filter_size_cap": Entry(
        lambda c: selection.over_cap(_pick(c)),
        f"""WITH {CANDS}, {GLOBS}, {TYPES}, {RANKED}
        SELECT fk_books, type, id, extent, extent > 1048576 * (CASE WHEN split_part(type, '.', 1) IN ('epub', 'epub3', 'kindle', 'kf8') THEN 16 ELSE 32 END) AS too_big
        FROM ranked JOIN types USING (family) WHERE place = 1""",
    ),
    "parse_book_range": Entry(
        lambda c: changes.expand_range_items(_items(c)),
        f"WITH {RANGE_ITEMS} SELECT req_id, CAST(item_pos AS INTEGER) AS item_pos, ebook FROM items, generate_series(low, high) s(ebook) WHERE low <= high",
    ),
    "parse_book_range_errors": Entry(
        lambda c: _items(c).filter(~F.col("ok")).select("req_id", "item_pos", "item"),
        f"WITH {RANGE_ITEMS} SELECT req_id, CAST(item_pos AS INTEGER) AS item_pos, item FROM items WHERE low IS NULL OR high IS NULL OR low > high",
    ),
    "classify_changelog": Entry(
        lambda c: _classified(c).select("id", "kind", F.coalesce("book", F.lit(-1)).alias("book"), F.coalesce("attribute", F.lit(-1)).alias("attribute")),
        f"WITH {CLASSIFIED} SELECT id, kind, coalesce(book, -1) AS book, coalesce(attribute, -1) AS attribute FROM classified",
    ),
    "join_attr_to_book": Entry(
        lambda c: changes.attribute_books(_classified(c), c["v_attributes"]),
        f"WITH {CLASSIFIED} SELECT DISTINCT pk, fk_books FROM {{{{v_attributes}}}} WHERE pk IN (SELECT attribute FROM classified WHERE attribute IS NOT NULL)",
    ),
    "rebuild_list": Entry(
        lambda c: changes.books_to_rebuild(_classified(c), c["v_attributes"]),
        f"WITH {CLASSIFIED}, {REBUILD} SELECT ebook FROM rebuild",
    ),
    "agg_distinct_rebuild": Entry(
        lambda c: changes.rebuild_batches(changes.books_to_rebuild(_classified(c), c["v_attributes"])),
        f"WITH {CLASSIFIED}, {REBUILD} SELECT CAST(floor(ebook / 1000) AS BIGINT) AS batch, string_agg(CAST(ebook AS VARCHAR), ',' ORDER BY ebook) AS build_list, CAST(count(*) AS BIGINT) AS n_books FROM rebuild GROUP BY 1",
    ),
    "islands_of_ids": Entry(
        lambda c: ranking.islands_of_ids(_selected_ids(c), "pk"),
        f"WITH ids AS (SELECT DISTINCT {LIVE_IDS})" + ISLANDS,
    ),
    "chunk_ids": Entry(
        lambda c: ranking.chunk_ids(_selected_ids(c), "pk", 20),
        f"SELECT pk, CAST(floor((row_number() OVER (ORDER BY pk) - 1) / 20) AS BIGINT) AS chunk FROM (SELECT DISTINCT {LIVE_IDS})",
    ),
    "bucket_by_day": Entry(
        lambda c: c["v_books"].select("pk", changes.rebuild_day(F.col("pk"), BOOKS_PER_DAY).alias("rebuild_day"), changes.reindex_day(F.col("pk"), BOOKS_PER_DAY).alias("reindex_day")),
        "SELECT pk, pk // 2600 + 1 AS rebuild_day, pk // 2600 AS reindex_day FROM {{v_books}}",
    ),
    "order_books_newest_first": Entry(
        lambda c: scans.recent_books(c["v_books"], "1998-01-01").orderBy(F.desc("pk")),
        "SELECT pk FROM {{v_books}} WHERE release_date >= DATE '1998-01-01' ORDER BY pk DESC",
    ),
    "topn_downloads_in_range": Entry(
        lambda c: selection.top_in_range(c["v_books"], 2000, 1000, 9000),
        "SELECT pk FROM (SELECT pk FROM {{v_books}} ORDER BY downloads DESC, pk LIMIT 2000) WHERE pk BETWEEN 1000 AND 9000",
    ),
    "semi_filetype": Entry(
        lambda c: selection.with_filetype(c["v_books"].filter(F.col("pk").between(1000, 9000)), c["v_files"], "txt").select("pk"),
        "SELECT pk FROM {{v_books}} WHERE pk BETWEEN 1000 AND 9000 AND EXISTS (SELECT 1 FROM {{v_files}} WHERE fk_books = pk AND fk_filetypes = 'txt')",
    ),
    "intersect_selection": Entry(
        lambda c: scans.recent_books(c["v_books"], "1998-01-01").intersect(scans.filetype_books(c["v_files"], "html")),
        "SELECT pk FROM {{v_books}} WHERE release_date >= DATE '1998-01-01' INTERSECT SELECT fk_books FROM {{v_files}} WHERE fk_filetypes = 'html'",
    ),
    "select_books": Entry(
        lambda c: selection.select_books(c["v_books"], c["v_files"], range_text="5-", since="1997-01-01", top=8000, filetype="html"),
        """SELECT pk FROM {{v_books}} WHERE release_date >= DATE '1997-01-01'
        INTERSECT (SELECT pk FROM {{v_books}} ORDER BY downloads DESC, pk LIMIT 8000)
        INTERSECT SELECT fk_books FROM {{v_files}} WHERE fk_filetypes = 'html'""",
    ),
    "union_files": Entry(
        lambda c: selection.union_files(*selection.posted_and_generated(c["v_files"])).select("fk_books", "archive_path", "extent", "origin"),
        "SELECT fk_books, archive_path, extent, CASE WHEN archive_path LIKE 'cache/%' THEN 'generated' ELSE 'posted' END AS origin FROM {{v_files}}",
    ),
    "except_books": Entry(
        lambda c: c["v_attributes"].select("fk_books").subtract(scans.scan_attributes(c["v_attributes"], 508).select("fk_books")),
        "SELECT fk_books FROM {{v_attributes}} EXCEPT SELECT fk_books FROM {{v_attributes}} WHERE fk_attriblist = 508",
    ),
}
