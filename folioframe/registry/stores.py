"""Registered queries: writers read back, and snapshots after a change."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import CATALOG_COLUMNS, IMAGE_COLUMNS
from ..operators.graphs import canonical_blanks, said, subjects_by_content
from ..plans import catalog_feed, inventory, outbox, rdf_feed
from ..plans.rdf_feed import parsed_ntriples
from ..profile import DEFAULT
from ..session import scratch_path
from ..sinks import snapshots, writers
from ..sinks.bucket_store import BucketStore
from ..sources.files import read_image_log
from . import feeds
from . import outbox as box
from .base import ASOF, Entry
from .feeds import CATALOG_SQL, LINES, MARC, TRIPLES_SQL

_NAMES = ("text_no", "type", "issued", "title", "language", "authors", "subjects", "locc", "bookshelves")


def _catalog_back(c):
    folder = scratch_path(c.spark, "catalog")
    writers.write_catalog_csv(feeds.catalog(c), folder)
    schema = ", ".join(f"`{n}` STRING" for n in CATALOG_COLUMNS)
    read = c.spark.read.options(**writers.CSV_READ).schema(schema).csv(f"{folder}/gzip").toDF(*_NAMES)
    return read.select(F.col("text_no").cast("bigint").alias("text_no"), *[F.coalesce(n, F.lit("")).alias(n) for n in _NAMES[1:]])


def _marcxml_back(c):
    folder = scratch_path(c.spark, "marcxml")
    writers.write_marcxml(writers.stage_fields(feeds.marc(c), f"{folder}-fields"), folder, "gzip")
    schema = """leader STRING, controlfield ARRAY<STRUCT<_tag: STRING, _VALUE: STRING>>,
      datafield ARRAY<STRUCT<_tag: STRING, _ind1: STRING, _ind2: STRING, subfield: ARRAY<STRUCT<_code: STRING, _VALUE: STRING>>>>"""
    rows = c.spark.read.format("xml").option("rowTag", "record").option("ignoreSurroundingSpaces", "false").schema(schema).load(folder)
    pk = F.filter("controlfield", lambda f: f["_tag"] == "001")[0]["_VALUE"].cast("bigint")
    text = lambda f: F.array_join(F.transform(f["subfield"], lambda s: F.concat(F.lit("$"), s["_code"], s["_VALUE"])), "")
    data = F.transform("datafield", lambda f: F.concat(f["_tag"], f["_ind1"], f["_ind2"], text(f)))
    control = F.transform("controlfield", lambda f: F.concat(f["_tag"], f["_VALUE"]))
    return rows.select(pk.alias("pk"), F.array_join(F.array_sort(F.concat(control, data)), "\n").alias("content"))


def _iso_back(c):
    folder = scratch_path(c.spark, "marc")
    writers.write_marc_feeds(feeds.marc(c), folder, "gzip")
    rows = c.spark.read.option("lineSep", writers.RECORD_END).text(f"{folder}/mrc")
    number = lambda at, size: F.substring("value", at, size).cast("int")
    raw, base = F.encode("value", "UTF-8"), number(13, 5)
    entry = lambda i: F.substring(F.col("value"), 25 + 12 * i, 12)

    def field(i):  # as the directory says: tag, length and start
        size, start = F.substring(entry(i), 4, 4).cast("int"), F.substring(entry(i), 8, 5).cast("int")
        payload = F.decode(F.substring(raw, base + start + 1, size - 1), "UTF-8")
        return F.concat(F.substring(entry(i), 1, 3), F.translate(payload, "\x1f", "$"))

    fields = F.transform(F.sequence(F.lit(0), F.floor((base - 25) / 12).cast("int") - 1), field)
    return rows.select(
        F.filter(fields, lambda f: f.startswith("001"))[0].substr(4, 20).cast("bigint").alias("pk"), number(1, 5).cast("bigint").alias("n_bytes"),
        (F.octet_length("value") + 1).cast("bigint").alias("stored_bytes"), F.array_join(F.array_sort(fields), "\n").alias("content"),
    )


def _rdf_back(c):
    """The written graph by content, with its blank nodes renamed on the way."""
    folder = scratch_path(c.spark, "rdf")
    writers.write_rdf(feeds.triples(c), folder, "gzip")
    other = lambda n: F.when(F.col(n).startswith("_:"), F.concat(F.lit("_:x"), F.reverse(F.col(n)).substr(1, 24))).otherwise(F.col(n))
    renamed = parsed_ntriples(c.spark.read.text(folder)).withColumns({"s": other("s"), "o": F.when(F.col("o_kind") == "blank", other("o")).otherwise(F.col("o"))})
    return subjects_by_content(canonical_blanks(renamed))


def _rdf_documents_back(c):
    """What the written documents say of each subject, read from their XML."""
    folder = scratch_path(c.spark, "rdfxml")
    writers.write_rdf_documents(feeds.triples(c, by_book=True), folder)
    number = F.regexp_extract("name", r"pg([0-9]+)\.rdf$", 1).cast("bigint")
    # one pattern for all statements of a document; no value holds the signs < and > as they are, so they part what it found
    node, tag, target = 'rdf:(about|nodeID)="([^"]*)"', "<([^: >]+):([^ />]+)", ' rdf:(resource|nodeID)="([^"]*)"/>'
    piece = f'(?s)<rdf:Description {node}>{tag}(?:{target}|(?: rdf:datatype="([^"]*)")?>([^<]*)</[^>]*>)</rdf:Description>'
    listed = F.regexp_replace("document", piece, "<<" + "".join(f"${k}>" for k in range(1, 9)))
    pieces = F.transform(F.slice("_listed", 2, F.size("_listed")), lambda text: F.split(text, ">"))

    def plain(text):
        whole = text
        for shown, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
            whole = F.replace(whole, F.lit(shown), F.lit(sign))
        return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)

    named = lambda how, what: F.when(how == "nodeID", F.concat(F.lit("_:"), what)).otherwise(plain(what))
    prefixes = F.create_map(*[F.lit(x) for pair in rdf_feed.name_spaces(DEFAULT).items() for x in pair])

    def parsed(part):
        o = F.when(part[4] == "", plain(part[7])).otherwise(named(part[4], part[5]))
        kind = F.when(part[4] == "", "literal").when(part[4] == "nodeID", "blank").otherwise("uri")
        return F.struct(named(part[0], part[1]).alias("s"), said(F.concat(F.try_element_at(prefixes, part[2]), part[3]), kind, plain(part[6]), o).alias("said"))

    # a book has one document, so what it says of a subject is a run of its sorted pieces and nothing moves
    # (filters on the pieces would be pushed below and make them twice)
    rows = c.spark.read.parquet(folder).select(number.alias("book"), F.split(listed, "<<").alias("_listed"))
    rows = rows.select("book", F.sort_array(F.transform(pieces, parsed)).alias("pieces"))
    subject = lambda i: F.get("pieces", i - 1)["s"]
    opens = lambda i: (i == 1) | (subject(i) != subject(i - 1))
    starts = F.when(F.size("pieces") > 0, F.filter(F.sequence(F.lit(1), F.size("pieces")), opens))
    rows = rows.withColumn("starts", starts)
    run = lambda at, k: F.slice("pieces", at, F.coalesce(F.get("starts", k + 1), F.size("pieces") + 1) - at).alias("run")
    runs = rows.select("book", F.explode(F.transform("starts", run)).alias("run"))
    all_ = F.array_join(F.col("run.said"), "\n")
    return runs.select("book", F.col("run")[0]["s"].alias("s"), F.size("run").cast("bigint").alias("n"), F.md5(all_.cast("binary")).alias("content"))


def _bundle_back(c):
    folder = scratch_path(c.spark, "bundle")
    writers.write_text_bundle(c["v_texts"].select("fk_books", "text"), folder)
    return c.spark.read.option("header", "true").schema("name STRING, n_bytes BIGINT, hash STRING").csv(f"{folder}/manifest")


def _log_lines(c):
    return c["v_log_lines"].select(F.concat(F.lit("log-"), F.col("log_id")).alias("file"), "line_no", "line")


def _reports_back(c):
    folder = scratch_path(c.spark, "reports")
    writers.write_log_reports(_log_lines(c), folder)
    return c.spark.read.text(folder).select("report", F.col("value").alias("line"))


def _images_back(c):
    folder = scratch_path(c.spark, "images")
    writers.write_image_inventory(inventory.image_inventory(c["v_img_log"], c["v_images"]), folder)
    schema = ", ".join(f"`{n}` {'BIGINT' if n in ('x', 'y', 'len') else 'STRING'}" for n in IMAGE_COLUMNS)
    read = c.spark.read.options(quote='"', escape='"').schema(schema).csv(folder)
    return read.select("item", "img_id", "img_url", F.coalesce("x", F.lit(-1)).alias("x"), F.coalesce("len", F.lit(-1)).alias("len"), F.coalesce("hash", F.lit("")).alias("hash"))


def _image_log_back(c):
    folder = scratch_path(c.spark, "imglog")
    log = c["v_img_log"].withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
    log.write.options(**writers.CSV_OPTIONS).csv(folder)
    return read_image_log(c.spark, folder).select("datetime", "src", "img_id", F.coalesce("alt_txt", F.lit("")).alias("alt_txt"), "rel_url", "in_a_figure")


def _log_back(c):
    from ..sources.files import read_log_lines

    folder = scratch_path(c.spark, "logs")
    parted = c["v_log_lines"].select("line", (F.length("line") % 4).alias("part"))
    parted.repartition(4, "part").sortWithinPartitions("part", "line").write.partitionBy("part").text(folder)
    numbered = read_log_lines(c.spark, f"{folder}/*")
    part = F.regexp_extract("file", "part=([0-9]+)", 1).cast("int")
    return numbered.select(part.alias("part"), F.col("line_no").cast("bigint").alias("line_no"), "line")


def _undelivered_back(c):
    folder = scratch_path(c.spark, "messages")
    lines = outbox.undelivered(box._outbox(c))
    writers.archive_messages(lines, folder)
    return c.spark.read.parquet(folder).select("ebook", "value")


def _sent(c):
    return box._posts_shown(outbox.post_outbox(box._titled(c), c["v_posts"], box.FIRST)).select(F.col("pk").alias("fk_books"), "media", F.lit(ASOF).cast("timestamp_ntz").alias("time"))


def _attribute_changes(c):
    """New summaries for some books, removals for others."""
    text = F.when(F.col("downloads") > 100000, F.concat(F.lit("New summary "), F.col("pk")))
    return c["v_books"].select(F.col("pk").alias("fk_books"), text.alias("text"))


BUCKETS = 16  # at least
BUCKET_KEYS = 100_000
BOOK_TABLES = {
    "books": ("v_books", "pk"),
    "files": ("v_files", "fk_books"),
    "terms": ("v_book_terms", "fk_books"),
    "authors": ("v_book_authors", "fk_books"),
    "categories": ("v_categories", "fk_books"),
    "attributes": ("v_attributes", "fk_books"),
}


def _buckets(keys: DataFrame) -> int:
    """Buckets for a key with that many values: a bucket is written and read by one task, so it must not grow with the table."""
    return max(BUCKETS, -(-keys.count() // BUCKET_KEYS))


def _store(c, *names: str) -> BucketStore:
    """A store with tables of the catalog, bucketed on the book."""
    store = BucketStore(c.spark, scratch_path(c.spark, "store"))
    change, buckets = store.begin(), _buckets(c["v_books"])
    for name in names:
        view, key = BOOK_TABLES[name]
        change.create(name, c[view], key, buckets)
    change.commit()
    return store


def _bucketed_catalog(c):
    store = _store(c, "books", "terms", "authors", "attributes")
    books, terms, links, attributes = (store.read(n) for n in ("books", "terms", "authors", "attributes"))
    return catalog_feed.catalog(books, attributes, terms, links, c["v_authors"], colocated=True).toDF(*_NAMES)


def _upserted(c):
    store = _store(c, "attributes")
    change, changes = store.begin(), _attribute_changes(c)
    whole = change.read("attributes")
    change.rewrite("attributes", changes.select("fk_books"), lambda rows: snapshots.upsert_attribute(rows, changes, 520, whole))
    change.commit()
    return store.read("attributes").select("fk_books", "fk_attriblist", "text", "nonfiling")


def _scanned(c):
    later = c["v_files"].filter(F.col("fk_filetypes") == "html").withColumn("modified", F.col("modified") + F.expr("INTERVAL '10' DAY"))
    return later.withColumn("extent", F.col("extent") + 1)


def _retired(c):
    return c["v_files"].filter(F.col("diskstatus") == 5).select("archive_path").distinct()


def _files_after_scan(c):
    """Files of scanned and retired paths change, in the buckets of those paths."""
    store = BucketStore(c.spark, scratch_path(c.spark, "files"))
    change = store.begin()
    change.create("files", c["v_files"], "archive_path", _buckets(c["v_books"]))
    change.commit()
    change, scanned, retired = store.begin(), _scanned(c), _retired(c)
    paths = scanned.select("archive_path").unionByName(retired)
    change.rewrite("files", paths, lambda rows: snapshots.upsert_files(rows, scanned, retired))
    change.commit()
    return snapshots.upsert_files(store.read("files"), scanned.limit(0), retired.limit(0)).select("archive_path", "modified", "extent")


CASCADE = {
    "books": ("pk", "release_date", "downloads", "rights"),
    "files": ("id", "archive_path", "fk_filetypes", "fk_encodings", "compression", "diskstatus", "obsoleted", "modified", "extent", "generated"),
    "terms": ("kind", "pos", "value"),
    "authors": ("fk_authors", "heading", "marcrel"),
    "categories": ("category",),
}


def _forgotten(c) -> DataFrame:
    """What is left in all tables after one change that deletes some books from each of them."""
    store = _store(c, *CASCADE)
    gone = c["v_books"].filter(F.col("rights").startswith("Copyright")).select("pk")
    change = store.begin()
    for name in CASCADE:
        key = BOOK_TABLES[name][1]
        change.rewrite(name, gone, lambda rows, name=name, key=key: snapshots.forget_books({name: (rows, key)}, gone)[name])
    change.commit()
    left = []
    for name, columns in CASCADE.items():
        shown = F.concat_ws("|", *[F.col(x).cast("string") for x in columns])
        left.append(store.read(name).select(F.lit(name).alias("table_name"), F.col(BOOK_TABLES[name][1]).alias("fk_books"), shown.alias("content")))
    return reduce(DataFrame.unionByName, left)


_SHOWN = {"modified": "strftime(modified, '%Y-%m-%d %H:%M:%S')"}
KEPT = "(SELECT pk FROM {{v_books}} WHERE rights LIKE 'Copyright%')"

SAID = "concat_ws(chr(9), p, o_kind, datatype, o)"

ENTRIES: dict[str, Entry] = {
    "write_catalog_csv": Entry(_catalog_back, CATALOG_SQL),
    "join_bucketed_relations": Entry(_bucketed_catalog, CATALOG_SQL),
    "write_marcxml": Entry(
        _marcxml_back,
        f"WITH {MARC} SELECT pk, {LINES} AS content FROM marc GROUP BY pk",
    ),
    "write_marc_binary": Entry(
        _iso_back,
        f"""WITH {MARC}, r AS (SELECT pk, CAST(26 + sum(13 + strlen(content) + length(ind)) AS BIGINT) AS n_bytes, {LINES} AS content FROM marc GROUP BY pk)
        SELECT pk, n_bytes, n_bytes AS stored_bytes, content FROM r""",
    ),
    "write_rdf": Entry(
        _rdf_back,
        f"""WITH t AS (SELECT DISTINCT s, p, CAST(o AS VARCHAR) AS o, o_kind, datatype FROM ({TRIPLES_SQL}) x),
        blank AS (SELECT s AS node, concat('_:c', md5(string_agg({SAID}, chr(10) ORDER BY {SAID}))) AS name FROM t WHERE s LIKE '!_:%' ESCAPE '!' GROUP BY s),
        c AS (SELECT DISTINCT coalesce(a.name, s) AS s, p, coalesce(b.name, o) AS o, o_kind, datatype FROM t LEFT JOIN blank a ON a.node = s LEFT JOIN blank b ON o_kind = 'blank' AND b.node = o)
        SELECT s, count(*) AS n, md5(string_agg({SAID}, chr(10) ORDER BY {SAID})) AS content FROM c GROUP BY s""",
    ),
    "write_rdf_documents": Entry(
        _rdf_documents_back,
        f"WITH t AS (SELECT book, s, p, CAST(o AS VARCHAR) AS o, o_kind, datatype FROM ({TRIPLES_SQL}) x) SELECT book, s, count(*) AS n, md5(string_agg({SAID}, chr(10) ORDER BY {SAID})) AS content FROM t GROUP BY book, s",
    ),
    "write_text_bundle": Entry(
        _bundle_back, "SELECT concat('cache/epub/', fk_books, '/pg', fk_books, '.txt') AS name, CAST(strlen(text) AS BIGINT) AS n_bytes, sha256(text) AS hash FROM {{v_texts}}"
    ),
    "write_log_reports": Entry(
        _reports_back,
        f"""WITH {box.REPORTS}, marked AS (SELECT line, max(CASE WHEN contains(line, phrase) THEN 1 ELSE 0 END)
          OVER (PARTITION BY log_id ORDER BY line_no RANGE BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near FROM {{{{v_log_lines}}}}, reports WHERE report = 'whitewash')
        SELECT report, line FROM {{{{v_log_lines}}}} JOIN reports ON contains(line, phrase) WHERE report <> 'whitewash' UNION ALL SELECT 'whitewash', line FROM marked WHERE near = 1""",
    ),
    "write_image_inventory": Entry(
        _images_back,
        f"""WITH {box.IMAGES} SELECT item, img_id, r.img_url, CAST(coalesce(width, -1) AS BIGINT) AS x, CAST(coalesce(octet_length(content), -1) AS BIGINT) AS len, coalesce(sha256(content), '') AS hash
        FROM rows r LEFT JOIN {{{{v_images}}}} i ON i.path = concat('/srv/library/cache/epub/', item, '/', img_url)""",
    ),
    "read_image_log": Entry(
        _image_log_back,
        "SELECT strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, src, img_id, coalesce(alt_txt, '') AS alt_txt, rel_url, CAST(in_a_figure AS VARCHAR) AS in_a_figure FROM {{v_img_log}}",
    ),
    "read_log_lines": Entry(
        _log_back,
        "SELECT length(line) % 4 AS part, row_number() OVER (PARTITION BY length(line) % 4 ORDER BY line) AS line_no, line FROM {{v_log_lines}}",
    ),
    "archive_undelivered": Entry(
        _undelivered_back,
        f"""WITH {box.BOOK}, {box.WW}, m AS (SELECT ebook, {box.critical_sql('ebook', 'record')} AS message FROM {{{{v_notice_queue}}}} WHERE record <> ''
          UNION ALL SELECT pk, {box.PROCESSED_SQL} FROM {{{{v_books}}}} WHERE pk NOT IN (SELECT ebook FROM {{{{v_notice_queue}}}}))
        SELECT ebook, concat('ww: 2001-11-05T00:00:00', chr(10), 'Subject: Example Library backend notifications', chr(10), message, chr(10)) AS value FROM m WHERE ebook NOT IN (SELECT ebook FROM addr2)""",
    ),
    "append_posts": Entry(
        lambda c: snapshots.new_posts(c["v_posts"], _sent(c).unionByName(c["v_posts"].select("fk_books", "media", "time"))).select("fk_books", "media"),
        f"WITH {box.DUE} SELECT pk AS fk_books, media FROM due",
    ),
    "upsert_attribute": Entry(
        _upserted,
        """WITH firsts AS (SELECT *, row_number() OVER (PARTITION BY fk_books ORDER BY pk, text) AS rn FROM {{v_attributes}} WHERE fk_attriblist = 520)
        SELECT fk_books, fk_attriblist, CASE WHEN rn = 1 THEN concat('New summary ', fk_books) ELSE text END AS text, nonfiling FROM firsts JOIN {{v_books}} b ON b.pk = fk_books WHERE rn > 1 OR downloads > 100000
        UNION ALL SELECT b.pk, 520, concat('New summary ', b.pk), 0 FROM {{v_books}} b WHERE downloads > 100000 AND b.pk NOT IN (SELECT fk_books FROM firsts)
        UNION ALL SELECT fk_books, fk_attriblist, text, nonfiling FROM {{v_attributes}} WHERE fk_attriblist <> 520""",
    ),
    "upsert_files": Entry(
        _files_after_scan,
        """WITH b AS (SELECT archive_path, modified, 0 AS fresh, extent, id, fk_filetypes FROM {{v_files}}
            UNION ALL SELECT archive_path, modified + INTERVAL '10' DAY, 1, extent + 1, id, fk_filetypes FROM {{v_files}} WHERE fk_filetypes = 'html'),
        r AS (SELECT *, row_number() OVER (PARTITION BY archive_path ORDER BY modified DESC, fresh DESC, extent DESC, id DESC) AS rn FROM b)
        SELECT archive_path, strftime(modified, '%Y-%m-%d %H:%M:%S') AS modified, extent FROM r WHERE rn = 1 AND archive_path NOT IN (SELECT archive_path FROM {{v_files}} WHERE diskstatus = 5)""",
    ),
    "delete_book_cascade": Entry(
        _forgotten,
        " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, {BOOK_TABLES[n][1]} AS fk_books, concat_ws('|', {', '.join(_SHOWN.get(x, x) for x in columns)}) AS content "
            f"FROM {{{{{BOOK_TABLES[n][0]}}}}} WHERE {BOOK_TABLES[n][1]} NOT IN {KEPT}"
            for n, columns in CASCADE.items()
        ),
    ),
}
