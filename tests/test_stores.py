"""What the writers leave behind, snapshots, and composite plans on small tables."""

import csv
import glob
import gzip
import json
import xml.etree.ElementTree as ET

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioframe.operators import scans
from folioframe.plans import build, intake, marc_feed, outbox, reading
from folioframe.registry import feeds
from folioframe.sinks import snapshots, writers
from folioframe.sinks.feed_source import FeedWriter, write_feed


def parts(folder):
    return sorted(glob.glob(f"{folder}/part-*"))


def test_csv_quoting_and_gzip(spark, tmp_path):
    names = ("text_no", "type", "issued", "title", "language", "authors", "subjects", "locc", "bookshelves")
    rows = [(2, "Text", "2020-01-01", 'A "B", C\nor, D', "en", "X; Y", "", "", ""), (1, "Sound", "2021-01-01", "Plain", "", "", "s", "l", "b")]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {'bigint' if n == 'text_no' else 'string'}" for n in names))
    writers.write_catalog_csv(frame, str(tmp_path / "feed"))
    read = []
    for name in parts(tmp_path / "feed" / "plain"):
        with open(name, newline="") as handle:
            read += list(csv.reader(handle))[1:]
    assert read == [[str(v) for v in r] for r in sorted(rows)]
    zipped = "".join(gzip.open(n, "rt", newline="").read() for n in parts(tmp_path / "feed" / "gzip"))
    assert 'A ""B"", C\nor, D' in zipped and zipped.startswith("Text#,Type,Issued,Title,Language,Authors,Subjects,LoCC,Bookshelves\n")


def read_marc(data):
    """Records of an ISO 2709 file by its own directory."""
    while data:
        size, base = int(data[:5]), int(data[12:17])
        record, data = data[:size], data[size:]
        assert record[-1:] == b"\x1d" and record[base - 1 : base] == b"\x1e"
        fields = []
        for at in range(24, base - 1, 12):
            tag, length, start = record[at : at + 3].decode(), int(record[at + 3 : at + 7]), int(record[at + 7 : at + 12])
            field = record[base + start : base + start + length]
            assert field[-1:] == b"\x1e"
            fields.append((tag, field[:-1].decode()))
        yield record[:24].decode(), fields


def test_marc_binary(spark, catalog, tmp_path):
    writers.write_marc_binary(feeds.marc(catalog), str(tmp_path / "mrc"))
    records = [r for n in parts(tmp_path / "mrc") for r in read_marc(open(n, "rb").read())]
    assert len(records) == 1226
    for leader, fields in records:
        assert leader[5:12] == "cam a22" and leader[17:] == "3u 4500"
        tags = [t for t, _ in fields]
        assert tags == sorted(tags) and {"001", "003", "008", "245" if "245" in tags else "040", "856"} <= set(tags)
        assert tags.count("100") <= 1
        assert len(dict(fields)["008"]) == 40


def test_a_failed_feed_leaves_nothing(spark, tmp_path):
    value = F.when(F.col("id") == 77, F.raise_error(F.lit("broken record")).cast("string")).otherwise(F.col("id").cast("string"))
    with pytest.raises(Exception, match="broken record"):
        write_feed(spark.range(0, 100, 1, 4).select(value.alias("value")), str(tmp_path / "feed"), "\x1d")
    seen = lambda: [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")]  # tasks in flight may leave hidden files
    assert seen() == []
    write_feed(spark.range(0, 100, 1, 4).select(F.col("id").cast("string").alias("value")), str(tmp_path / "feed"), "\x1d")
    data = [open(n).read() for n in parts(tmp_path / "feed")]
    assert sorted("".join(data).split("\x1d")[:-1], key=int) == [str(k) for k in range(100)]
    manifest = json.loads((tmp_path / "feed" / "_manifest.json").read_text())["parts"]
    assert [p["n_bytes"] for p in manifest] == [len(d) for d in data] and sum(p["n_records"] for p in manifest) == 100
    before = {p.name: p.read_bytes() for p in (tmp_path / "feed").iterdir()}
    with pytest.raises(Exception, match="FileExistsError|feed"):
        write_feed(spark.range(3).select(F.col("id").cast("string").alias("value")), str(tmp_path / "feed"), "\n")
    assert {p.name: p.read_bytes() for p in (tmp_path / "feed").iterdir()} == before and seen() == ["feed"]


def test_a_repeated_task_counts_once(tmp_path):
    writer = FeedWriter(str(tmp_path / "feed"), "\n")
    batch = pa.RecordBatch.from_pydict({"value": ["é", None, "b"]})
    writer.write(iter([batch]))
    told = writer.write(iter([batch]))
    assert (told.n_records, told.n_bytes) == (3, 6)
    writer.commit([told, None])
    assert sorted(p.name for p in (tmp_path / "feed").iterdir()) == ["_manifest.json", told.name] and not list(tmp_path.glob(".*"))
    assert (tmp_path / "feed" / told.name).read_text() == "é\n\nb\n"


def test_empty_feed(spark, tmp_path):
    write_feed(spark.range(0).select(F.col("id").cast("string").alias("value")), str(tmp_path / "feed"), "\n")
    assert (tmp_path / "feed" / "_manifest.json").exists()


def test_marc_oversize_goes_aside(spark):
    field = "struct<code:string,value:string>"
    schema = f"pk bigint, tag string, grp int, ord bigint, ind1 string, ind2 string, data string, subfields array<{field}>"
    rows = [(1, "500", 0, i, " ", " ", None, [("a", "é" * 900)]) for i in range(60)] + [(2, "001", 0, 0, "", "", "2", None), (3, "520", 0, 0, " ", " ", None, [("a", "x" * 9990)]), (4, "520", 0, 0, " ", " ", None, [("a", "x" * 10000)])]
    fields = spark.createDataFrame(rows, schema)
    assert sorted(r.pk for r in marc_feed.oversize(fields).collect()) == [1, 4]
    whole = marc_feed.records(fields)
    assert sorted(r.pk for r in whole.collect()) == [1, 2, 3, 4]
    assert sorted(r.pk for r in marc_feed.iso2709(whole).collect()) == [2, 3]


def test_marcxml_holds_long_records(spark, tmp_path):
    field = "struct<code:string,value:string>"
    schema = f"pk bigint, tag string, grp int, ord bigint, ind1 string, ind2 string, data string, subfields array<{field}>"
    fields = spark.createDataFrame([(7, "520", 0, 0, " ", " ", None, [("a", "x" * 12_000)]), (8, "520", 0, 0, " ", " ", None, [("a", "y")])], schema)
    writers.write_marcxml(fields, str(tmp_path / "xml"))
    text = "".join(open(n, encoding="utf-8").read() for n in parts(tmp_path / "xml"))
    assert text.count("<record>") == 2 and "x" * 12_000 in text
    writers.write_marc_binary(fields, str(tmp_path / "mrc"))
    assert [r.pk for r in spark.read.parquet(str(tmp_path / "mrc-oversize")).collect()] == [7]


def test_marc_binary_agrees_for_absent_parts(spark, tmp_path):
    field = "struct<code:string,value:string>"
    schema = f"pk bigint, tag string, grp int, ord bigint, ind1 string, ind2 string, data string, subfields array<{field}>"
    rows = [(1, "001", 0, 0, "", "", "1", None), (1, "245", 0, 1, "1", None, None, [("a", "Ünï"), ("b", None)]), (1, "500", 0, 2, None, None, None, None), (1, "653", 0, 3, " ", " ", None, [("a", "last")])]
    writers.write_marc_binary(spark.createDataFrame(rows, schema), str(tmp_path / "mrc"))
    data = b"".join(open(n, "rb").read() for n in parts(tmp_path / "mrc"))
    found = [r for r in read_marc(data)]
    assert int(data[:5]) == len(data) and len(found) == 1
    assert found[0][1] == [("001", "1"), ("245", "1 \x1faÜnï\x1fb"), ("500", "  "), ("653", "  \x1falast")]


def test_feeds_hold_ids_beyond_the_dummy(spark):
    books = spark.createDataFrame([(5,), (99_999,), (123_456,)], "pk bigint")
    none = spark.createDataFrame([], "fk_books bigint")
    assert [r.pk for r in scans.scan_books(books).collect()] == [5, 123_456]
    assert sorted(r.pk for r in scans.scan_text_books_range(books, none).collect()) == [5, 123_456]
    assert [r.pk for r in scans.scan_text_books_range(books, none, 6).collect()] == [123_456]


def test_one_language_field_per_book(spark):
    terms = spark.createDataFrame([(1, "lang", p, f"l{p}") for p in (0, 999, 1000, 2500)], "fk_books bigint, kind string, pos bigint, value string")
    rows = marc_feed._term_fields(terms).collect()
    assert [(r.tag, [s.value for s in r.subfields]) for r in rows] == [("041", ["l0", "l999", "l1000", "l2500", "iso639-1"])]


def test_marcxml(spark, catalog, tmp_path):
    writers.write_marcxml(feeds.marc(catalog).filter("pk < 50"), str(tmp_path / "xml"))
    ns = "{http://www.loc.gov/MARC21/slim}"
    seen = 0
    for name in parts(tmp_path / "xml"):
        root = ET.parse(name).getroot()
        assert root.tag == f"{ns}collection"
        for record in root.findall(f"{ns}record"):
            seen += 1
            assert record.find(f"{ns}controlfield[@tag='001']").text.isdigit()
            title = record.find(f"{ns}datafield[@tag='264']")
            assert [s.get("code") for s in title.findall(f"{ns}subfield")] == ["a", "b", "c"]
    assert seen > 20


def test_rdf_documents_parse(spark, catalog, tmp_path):
    from folioframe.plans.rdf_feed import rdf_documents

    rows = rdf_documents(feeds.triples(catalog).filter("book < 40")).collect()
    assert len(rows) == 40
    for row in rows:
        root = ET.fromstring(row.document.encode())
        assert len(root) == row.document.count("</rdf:Description>")


ATTRIBUTES = [(1, 10, 908, "old", 0), (2, 10, 908, "older", 0), (3, 11, 500, "note", 0), (4, 12, 908, "stale", 0)]
SCHEMA = "pk bigint, fk_books bigint, fk_attriblist int, text string, nonfiling int"


def test_upsert_attribute(spark):
    table = spark.createDataFrame(ATTRIBUTES, SCHEMA)
    changes = spark.createDataFrame([(10, "new"), (11, "added"), (12, None), (13, None)], "fk_books bigint, text string")
    once = snapshots.upsert_attribute(table, changes, 908)
    rows = {tuple(r) for r in once.collect()}
    assert rows == {(1, 10, 908, "new", 0), (2, 10, 908, "older", 0), (3, 11, 500, "note", 0), (5, 11, 908, "added", 0)}
    assert {tuple(r) for r in snapshots.upsert_attribute(once, changes.filter("text IS NOT NULL"), 908).collect()} == rows


def test_snapshot_table(spark, tmp_path):
    store = snapshots.SnapshotTable(spark, str(tmp_path / "table"))
    store.replace(spark.range(3).toDF("id"))
    store.replace(store.read().filter("id > 0"))
    (tmp_path / "table" / "v-7").mkdir()
    assert sorted(r.id for r in store.read().collect()) == [1, 2]


def test_every_decision_occurs(spark, catalog):
    plan = build.build_plan(
        catalog["v_books"], catalog["v_categories"], catalog["v_files"].withColumn("extent", F.col("extent") * 4), catalog["v_disk_listing"], catalog["v_targets"], ("txt.utf-8",)
    )
    found = {r.decision for r in plan.select("decision").distinct().collect()}
    assert found == {"already_posted", "not_text", "no_source", "too_big", "build", "missing_source", "skip_fresh"}
    reasons = {r.reason for r in plan.select("reason").distinct().collect()}
    assert {"asked for", "source has changed since", "does not exist", "needs no source"} <= reasons


def test_credits(spark):
    rows = [(1, 5, 508, "Updated: x", 0), (2, 5, 508, "long credit", 0), (3, 5, 508, "short", 0), (4, 5, 508, "same  long", 0), (5, 6, 508, "only", 0), (6, 5, 500, "n", 0), (7, 7, 508, "Updated: y", 0), (8, 5, 508, "long_credit", 0)]
    gone = intake.credits_to_delete(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.pk for r in gone} == {1, 3, 4, 7}


def test_address_book(spark):
    rows = [(1, "99999", "notify", "eric@a.net"), (2, "99999", "notify", "eric@b.com"), (3, "99999", "ww", "dora"), (4, "x", "ww", "q@q"), (5, "99999", "ww", "")]
    book = intake.address_book(spark.createDataFrame(rows, "seq int, ebook string, role string, email string"))
    assert intake.address_map(book).first().addresses == {"notify": "eric@b.com", "ww": "dora@library.example.org"}


def test_revisions_fill_gaps_then_stop(spark):
    arrivals = spark.createDataFrame([("a.json", i) for i in range(12)] + [("b.json", 1)], "name string, seq int")
    existing = spark.createDataFrame([("a.json", -1), ("a.json", 2)], "name string, slot int")
    found = {(r.name, r.seq): r.slot for r in intake.assign_revisions(arrivals, existing).collect()}
    assert [found["a.json", i] for i in range(12)] == [0, 1, 3, 4, 5, 6, 7, 8, 9, None, None, None] and found["b.json", 1] == -1


def test_newest_submission(spark):
    names = ["backup/7.json", "backup/7.json.0", "backup/7.json.3", "8.txt", "backup/8.json.9", "9.json", "9.txt", "backup/5.json", "6.bak"]
    rows = [(int(n.split("/")[-1].split(".")[0]), f"/logs/{n}", n) for n in names]
    found = {r.ebook: r.content for r in intake.pick_newest(spark.createDataFrame(rows, "ebook bigint, path string, content string")).collect()}
    assert found == {7: "backup/7.json.3", 8: "8.txt", 9: "9.json", 5: "backup/5.json"}


def test_merge_fills_only_gaps(spark):
    meta = spark.createDataFrame([(1, None, None, "en", None, None, None), (2, "P", None, "en", "s", "k", "c"), (3, None, None, "fr", None, "", "")], "pk bigint, publisher string, country string, first_language string, scan_url string, request_key string, credit string")
    data = '{"DATA":{"LANGUAGE":"English","PUBLISHER":"M","SOURCE_PUBLICATION_YEARS":["copyright:1920","1955"],"SCANS_ARCHIVE_URL":["u","v"],"CREDIT":"R","REQUEST_KEY":"q"}}'
    files = spark.createDataFrame([(i, data) for i in (1, 2, 3, 4)] + [(5, "{")], "ebook bigint, text string")
    rows = {r.pk: r for r in intake.merge_workflow(meta, intake.workflow_records(files)).collect()}
    assert set(rows) == {1, 2, 3}
    assert (rows[1].language, rows[1].publisher, rows[1].scan_urls, rows[1].credit, rows[1].changed) == ("English", "M", ["u", "v"], "R", True)
    assert [tuple(y) for y in rows[1].years] == [("copyright", "1920"), ("copyright", "1955")]
    assert not rows[2].changed and rows[3].language is None and rows[3].credit == "R" and rows[3].request_key == "q"


def test_undelivered_keeps_the_message(spark):
    notices = spark.createDataFrame([(199, "broken"), (200, "bad")], "ebook bigint, record string")
    addresses = spark.createDataFrame([(200, "ww", "w@x.org")], "ebook bigint, role string, email string")
    processed = spark.createDataFrame([(199,), (300,)], "ebook bigint")
    sent = outbox.notice_outbox(notices, processed, addresses, "2024-01-01 00:00:00")
    assert {(r.ebook, r.kind, r.email) for r in sent.collect()} == {(199, "critical", None), (200, "critical", "w@x.org"), (300, "processed", None)}
    archived = {r.ebook: r.value for r in outbox.undelivered(sent).collect()}
    assert set(archived) == {199, 300} and "broken" in archived[199] and archived[199].startswith("ww: 2024-01-01T00:00:00\nSubject: ")


def test_link_bytes(spark):
    books = spark.createDataFrame([(80000, 'Ä "q"', "Bö", "de")], "pk bigint, title string, authors string, lang string")
    row = outbox.with_post_text(outbox.post_candidates(books)).filter("media = 'Bluesky'").first()
    raw = row.message.encode()
    assert raw[row.byte_start : row.byte_end].decode() == row.link and row.byte_end == len(raw) and '\\"q\\"' in row.message


def test_hot_links(spark):
    links = spark.createDataFrame([(i, 1, "de" if i % 2 else "it", f"T{i}") for i in range(200)] + [(5, 2, "en", "E"), (4, 2, "fr", "F")], "pk int, fk_books bigint, lang string, title string")
    langs = spark.createDataFrame([(1, "fr"), (2, "fr")], "pk bigint, lang string")
    assert {r.fk_books: r.title for r in reading.pick_wiki_link(links, langs).collect()} == {1: "T199", 2: "F"}
