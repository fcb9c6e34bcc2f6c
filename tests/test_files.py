"""File sources and streams over real folders."""

import io
import os
import zipfile

from pyspark.sql import functions as F

from folioframe.plans import inventory
from folioframe.sources import files as src
from folioframe.streaming import spools
from folioframe.streaming.runner import drain_to_files


def put(folder, name, data):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return path


def test_spools(spark, tmp_path):
    for name in ("99999.zip.trig", "4554.zip.trig", "x.trig", "12.zip", "backup/7.zip.trigx"):
        put(tmp_path / "push", name, "")
    found = src.trigger_books(src.list_names(spark, str(tmp_path / "push"))).orderBy("ebook").collect()
    assert [r.ebook for r in found] == [4554, 99999]
    put(tmp_path / "notes", "5.txt", "CRITICAL é")
    put(tmp_path / "notes", "6.txt", "")
    put(tmp_path / "notes", "a6.txt", "no")
    notices = src.notice_queue(src.read_texts(spark, str(tmp_path / "notes"))).collect()
    assert [(r.ebook, r.record) for r in notices] == [(5, "CRITICAL é")]


def test_artifacts(spark, tmp_path):
    kept = ["1/pg1.txt", "22/pg22.txt"]
    for name in kept + ["2/pg2.html", "3.delete/pg3.txt", "DELETE4/pg4.txt", "x/pg5.txt", "7/pg7.rdf"]:
        put(tmp_path / "cache" / "epub", name, "abc")
    listing = src.list_files(spark, str(tmp_path))
    assert [r.path.split("epub/")[1] for r in src.scan_artifacts(listing, "txt").collect()] == kept
    assert [r.path.split("epub/")[1] for r in src.scan_artifacts(listing, "rdf").collect()] == ["7/pg7.rdf"]
    assert "content" not in src.scan_artifacts(listing, "txt").columns


def test_zip_members_in_quality_order(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, data in (("5/5.txt", "t"), ("5/5-8.txt", "é".encode("latin-1")), ("5/5-h.htm", "<p>"), ("5/cover.jpg", "x"), ("5/5.rst", "r")):
            archive.writestr(name, data)
    put(tmp_path, "5.zip", buffer.getvalue())
    put(tmp_path, "6.zip", "no archive")
    members = src.zip_members(src.list_files(spark, str(tmp_path), "*.zip").select("path", "content"))
    rows = members.orderBy("path", "sort_key").collect()
    good = [(r.name, r.text) for r in rows if r.path.endswith("5.zip")]
    assert good == [("5/5.rst", "r"), ("5/5-h.htm", "<p>"), ("5/5-8.txt", "é"), ("5/5.txt", "t")]
    assert [r.problem for r in rows if not r.path.endswith("5.zip")] == ["BadZipFile"]


def test_log_lines_keep_their_numbers_when_split(spark, tmp_path):
    lines = [f"{i} line {'x' * (i % 50)}" for i in range(5000)]
    put(tmp_path, "a.log", "\n".join(lines) + "\n")
    put(tmp_path, "b.log", "ERROR one\nCRITICAL ERROR two\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = src.read_log_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    a = {r.line_no: r.line for r in rows if r.file.endswith("a.log")}
    assert a == {i + 1: line for i, line in enumerate(lines)}
    reports = inventory.log_report(src.read_log_lines(spark, str(tmp_path))).collect()
    assert {(r.report, r.n_lines) for r in reports} == {("error", 2), ("critical", 1)}


def test_log_context_merges_overlaps(spark):
    mark = "This is an ERROR for white-washed files"
    text = ["a", "b", mark, "c", mark, "d", "e", "f", "g"]
    lines = spark.createDataFrame([("l", i + 1, t) for i, t in enumerate(text)], "file string, line_no bigint, line string")
    assert sorted(r.line_no for r in inventory.with_context(lines).collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_image_log_and_sizes(spark, tmp_path):
    put(tmp_path, "img.log", '2024-01-01,https://h.org/files/12/12-h.htm,i1,"a ""quoted"", alt",images/a.png,1\n2024-01-01,https://h.org/x,i2,,b.png,0\n')
    png = bytes.fromhex("89504E470D0A1A0A0000000D4948445200000140000000F0")
    gif = b"GIF89a" + (300).to_bytes(2, "little") + (20).to_bytes(2, "little")
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08\x00\x10\x00\x20\x03\x01\x11\x00"
    for name, data in (("a.png", png), ("b.gif", gif), ("c.jpg", jpeg), ("d.bin", b"?")):
        put(tmp_path / "img", name, data)
    rows = inventory.image_rows(src.read_image_log(spark, str(tmp_path / "img.log"))).collect()
    assert [(r.item, r.alt_txt, r.img_url) for r in rows] == [("12", 'a "quoted", alt', "images/a.png")]
    facts = inventory.image_facts(src.list_files(spark, str(tmp_path / "img"))).collect()
    sizes = {r.path.rsplit("/", 1)[1]: (r.x, r.y) for r in facts}
    assert sizes == {"a.png": (320, 240), "b.gif": (300, 20), "c.jpg": (32, 16), "d.bin": (None, None)}


def test_spool_stream_takes_each_file_once(spark, tmp_path):
    box, out = tmp_path / "box", str(tmp_path / "out")
    put(box, "12.json", '{"DATA":{"TITLE":"One"}}')
    put(box, "notes.json", "{}")

    def drain():
        stream = spools.submissions(spools.spool_stream(spark, str(box), "*.json", str(tmp_path / "done")))
        return drain_to_files(stream.select("ebook", "valid", "title"), out)

    assert [tuple(r) for r in drain().collect()] == [(12, True, "One")]
    put(box, "13.json", "{bad")
    assert sorted(tuple(r) for r in drain().collect()) == [(12, True, "One"), (13, False, None)]
    drain()
    assert not os.path.exists(box / "12.json")


def test_posts_once_over_restarts(spark, tmp_path):
    out, landing = str(tmp_path / "out"), str(tmp_path / "in")
    schema = "fk_books bigint, media string, time timestamp"
    posts = spark.createDataFrame([(1, "Bluesky", None)], schema)
    for batch in ([(1, "Bluesky"), (2, "Bluesky"), (2, "Bluesky")], [(2, "Bluesky"), (3, "Mastodon")]):
        rows = spark.createDataFrame(batch, "fk_books bigint, media string").withColumn("time", F.lit("2024-01-01").cast("timestamp"))
        rows.write.mode("append").parquet(landing)
        spools.post_once(spark.readStream.schema(schema).parquet(landing), posts, out)
    rows = spark.read.parquet(f"{out}/rows").select("fk_books", "media").collect()
    assert sorted(map(tuple, rows)) == [(2, "Bluesky"), (3, "Mastodon")]
