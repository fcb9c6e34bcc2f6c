"""Hand-written rows for each quirk of the scalar rules."""

import fnmatch

import pytest
from pyspark.sql import functions as F

from folioframe.functions import globs, paths, people, submissions, texts, titles
from folioframe.operators.changes import classify_changelog, expand_range_items, parse_range_items, range_predicate
from folioframe.plans import reading
from folioframe.plans.inventory import _jpeg_size


def one(spark, schema, row, *columns):
    return tuple(spark.createDataFrame([row], schema).select(*columns).first())


LIFE = "b int, b2 int, d int, d2 int"


@pytest.mark.parametrize(
    "row, expected",
    [
        ((1842, None, 1922, None), "1842-1922"),
        ((None, 1850, None, None), "1850?-"),
        ((1840, 1850, 1900, 1900), "1850?-1900"),
        ((-43, None, 17, None), "44 BCE-17"),
        ((None, -43, None, None), "44? BCE-"),
        ((-50, -40, None, None), "41? BCE-"),
        ((-5, 3, None, None), "3?-"),
        ((0, None, 0, 1900), "-1900?"),
        ((None, None, None, None), "-"),
    ],
)
def test_life_dates(spark, row, expected):
    assert one(spark, LIFE, row, people.life_dates(*[F.col(c) for c in ("b", "b2", "d", "d2")])) == (expected,)


@pytest.mark.parametrize(
    "name, dated, expected",
    [
        ("Fowler, T. M. (Thaddeus Mortimer)", True, ("Fowler, T. M.", "(Thaddeus Mortimer),")),
        ("Fowler, T. M. (Thaddeus Mortimer)", False, ("Fowler, T. M.", "(Thaddeus Mortimer)")),
        ("Plain, Jane", True, ("Plain, Jane,", None)),
        ("Plain, Jane", False, ("Plain, Jane", None)),
        ("Two (One) (Two)", False, ("Two (Two)", "(One)")),
    ],
)
def test_heading_name(spark, name, dated, expected):
    columns = people.heading_name(F.col("n"), F.col("d")), people.heading_fuller_name(F.col("n"), F.col("d"))
    assert one(spark, "n string, d boolean", (name, dated), *columns) == expected


@pytest.mark.parametrize("title, a, b", [("Emma", "Emma", None), ("Emma\nA Novel\nIn Three", "Emma :", "A Novel In Three"), ("E\n", "E :", "")])
def test_title_parts(spark, title, a, b):
    assert one(spark, "t string", (title,), titles.main_title(F.col("t")), titles.rest_of_title(F.col("t"))) == (a, b)


def test_clean_title_and_pretty(spark):
    assert one(spark, "t string", ("  A \n  B\n\nC  ",), titles.clean_title(F.col("t"))) == ("A\nB\nC",)
    assert one(spark, "t string, a string", ("Emma", "Jane"), titles.pretty_title(F.col("t"), F.col("a"), 8)) == ("Emma by…",)


@pytest.mark.parametrize(
    "score, expected",
    [(-5, "Professional level"), (0, "Professional level"), (9.9, "Professional level"), (10, "College graduate level"), (30, "College-level"),
     (50, "10th to 12th grade"), (60, "8th & 9th grade"), (70, "7th grade"), (80, "6th grade"), (90, "5th grade"), (100, "5th grade"), (130, "5th grade")],
)
def test_bands_share_edges_upwards(spark, score, expected):
    assert one(spark, "s double", (float(score),), texts.grade(F.col("s"))) == (expected,)


@pytest.mark.parametrize("score", [62.25, 62.75, 83.25, 61.04, -3.25, 100.0])
def test_score_text_rounds_like_the_feed(spark, score):
    shown = one(spark, "s double", (score,), texts.score_text(F.col("s")))[0]
    assert shown.startswith("Reading ease score: %.1f (" % score)


WRAPPED = {
    "no marker": ("a\nb", "a\nb"),
    "plain": ("head\n*** START OF THIS\nbody\n*** END OF THIS\nfoot", "body"),
    "last start counts": ("*** START OF A\nx\n*** START OF B\ny\n*** END OF B", "y"),
    "first end counts": ("*** START OF A\nx\n*** END OF A\n*** START OF B\ny\n*** END OF B", "x"),
    "no end": ("h\n*** START OF A\n\n body \n", "body"),
    "end only": ("body\n*** END OF A\nfoot", "body"),
    "end first": ("*** END OF A\nrest", ""),
    "inside a line": ("say *** START OF it\nz", "say *** START OF it\nz"),
    "start is last line": ("h\n*** START OF A", ""),
}


def unwrapped(text):
    lines = text.split("\n")
    ends = [i for i, line in enumerate(lines) if line.startswith("*** END OF")]
    lines = lines[: ends[0]] if ends else lines
    starts = [i for i, line in enumerate(lines) if line.startswith("*** START OF")]
    return "\n".join(lines[starts[-1] + 1 :] if starts else lines).strip()


@pytest.mark.parametrize("case", WRAPPED)
def test_wrapper(spark, case):
    text, expected = WRAPPED[case]
    assert unwrapped(text) == expected
    once = one(spark, "t string", (text,), texts.without_wrapper(F.col("t")))
    assert once == (expected,)
    assert one(spark, "t string", once, texts.without_wrapper(F.col("t"))) == (expected,)


GLOBS = ["txt/*", "html/iso-8859-*", "*/*", "a?c", "[0-3]*", "[!0-3]*", "x[", "a.b", "epub.dp", "*", "a*b*c"]
NAMES = ["txt/utf-8", "html/iso-8859-1", "html/utf-8", "abc", "aXc", "3x", "4x", "x[", "a.b", "axb", "epub.dp", "", "a/b/c", "aabbc"]


@pytest.mark.parametrize("glob", GLOBS)
def test_globs(spark, glob):
    rows = spark.createDataFrame([(n,) for n in NAMES], "n string").filter(globs.glob_matches(F.col("n"), glob)).collect()
    assert {r.n for r in rows} == {n for n in NAMES if fnmatch.fnmatchcase(n, glob)}


@pytest.mark.parametrize("book, expected", [(64156, "6/4/1/5/64156"), (7, "0/7"), (10, "1/10"), (123, "1/2/123")])
def test_archive_dir(spark, book, expected):
    assert one(spark, "b bigint", (book,), paths.archive_dir(F.col("b"))) == (expected,)


@pytest.mark.parametrize(
    "path, book, expected",
    [("6/4/1/5/64156/64156-h.htm", 64156, "files/64156/64156-h.htm"), ("etext98/x.txt", 12, "dirs/etext98/x.txt"), ("cache/epub/1/pg1.txt", 1, "cache/epub/1/pg1.txt"), ("12/x", 12, "12/x")],
)
def test_shelf_path(spark, path, book, expected):
    assert one(spark, "p string, b bigint", (path, book), paths.shelf_path(F.col("p"), F.col("b"))) == (expected,)


@pytest.mark.parametrize("path, ext", [("a/b.txt", ".txt"), ("a.d/b", ""), ("a/.profile", ""), ("x.tar.gz", ".gz"), ("a/b.", ".")])
def test_extension(spark, path, ext):
    assert one(spark, "p string", (path,), paths.extension(F.col("p"))) == (ext,)


@pytest.mark.parametrize(
    "path, key", [("4554.txt", "04 4554-z"), ("4554-0.txt", "04 4554-0-z"), ("a/4554-h.htm", "02 a/4554-h-z"), ("4554.zip", "994554-z"), ("x.rst", "00 x-z"), ("x.xhtml", "99x-z")]
)
def test_metadata_key(spark, path, key):
    assert one(spark, "p string", (path,), paths.metadata_key(F.col("p"))) == (key,)


@pytest.mark.parametrize(
    "base, rel, expected",
    [("/c/1/", "images/a.jpg", "/c/1/images/a.jpg"), ("/c/1/x.htm", "../2/./a.jpg", "/c/2/a.jpg"), ("/c/1/", "/abs/a.jpg", "/abs/a.jpg"),
     ("https://h.org/a/b.htm", "c/../d.jpg", "https://h.org/a/d.jpg"), ("/c/", "http://o.org/x", "http://o.org/x")],
)
def test_join_url(spark, base, rel, expected):
    assert one(spark, "b string, r string", (base, rel), paths.join_url(F.col("b"), F.col("r"))) == (expected,)


@pytest.mark.parametrize("path, root", [("/x", "absolute"), ("cache/x", "public"), ("dirs/x", "public"), ("12/x", "files"), ("1/2/x", "dirs"), ("etext98/x", "dirs")])
def test_path_roots(spark, path, root):
    full = {"absolute": path, "public": "/r/" + path, "files": "/r/files/" + path, "dirs": "/r/dirs/" + path}[root]
    assert one(spark, "p string", (path,), paths.root_kind(F.col("p")), paths.resolved_path(F.col("p"), "/r")) == (root, full)


@pytest.mark.parametrize("email, expected", [("anna", "anna@lib.org"), (" carl ", "carl@lib.org"), ("x@y.z", "x@y.z"), ("", None), (None, None)])
def test_email(spark, email, expected):
    from folioframe.profile import LibraryProfile

    assert one(spark, "e string", (email,), submissions.normal_email(F.col("e"), LibraryProfile(mail_domain="lib.org"))) == (expected,)


@pytest.mark.parametrize(
    "json, expected",
    [('{"DATA":{"Y":"copyright:1920"}}', "copyright=1920"), ('{"DATA":{"Y":["copyright:1920","1955","a:b:c",""]}}', "copyright=1920;copyright=1955"), ('{"DATA":{"Y":""}}', None), ('{"DATA":{}}', None)],
)
def test_publication_events(spark, json, expected):
    years = submissions.publication_events(submissions.list_at(F.try_parse_json("j"), "$.DATA.Y"))
    assert one(spark, "j string", (json,), submissions.events_text(years)) == (expected,)


HEADER = "License\n\nTitle: The Fake\n\nAuthor: Lorem Jr.\n        Ernest H.\n\nRelease Date: July 21, 2021 [EBook #99999]\n[Most recently updated: July 23, 2021]\n\nLanguage: English\n\n*** START OF THIS ***\n\nProduced by Post Processor\n"


def test_header_fields(spark):
    fields = texts.header_fields(F.col("t"))
    row = one(spark, "t string", (HEADER,), *fields.values())
    assert dict(zip(fields, row)) == {
        "title": "The Fake", "authors": "Lorem Jr.; Ernest H.", "released": "July 21, 2021", "book_id": 99999, "language": "English", "credit": "Post Processor",
    }


def test_html_text(spark):
    html = "<html><head><title>t</title></head><body class='x'><!-- no --><p>a &amp;lt; b</p><script>var x='<p>';</script> c&nbsp;d</body></html>"
    assert one(spark, "h string", (html,), texts.html_body_text(F.col("h"))) == ("a &lt; b c d",)


@pytest.mark.parametrize("answer, valid", [("VERDICT: YES", True), ("verdict:no", False), ("so Verdict: \n Yes!", True), ("maybe", False)])
def test_verdict(spark, answer, valid):
    assert one(spark, "a string", (answer,), texts.verdict(F.col("a"))) == (valid,)


def test_decode(spark):
    rows = spark.createDataFrame([("é".encode(),), ("é".encode("latin-1"),), (b"",)], "b binary").select(texts.decoded(F.col("b"))).collect()
    assert [r[0] for r in rows] == ["é", "é", ""]


LINKS = {
    "Wikipedia page about this book: https://en.wikipedia.org/wiki/Emma_(novel)": ("en", "Emma_(novel)"),
    "http://de.wikipedia.org/wiki/Faust": ("de", "Faust"),
    "https://sco.wikipedia.org/wiki/Emma": None,
    "https://en.wikipedia.org/wiki/Emma_(disambiguation)": None,
    "https://en.wikipedia.org/wiki/Caf%C3%A9": ("en", "Caf"),
    "https://example.org/": None,
}


@pytest.mark.parametrize("text", LINKS)
def test_wiki_link(spark, text):
    found = one(spark, "t string", (text,), reading.wiki_link(F.col("t")))[0]
    assert (tuple(found) if found else None) == LINKS[text]


@pytest.mark.parametrize("text, bad", [("It appears that", True), ("It seems", True), ("Well, no content provided here", True), ("A novel. It appears later", False)])
def test_refusals(spark, text, bad):
    assert one(spark, "t string", (text,), reading.is_refusal(F.col("t"))) == (bad,)


RANGES = {"1,2-4": [1, 2, 3, 4], "8-": [8, 9, 10], "-3": [1, 2, 3], "5-2,7": [7], "x,3,3": [3, 3], "": [], "1-2-3": [], "-": list(range(1, 11)), "12-": []}


@pytest.mark.parametrize("text", RANGES)
def test_ranges(spark, text):
    requests = spark.createDataFrame([(1, text)], "req_id int, t string")
    last = spark.createDataFrame([(10,)], "last_book bigint")
    ids = [r.ebook for r in expand_range_items(parse_range_items(requests, "t", last)).orderBy("item_pos", "ebook").collect()]
    assert ids == RANGES[text]
    books = spark.range(1, 11).withColumnRenamed("id", "pk")
    assert [r.pk for r in books.filter(range_predicate(text, F.col("pk"), 10)).orderBy("pk").collect()] == sorted(set(RANGES[text]))


def test_wide_range_is_whole(spark):
    requests = spark.createDataFrame([(1, "5-300004")], "req_id int, t string")
    ids = expand_range_items(parse_range_items(requests, "t", spark.createDataFrame([(9,)], "last_book bigint")))
    assert ids.select("ebook").distinct().count() == 300000 and ids.agg(F.max("ebook")).first()[0] == 300004


CHANGES = {
    "update mn_books_authors set x where fk_books = 42": ("author_change", 42, None),
    "delete from mn_books_authors where fk_books = 7": ("author_change", None, None),
    "insert into mn_books_authors (fk_books, fk_authors) values (123, 9)": ("author_add", 123, None),
    'update attributes set  "fk_attriblist" = 245 where pk = 991': ("title_change", None, 991),
    'update attributes set  "fk_attriblist" = 245': ("title_change", None, None),
    "update books set downloads = 1": (None, None, None),
}


@pytest.mark.parametrize("sql", CHANGES)
def test_changelog_kinds(spark, sql):
    row = classify_changelog(spark.createDataFrame([(sql,)], "sql string")).first()
    assert (row.kind, row.book, row.attribute) == CHANGES[sql]


def test_jpeg_size():
    frame = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08\x00\x10\x00\x20\x03\x01\x11\x00"
    assert _jpeg_size(frame) == (32, 16)
    assert _jpeg_size(b"\xff\xd8\xff") == (None, None)


def test_html_text_as_a_parser_sees_it(spark):
    pages = [
        "<html><head><script>var x = '<body>';</script></head><body class='a'>He said &#8217;hi&#8217; &#x2014; caf&eacute; &hellip; &amp;lt; A&B &unknown; &#xD800;</body></html>",
        "<body>one<body>two", "no body &amp; no tags", "<p>kept</p><script>never closed", "a<!-- never closed", "", None,
    ]
    rows = spark.createDataFrame(list(enumerate(pages)), "id int, html string").select("id", texts.html_body_text(F.col("html")).alias("t"))
    found = [r.t for r in rows.orderBy("id").collect()]
    assert found == ["He said ’hi’ — café … &lt; A&B &unknown; �", "onetwo", "no body & no tags", "kept", "a", "", None]
