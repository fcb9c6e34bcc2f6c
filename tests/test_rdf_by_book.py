"""RDF documents of tables dealt by book: same triples, and no triple moves."""

from folioframe.plans import rdf_feed
from folioframe.registry import feeds


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_of_triples(spark, catalog):
    plan = _plan(rdf_feed.rdf_documents(feeds.triples(catalog, by_book=True)))
    assert "Exchange" not in plan[: plan.index("Union")]


def test_same_triples_and_documents(spark, catalog):
    plain, dealt = feeds.triples(catalog), feeds.triples(catalog, by_book=True)
    some = lambda rows: rows.filter("book % 50 = 1")
    assert some(plain).exceptAll(some(dealt)).count() == some(dealt).exceptAll(some(plain)).count() == 0
    one, other = (some(rdf_feed.rdf_documents(t)) for t in (plain, dealt))
    assert one.exceptAll(other).count() == other.exceptAll(one).count() == 0 and other.count() > 10


def test_triples_of_an_author_are_made_once(spark, catalog):
    """Links meet one gathered row of their author, not a row for each of the author's triples."""
    plan = _plan(feeds.triples(catalog))
    assert "Generate inline(_said" in plan
    assert "filter(array(" not in plan  # absent triples go as rows, without a lambda over every array


def test_lines_that_are_null_are_left_out(spark):
    rows = [(1, "u", "http://purl.org/dc/terms/title", None, "literal", ""), (1, "u", "http://purl.org/dc/terms/title", "x", "literal", ""), (2, "u", "http://purl.org/dc/terms/title", None, "literal", "")]
    found = {r.book: r.document for r in rdf_feed.rdf_documents(spark.createDataFrame(rows, "book int, s string, p string, o string, o_kind string, datatype string")).collect()}
    assert found[2] is None and found[1].count("<rdf:Description ") == 1
