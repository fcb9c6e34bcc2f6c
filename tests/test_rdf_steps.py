"""What the RDF feeds do once a triple or a document, and not for each of its parts."""

import hashlib

from folioframe.operators import graphs
from folioframe.plans.rdf_feed import ntriples, parsed_ntriples
from folioframe.registry import stores

SCHEMA = "book bigint, s string, p string, o string, o_kind string, datatype string"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_is_matched_once(spark):
    lines = spark.createDataFrame([("<a> <b> <c> .",), ("=no line",), ("",), ('_:x <b> "1 > 2 _:y <z>"^^<t> .',), ("<a b> <c> _:d>e .",), ('<a> <b> "" .',), (None,)], "value string")
    assert plan(parsed_ntriples(lines)).count("regexp") == 1
    found = [tuple(r) for r in parsed_ntriples(lines).collect()]
    assert found[:6] == [
        ("a", "b", "c", "uri", ""), ("", "", "", "literal", ""), ("", "", "", "literal", ""),
        ("_:x", "b", "1 > 2 _:y <z>", "literal", "t"), ("a b", "c", "_:d>e", "blank", ""), ("a", "b", "", "literal", ""),
    ]


def test_a_document_is_matched_once(catalog):
    assert plan(stores._rdf_documents_back(catalog)).count("regexp") <= 2  # one for the name


def test_graphs_without_inner_blank_nodes_need_one_round(spark, monkeypatch):
    kept, stage = [], graphs._kept
    monkeypatch.setattr(graphs, "_kept", lambda rows, label: kept.append(label) or stage(rows, label))
    flat = [(1, "book", "has", "_:a", "blank", ""), (1, "_:a", "says", "x", "literal", ""), (1, "book", "is", "y", "literal", "")]
    found = sorted(tuple(r) for r in graphs.canonical_blanks(spark.createDataFrame(flat, SCHEMA)).collect())
    name = "_:c" + hashlib.md5(b"says\tliteral\t\tx").hexdigest()
    assert kept == ["triples", "blank-names"]
    assert found == sorted([("book", "has", name, "blank", ""), (name, "says", "x", "literal", ""), ("book", "is", "y", "literal", "")])


def test_names_of_inner_nodes_are_told_round_by_round(spark):
    rows = [("_:a", "part", "_:b", "blank"), ("_:b", "part", "_:c", "blank"), ("_:c", "says", "x", "literal"), ("_:d", "part", "_:none", "blank"),
            ("_:e", "part", "_:f", "blank"), ("_:f", "part", "_:e", "blank"), ("_:f", "says", "x", "literal"), ("s", "has", "_:a", "blank")]
    names, kinds = {s: "" for s, *_ in rows if s.startswith("_:")}, 0
    while True:
        told = {n: "\n".join(sorted({"\t".join((p, k, "", names.get(o, "") if k == "blank" else o)) for s, p, o, k in rows if s == n})) for n in names}
        new = {n: "_:c" + hashlib.md5(t.encode()).hexdigest() for n, t in told.items()}
        moved, grown, names, kinds = new != names, len(set(new.values())) > kinds, new, len(set(new.values()))
        if not (moved and grown):
            break
    want = {(names.get(s, s), p, names.get(o, "_:c") if k == "blank" else o, k, "") for s, p, o, k in rows}
    triples = spark.createDataFrame([(1, s, p, o, k, "") for s, p, o, k in rows], SCHEMA)
    assert {tuple(r) for r in graphs.canonical_blanks(triples).collect()} == want
    assert sorted(map(tuple, parsed_ntriples(ntriples(triples)).collect())) == sorted((s, p, o, k, "") for s, p, o, k in rows)
