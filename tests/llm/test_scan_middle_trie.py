"""Licence scan, fill-in-middle and conversation trie beside brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import collected, documents, prose, rows

from __spark_entry__ import oracle_sql, queries
from folioframe.llm import fill_in_middle, license_scan, prefix_trie
from folioframe.llm.common import table

SMALL = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_base(text: str) -> tuple:
    words = WORD.findall(lowered(text))
    starts = [(k, label) for k in range(len(words)) for phrase, label in license_scan.BASE.items() if words[k : k + len(phrase.split())] == phrase.split()]
    places = [k for k, _ in starts]
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in starts}))


def test_base_places_equal_plain_search(spark):
    rng, pieces = random.Random(1), [*"GNU general Public LICENSE apache license cc by MIT license cc-by by-nc é日 İ 2.0 \n , __ mit".split(" "), "GNU General Public License", "\x00", "Cc By\tby"]
    for _ in range(4000):
        text = rng.choice([" ", ", ", "-"]).join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert license_scan.scan(text)[:5] == plain_base(text), text
    found = {r.doc_id: r for r in queries()["op11_license_scan"](spark, SMALL).collect()}
    for r in table(spark, SMALL, "documents").select("doc_id", "text").collect():
        assert tuple(found[r.doc_id][1:6]) == plain_base(r.text or "")
        assert set(filter(None, found[r.doc_id].base_labels.split(","))) <= set(found[r.doc_id].labels.split(","))


def test_expressions_equal_recursive_evaluation():
    rng, names = random.Random(2), ["mit", "gpl-2.0", "apache-2.0", "cc-by-nc-4.0", "strange"]

    def made(depth: int) -> tuple[list[str], float, int]:
        """Tokens, value and the rank of the weakest operator."""
        if not depth or rng.random() < 0.3:
            name = rng.choice(names)
            value = license_scan.FREEDOM[license_scan.family(name)]
            return ([name, "with", "some-exception"], max(value, license_scan.LINKING), 3) if rng.random() < 0.3 else ([name], value, 4)
        op = rng.choice(["or", "and"])
        (a, x, ra), (b, y, rb) = made(depth - 1), made(depth - 1)
        rank = license_scan.RANK[op]
        a, b = (["(", *t, ")"] if r < rank or rng.random() < 0.2 else t for t, r in ((a, ra), (b, rb)))
        return [*a, op, *b], max(x, y) if op == "or" else min(x, y), rank

    for _ in range(2000):
        tokens, value, _ = made(4)
        assert license_scan.freedom(tokens) == value
        assert license_scan.expression_at(" " + " ".join(tokens) + " */ mit", 0, True)[0] == tokens


SAID = [
    ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-or-later WITH Classpath-exception-2.0 */", "apache,gpl,mit", 0.6),
    ("under the GNU General Public License, version 3 or later, or the MIT License.", "gpl,mit", 0.9),
    ("License: MIT and the rest", "mit", 0.9), ("License: who knows", "", 0.0), ('"license": "BSD-3-Clause",', "bsd", 0.9),
    ("SPDX-License-Identifier: LicenseRef-x AND (MIT", "mit,other", 0.1), ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc", 0.2),
    ("MIT License. Also the Apache License.", "apache,mit", 0.9), ("license: license: mit or", "mit", 0.9), ("SPDX-License-Identifier: )", "", 0.0),
]


@pytest.mark.parametrize(("text", "labels", "score"), SAID)
def test_labels_and_score(text, labels, score):
    found = license_scan.scan(text)
    assert (found[5], found[6]) == (labels, score)


def test_many_phrases_and_tags_take_linear_time():
    text = "mit license, " * 100_000 + "SPDX-License-Identifier: " + "(mit or " * 50_000
    found = license_scan.scan(text)
    assert found[1:4] == (100_000, 0, 199_998) and found[6] == 0.9


@pytest.mark.parametrize("error", [1, 5, 128])
def test_rank_index_is_exact_and_bounded(error):
    rng = np.random.default_rng(error)
    for steps in (np.zeros(0, int), rng.integers(1, 9, 5000), np.concatenate([rng.integers(1, 4, 900), [100_000], rng.integers(1, 4, 900)]), rng.integers(1, 2, 3000), 10 ** rng.integers(0, 5, 300)):
        offsets = np.concatenate([[0], np.cumsum(steps)]).astype(np.int64)
        index = fill_in_middle.RankIndex(offsets, error)
        ranks = rng.permutation(len(offsets))
        assert (index.offsets(ranks) == offsets[ranks]).all() and np.abs(index.residuals).max() <= error + 1
    assert len(fill_in_middle.RankIndex(np.arange(0, 90_000, 3)).starts) == 1


def test_boundaries_equal_the_pattern():
    rng, alphabet = random.Random(4), [*" \t\n\r\x0b\x0cab", "é", "日本", "😀", "\x00", "\x1c", " ", " ", "<S"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 20))) for _ in range(3000)] + ["", " ", "x"]
    for texts_now in (texts, [""], ["a", "", " b"], []):
        array = pa.array(["first", *texts_now], pa.string()).slice(1)
        for text, found in zip(texts_now, fill_in_middle.boundaries(array), strict=True):
            assert found.tolist() == [0, *(m.end() for m in TOKEN.finditer(text))]


def plain_middle(doc_id, text):
    text, units = text or "", TOKEN.findall(text or "")
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(m in text for m in fill_in_middle.MARKS) or h3 % 100 >= 50:
        return (doc_id, n, "plain", None, None, text, text)
    a, b = sorted([h1 % (n + 1), h2 % (n + 1)])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text)
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text)


def test_fill_in_middle_equals_plain_cutting(spark):
    rng, alphabet = random.Random(6), [*" \t\nab<PS>", "é", "日本", "😀", "<P>"]
    given = [(r[0], r[1]) for r in rows()] + [(1000 + k, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))) for k in range(600)]
    docs = spark.createDataFrame(given, "doc_id bigint, text string").repartition(4)
    found = fill_in_middle.fill_in_middle(docs).withColumn("back", fill_in_middle.restored())
    assert collected(found) == sorted((plain_middle(*g) for g in given), key=repr)
    assert {r.form for r in found.select("form").distinct().collect()} == {"plain", "spm", "psm"}


def plain_trie(turns: list[tuple]) -> list[tuple]:
    own = defaultdict(list)
    key = lambda t: hashlib.md5(f"{len(t[2] or '')}:{t[2] or ''}{t[3] or ''}".encode()).hexdigest()
    for t in sorted(turns, key=lambda t: (t[1] is not None, t[1] or 0, key(t))):
        if t[0] is not None:
            own[t[0]].append((t[2] or "", t[3] or ""))
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + mine[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    sha = lambda node: hashlib.sha256(",".join(str(c) for c in members[node] if len(built[c]) == len(node)).encode()).hexdigest()
    return sorted(
        ((m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(children[n]), leaves[n], saved[n], sha(n)) for n, m in members.items()), key=repr
    )


TURNS = "conv_id bigint, turn bigint, role string, text string"


def chats(seed: int, n: int = 150) -> list[tuple]:
    rng, out = random.Random(seed), []
    for c in rng.sample(range(4 * n), n):
        first = rng.choice(["hello", "hi", None, "é日"])
        out += [(c, k, rng.choice(["user", None]), first if not k else rng.choice(["yes", "no", "", None, prose(k, 3)])) for k in range(rng.randint(1, 14))]
    out += [(3000 + k, 0, "user", "same") for k in range(300)] + [(5000, k, "user", f"t{k}") for k in range(2600)] + [(5003, k, "user", f"t{k}") for k in range(1500)]
    out += [(6000, None, "a", "null first"), (6000, 0, "a", "x"), (6000, 0, "a", "x"), (6000, 0, "b", "tie"), (None, 0, "a", "no id"), (None, None, None, None), (7001, 0, "a", "short")]
    return out


@pytest.mark.parametrize("sizes", [{}, {"siblings": 4, "hot": 20, "task_arcs": 300, "least": 20, "block": 100}])
def test_trie_equals_plain_trie(spark, sizes):
    turns = chats(len(sizes))
    frame = spark.createDataFrame(turns, TURNS).selectExpr("*", "'x' AS place", "1 AS a", "'y' AS depth", "2 AS n_convs", "'z' AS row", "0 AS digest").repartition(5)
    found = prefix_trie.prefix_trie(*prefix_trie.rebuilt(prefix_trie.ordered_turns(frame)), **sizes)
    assert collected(found) == plain_trie(turns)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], TURNS)).count() == 0
    turns = [(c, 0, "a", "x") for c in range(2, 5)]
    assert collected(prefix_trie.rebuilt_trie(spark.createDataFrame(turns, TURNS))) == plain_trie(turns)


def test_list_rank_of_a_long_list(spark):
    rng = random.Random(8)
    ids = rng.sample(range(10**6), 3000)
    sizes = [rng.randint(1, 5) for _ in ids]
    runs = [(a, a % 3, b, None if b is None else b % 3, s) for a, b, s in zip(ids, [*ids[1:], None], sizes, strict=True)]
    rng.shuffle(runs)
    found = prefix_trie.list_rank(spark.createDataFrame(runs, "run_id long, run_code long, to_id long, to_code long, size long"), least=40)
    assert [r.run_id for r in found.orderBy("start").collect()] == ids
    assert [r.start for r in found.orderBy("start").collect()] == [sum(sizes[:k]) for k in range(3000)]


OPERATORS = {"op11": license_scan.scan_licenses, "op12": fill_in_middle.digest}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_extra_columns(spark, name):
    plain = collected(OPERATORS[name](documents(spark)))
    assert plain == collected(OPERATORS[name](documents(spark, extra=True).repartition(3))) and len(plain) == len(rows())
    none = OPERATORS[name](documents(spark, []))
    assert none.count() == 0 and none.columns


@pytest.mark.parametrize("key", ["op12_fill_in_middle", "op13_prefix_trie"])
def test_query_equals_sql(spark, key):
    from check import compare

    total, _, problem = compare(spark, queries(), oracle_sql(), key, "0.001")
    assert not problem, problem
