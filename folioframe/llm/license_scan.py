"""Licence scan: an Aho-Corasick automaton finds notice phrases and identifier tags, a shunting-yard parser evaluates
what they say.

Phrases are found word by word in a text that was lower-cased (A-Z) and cut into words of letters, digits and all
characters beyond ASCII; tags (`SPDX-License-Identifier:`, `License:` and alike) are found in the lower-cased text
itself, and the expression after a tag is read from there as far as it makes sense: licence names, brackets and the
operators `or`, `and`, `with`. After a tag that promises an expression any name counts, after a looser one only a name
of a known family. Notices that are joined by nothing but `or` or `and` and fill words (`under the MIT license or the
Apache license`) make one expression too.

Expressions go through the shunting-yard algorithm: `with` binds tighter than `and`, `and` tighter than `or`. A licence
stands for how freely it lets a text be used (`FREEDOM`), `or` takes the freer side, `and` the stricter one, and an
exception lifts a licence to `LINKING` at least. All expressions of a text hold at once, so its score is the strictest;
a text that names no licence grants nothing and scores 0.

Null and empty texts have no words and no labels. Every row gives one row, repeated rows included; other columns are not
carried. Both automata are walked once over each text, in time linear in its length and its matches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import parts, text_column

# The phrases whose places are counted, with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# End of fixed values.

#: Further phrases. A longer phrase stands for a shorter one inside it where an expression is made.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "bsl",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "creative commons zero": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "released into the public domain": "public-domain",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "this is free and unencumbered software": "unlicense",
    "all rights reserved": "reserved",
}
#: How freely a text under a licence of each family may be used; names of no family count as `other`.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "0bsd": 1.0, "mit": 0.9, "mit-0": 1.0, "bsd": 0.9, "isc": 0.9, "zlib": 0.9, "bsl": 0.9, "apache": 0.9,
    "cc-by": 0.8, "mpl": 0.6, "epl": 0.6, "lgpl": 0.6, "cc-by-sa": 0.4, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.2, "cc-by-nc-sa": 0.2,
    "cc-by-nc-nd": 0.1, "other": 0.1, "reserved": 0.0,
}
LINKING = 0.6
#: Tags in lower-cased text, and whether any name may follow.
TAGS = {"spdx-license-identifier:": True, "license-expression:": True, "license:": False, "licence:": False, 'license":': False, "@license": False}
#: Words that say nothing between two notices of one expression.
FILL = frozenset("the a an either both under terms of version v1 v2 v3 v4 license licence your option at 0 1 2 3 4".split())
RANK = {"or": 1, "and": 2, "with": 3}

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORDS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in _LOWER)
_TOKEN = re.compile(r"[ \t]*([()]|[a-z0-9][a-z0-9.+-]*)")
_VERSIONED = re.compile(r"(-\d+-clause)?(-v?\d+(\.\d+)*)?(-only|-or-later|\+)?")


def family(name: str) -> str:
    """`gpl` for `gpl-2.0-or-later`; `other` where no family is known."""
    if name in FREEDOM:
        return name
    cut = next((k for k in range(1, len(name)) if name[k] in "-+" and name[:k] in FREEDOM and _VERSIONED.fullmatch(name, k)), 0)
    return name[:cut] if cut else "other"


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands in order, each operator after its two; brackets left open end with the expression."""
    out: list[str] = []
    waiting: list[str] = []
    for token in tokens:
        if token in RANK:
            while waiting and waiting[-1] != "(" and RANK[waiting[-1]] >= RANK[token]:
                out.append(waiting.pop())
            waiting.append(token)
        elif token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        else:
            out.append(token)
    return out + [token for token in reversed(waiting) if token != "("]


def freedom(tokens: list[str]) -> float:
    """How freely an expression lets its text be used."""
    values: list[float] = []
    for token in postfix(tokens):
        if token in RANK:
            right, left = values.pop(), values.pop()
            values.append({"or": max(left, right), "and": min(left, right), "with": max(left, LINKING)}[token])
        else:
            values.append(FREEDOM[family(token)])
    return values[0]


def licences(tokens: list[str]) -> list[str]:
    """Families that an expression names: all operands but the exceptions."""
    return [family(t) for before, t in zip(["", *tokens], tokens) if t not in RANK and t not in "()" and before != "with"]


def expression_at(text: str, at: int, any_name: bool) -> tuple[list[str], int]:
    """The longest sound expression that begins at `at`, brackets closed, and the place after what was read."""
    while at < len(text) and text[at] in " \t\"'":
        at += 1
    tokens: list[str] = []
    sound, depth, open_now, want_name = 0, 0, 0, True
    while found := _TOKEN.match(text, at):
        token = found[1]
        if want_name and token == "(":
            depth += 1
        elif want_name and token not in RANK and token != ")":
            token = token.rstrip(".-")
            exception = tokens[-1:] == ["with"]
            if not (any_name or exception or family(token) != "other"):
                break
            want_name = False
        elif not want_name and token in RANK and not (token == "with" and tokens[-2:-1] == ["with"]):
            want_name = True
        elif not want_name and token == ")" and depth:
            depth -= 1
        else:
            break
        tokens.append(token)
        at = found.end()
        if not want_name:
            sound, open_now = len(tokens), depth
    return (tokens[:sound] + [")"] * open_now if sound else []), at


@cache
def automata() -> tuple:
    """Automata of phrases, between spaces, and of tags; built once in each worker."""
    import ahocorasick

    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE}.items():
        phrases.add_word(f" {phrase} ", (len(phrase.split()), label, phrase in BASE))
    for tag, any_name in TAGS.items():
        tags.add_word(tag, any_name)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def places(words: list[str]) -> list[tuple[int, int, str, bool]]:
    """First word, word after the last, label and kind of all phrases, in the order of their ends."""
    joined = f" {' '.join(words)} "
    out, seen, read = [], 0, 0
    for end, (size, label, base) in automata()[0].iter(joined):
        seen += joined.count(" ", read, end)  # spaces before the one that ends the match: one for each word up to there
        read = end
        out.append((seen - size, seen, label, base))
    return out


def notices(words: list[str], found: list[tuple[int, int, str, bool]]) -> list[list[str]]:
    """Expressions of the phrases found: of overlapping ones the first and longest counts, neighbours are joined by a lone or / and."""
    out: list[list[str]] = []
    last = -1
    for start, end, label, _ in sorted(found, key=lambda x: (x[0], -x[1])):
        if start < last:
            continue
        between = words[last:start] if 0 <= start - last <= 12 and last >= 0 else None
        if between is not None:
            plain = re.sub(r"\bor (any )?later\b", "", " ".join(between)).split()
            joint = [w for w in plain if w not in FILL]
            if joint in (["or"], ["and"]):
                out[-1] += [joint[0], label]
                last = end
                continue
        out.append([label])
        last = end
    return out


def scan(text: str) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score and the expressions of a text."""
    lowered = text.encode().translate(_LOWER)
    words = lowered.translate(_WORDS).decode().split(" ")
    words = [w for w in words if w]
    found = places(words)
    stated, read = notices(words, found), 0
    plain = lowered.decode()
    for end, any_name in automata()[1].iter(plain):
        if end >= read:
            tokens, read = expression_at(plain, end + 1, any_name)
            if tokens:
                stated.append(tokens)
    base = [x for x in found if x[3]]
    base_labels = {x[2] for x in base}
    labels = base_labels | {x[2] for x in found} | {label for tokens in stated for label in licences(tokens)}
    score = min(map(freedom, stated), default=0.0)
    starts = [x[0] for x in base]
    return len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, list(map(" ".join, stated))


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>"


def scan_licenses(docs: DataFrame, scanner: Callable[[str], tuple] = scan) -> DataFrame:
    """doc_id with the places of base phrases, labels, score and expressions of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            columns = list(zip(*map(scanner, part.column("text").to_pylist()), strict=True))
            kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), pa.list_(pa.string())]
            names = [c.split()[0] for c in COLUMNS.split(", ")]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], ["doc_id", *names])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {COLUMNS}"
    return docs.select("doc_id", text_column().alias("text")).mapInArrow(run, schema)
