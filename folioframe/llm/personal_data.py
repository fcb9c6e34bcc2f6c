"""Personal data by a semi-Markov conditional random field over candidate segments.

Plain patterns give the base spans of four kinds; they always stay. The field adds what they miss: spelled-out
addresses, numbers that a neighbouring number hides in a longer run, other separators. Candidates are whole segments of
at most `LONGEST` characters, described by features of the segment as a whole (parts, digits, check sum, boundaries)
after spelled separators are read as signs. Each cluster of candidates is a small lattice; dynamic programming over it
picks the set of segments and kinds with the greatest sum of weights, outside scoring 0.

It is trained on the corpus itself: base spans are the labels, and segments with shifted ends, failing or spoilt numbers
and the other kinds are what they compete with; weights follow the gradient of the log likelihood (forward and backward sums
over the lattice). Training reads at most `max_rows` documents, those with the least hash of the id.

A null text counts as empty. Spans are code points, end exclusive, sorted by start, then kind, then end. The counts by
kind are of base spans; `n_added` counts the spans that the field adds. Repeated rows each give their row.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts

KINDS = ("email", "ip", "card", "phone")
LONGEST = 96
Span = tuple[int, int, str]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GROUP = re.compile(r"[0-9]+")
_AT = r"(?:\s?[(\[{<]\s?at\s?[)\]}>]\s?|\sat\s|\s?@\s?)"
_DOT = r"(?:\s?[(\[{<]\s?dot\s?[)\]}>]\s?|\sdot\s|\s?[(\[{]\.[)\]}]\s?|\.)"
_SPELLED_EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]{{1,40}}(?:{_DOT}[A-Za-z0-9_%+-]{{1,30}}){{0,3}}{_AT}[A-Za-z0-9-]{{1,40}}(?:{_DOT}[A-Za-z0-9-]{{1,20}}){{1,4}}", re.IGNORECASE)
_SPELLED_IP = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.IGNORECASE)
_PARTED_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20._/-]{1,3}[0-9]{3,6}){2,3}(?![0-9])")
_SIGNS = re.compile(r"[(\[{<]\s?at|\sat\s|@\s|\s@|[(\[{<]\s?dot|\sdot\s|[(\[{]\.", re.IGNORECASE)
_HINT = re.compile(r"@ | @|[(\[{<] ?(?:at|AT|At|dot|DOT|Dot|\.) ?[)\]}>]| (?:dot|DOT|Dot) ")


def luhn(digits: str) -> bool:
    total = 0
    for k, x in enumerate(reversed(digits)):
        d = ord(x) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _octets(groups: list[str]) -> bool:
    return all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or "0") <= 255 for g in groups)


def base_spans(text: str) -> list[Span]:
    """Valid matches of the plain patterns, leftmost and non-overlapping for each kind, in time linear in the text."""
    out: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            out.append((start, last, "email"))
        else:
            last = at + 1
        at = text.find("@", last)
    for found in _CHAIN.finditer(text):
        groups = list(_GROUP.finditer(found.group()))
        for k in range(0, len(groups) - 3, 4):
            four = groups[k : k + 4]
            if _octets([g.group() for g in four]):
                out.append((found.start() + four[0].start(), found.start() + four[3].end(), "ip"))
    for found in _RUN.finditer(text):
        digits = found.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((found.start(), found.end(), "card"))
    at = text.find("+")
    while at >= 0:
        found = _PHONE.match(text, at)
        if found and 10 <= sum(c in "0123456789" for c in found.group()) <= 15:
            out.append((found.start(), found.end(), "phone"))
        at = text.find("+", found.end() if found else at + 1)
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _plain(segment: str) -> str:
    """The segment with spelled separators as signs."""
    segment = re.sub(_AT, "@", segment, flags=re.IGNORECASE)
    return re.sub(_DOT, ".", segment, flags=re.IGNORECASE)


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Segments that the field may choose besides the base spans."""
    found: set[tuple[int, int]] = set()
    taken = {(s, e) for s, e, _ in base}
    for run in _RUN.finditer(text):
        if 14 <= len(run.group()) and (run.start(), run.end()) not in taken:
            groups = [(g.start() + run.start(), g.end() + run.start()) for g in _GROUP.finditer(run.group())]
            for k in range(len(groups)):
                for j in range(k, min(k + 5, len(groups))):
                    size = sum(e - s for s, e in groups[k : j + 1])
                    if size > 19:
                        break
                    if size >= 14:
                        found.add((groups[k][0], groups[j][1]))
    found |= {m.span() for m in _PARTED_CARD.finditer(text)}
    at = text.find("+")
    while at >= 0:
        phone = _PHONE.match(text, at)
        if phone and (phone.start(), phone.end()) not in taken:
            for g in _GROUP.finditer(phone.group()):
                if g.end() >= 10:
                    found.add((phone.start(), phone.start() + g.end()))
                if g.end() > 40:
                    break
        at = text.find("+", at + 1)
    if _HINT.search(text):
        found |= {m.span() for m in _SPELLED_EMAIL.finditer(text) if _SIGNS.search(m.group())}
        found |= {m.span() for m in _SPELLED_IP.finditer(text) if _SIGNS.search(m.group())}
    return sorted(s for s in found if s[1] - s[0] <= LONGEST)


def outside(segments: list[tuple[int, int]], base: list[Span]) -> list[tuple[int, int]]:
    """Segments that overlap no base span."""
    spans = sorted((s, e) for s, e, _ in base)
    starts, reach = [s for s, _ in spans], []
    for _, e in spans:
        reach.append(max(e, reach[-1]) if reach else e)
    return [c for c in segments if not (k := bisect_left(starts, c[1])) or reach[k - 1] <= c[0]]


def features(text: str, start: int, end: int) -> list[str]:
    """Features of a whole segment; each is paired with every kind."""
    segment = _plain(text[start:end])
    digits = "".join(c for c in segment if c in "0123456789")
    letters = sum(c.isalpha() for c in segment)
    out = ["any", f"digits{min(len(digits), 20)}", f"letters{min(letters // 4, 6)}", f"at{min(segment.count('@'), 2)}", f"plus{int(segment[:1] == '+')}"]
    parts_ = segment.split(".")
    if letters == 0 and len(parts_) == 4 and all(p.isascii() and p.isdigit() for p in parts_):
        out.append(f"octets{int(_octets(parts_))}")
    else:
        out.append("no_octets")
    if 14 <= len(digits) <= 19 and not letters:
        out.append(f"sum{int(luhn(digits))}")
    else:
        out.append("no_sum")
    out.append(f"phone{int(segment[:1] == '+' and 10 <= len(digits) <= 15 and not letters)}")
    local, _, domain = segment.partition("@")
    names = domain.split(".")
    whole = bool(local) and len(names) > 1 and all(re.fullmatch(r"[A-Za-z0-9-]+", n) for n in names)
    out.append(f"address{int(whole)}")
    out.append(f"top{min(len(names[-1]), 5) if whole and names[-1].isalpha() else 0}")
    left = text[start - 1 : start]
    right = text[end : end + 1]
    out.append(f"left{int(left.isalnum() or left in ('+', '.', '_', '-', '@') and bool(left))}")
    out.append(f"right{int(right.isalnum() or right == '@' or (right in ('.', '-') and text[end + 1 : end + 2].isalnum()))}")
    out.append(f"edge{int(not segment[:1].isalnum() and segment[:1] != '+')}{int(not segment[-1:].isalnum())}")
    return out


Weights = dict[tuple[str, str], float]


def lattice(segments: list[tuple[int, int]], scores: list[list[float]], turn: list[list[float]]):
    """Forward and backward sums of all sets of disjoint segments with kinds (in logs), and the log of their total."""
    n, k = len(segments), len(KINDS)
    add = lambda values: (m := max(values)) + math.log(sum(math.exp(v - m) for v in values))
    forward = [[0.0] * k for _ in range(n)]
    for i, (start, _) in enumerate(segments):
        before = [j for j in range(i) if segments[j][1] <= start]
        for t in range(k):
            forward[i][t] = scores[i][t] + add([0.0, *(forward[j][u] + turn[u][t] for j in before for u in range(k))])
    backward = [[0.0] * k for _ in range(n)]
    for i in range(n - 1, -1, -1):
        after = [j for j in range(i + 1, n) if segments[j][0] >= segments[i][1]]
        for t in range(k):
            backward[i][t] = add([0.0, *(turn[t][u] + scores[j][u] + backward[j][u] for j in after for u in range(k))])
    total = add([0.0, *(forward[i][t] for i in range(n) for t in range(k))])
    return forward, backward, total


def clusters(segments: list[tuple[int, int]], gap: int = 24) -> Iterator[list[tuple[int, int]]]:
    """Segments by their ends, in runs whose neighbours overlap or lie close; runs beyond 16 end at the next gap."""
    held: list[tuple[int, int]] = []
    reach = 0
    for segment in sorted(segments, key=lambda s: (s[1], s[0])):
        if held and (segment[0] > reach + gap or (len(held) >= 16 and segment[0] >= reach)):
            yield held
            held = []
        held.append(segment)
        reach = max(reach, segment[1]) if len(held) > 1 else segment[1]
    if held:
        yield held


class Field:
    """Weights of (feature, kind) and of neighbouring kinds."""

    def __init__(self, weights: Weights | None = None, turns: list[list[float]] | None = None):
        self.weights = weights or {}
        self.turns = turns or [[0.0] * len(KINDS) for _ in KINDS]

    def scores(self, rows: list[list[str]]) -> list[list[float]]:
        get = self.weights.get
        return [[sum(get((f, kind), 0.0) for f in row) for kind in KINDS] for row in rows]

    def best(self, segments: list[tuple[int, int]], scores: list[list[float]]) -> list[Span]:
        """The best set of disjoint segments with kinds (Viterbi); ends ascend."""
        k = len(KINDS)
        ends = [e for _, e in segments]
        value: list[list[float]] = []
        back: list[list[tuple[int, int] | None]] = []
        so_far: list[list[tuple[float, int]]] = []  # for each kind, the best value up to a segment and where it is
        top, where = 0.0, None
        for i, (start, _) in enumerate(segments):
            j = bisect_right(ends, start, 0, i) - 1
            value.append([0.0] * k)
            back.append([None] * k)
            for t in range(k):
                gain, source = 0.0, None
                for u in range(k) if j >= 0 else ():
                    if so_far[j][u][0] + self.turns[u][t] > gain:
                        gain, source = so_far[j][u][0] + self.turns[u][t], (so_far[j][u][1], u)
                value[i][t], back[i][t] = scores[i][t] + gain, source
                if value[i][t] > top:
                    top, where = value[i][t], (i, t)
            so_far.append([max(so_far[i - 1][t], (value[i][t], i), key=lambda x: x[0]) if i else (value[i][t], i) for t in range(k)])
        out = []
        while where:
            i, t = where
            out.append((*segments[i], KINDS[t]))
            where = back[i][t]
        return out

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Spans that the field finds outside the base spans."""
        free = outside(candidates(text, base), base)
        out: list[Span] = []
        for group in clusters(free) if free else ():
            out += self.best(group, self.scores([features(text, *s) for s in group]))
        return out

    def fit(self, examples: list[tuple[list[tuple[int, int]], list[list[str]], dict[int, int]]], rounds: int = 12, rate: float = 0.3, decay: float = 1e-3) -> Field:
        """AdaGrad on the log likelihood; an example is segments, their features, and the kind of the true ones."""
        seen: dict = defaultdict(lambda: 1.0)
        for _ in range(rounds):
            for segments, rows, truth in examples:
                scores = self.scores(rows)
                forward, backward, total = lattice(segments, scores, self.turns)
                for i, row in enumerate(rows):
                    for t, kind in enumerate(KINDS):
                        error = (truth.get(i) == t) - math.exp(min(0.0, forward[i][t] + backward[i][t] - total))
                        if abs(error) < 1e-4:
                            continue
                        for f in row:
                            key = (f, kind)
                            slope = error - decay * self.weights.get(key, 0.0)
                            seen[key] += slope * slope
                            self.weights[key] = self.weights.get(key, 0.0) + rate * slope / math.sqrt(seen[key])
                true = sorted(truth)
                for u in range(len(KINDS)):
                    for t in range(len(KINDS)):
                        held = sum(truth[a] == u and truth[b] == t for a, b in zip(true, true[1:], strict=False))
                        pairs = sum(
                            math.exp(min(0.0, forward[j][u] + self.turns[u][t] + scores[i][t] + backward[i][t] - total))
                            for i in range(len(segments)) for j in range(i) if segments[j][1] <= segments[i][0]
                        )
                        slope = held - pairs - 100 * decay * self.turns[u][t]  # few neighbours are seen: a strong pull to 0
                        if abs(slope) > 1e-4:
                            seen[u, t] += slope * slope
                            self.turns[u][t] += rate * slope / math.sqrt(seen[u, t])
        return self


def examples(text: str) -> list[tuple[list[tuple[int, int]], list[list[str]], dict[int, int]]]:
    """Training lattices of a text: its base spans beside shifted segments and failing candidates in plain form."""
    base = [b for b in base_spans(text) if b[1] - b[0] <= LONGEST]
    found = {(s, e) for s, e, _ in base}
    for s, e, _ in base:
        found |= {x for x in ((s + 1, e), (s, e - 1), (s + 2, e - 2), (max(0, s - 2), e), (s, min(len(text), e + 2)), ((s + e) // 2, e), (s, (s + e) // 2)) if x[1] > x[0]}
    failing = [c for c in outside(candidates(text, base), base) if not _SIGNS.search(text[c[0] : c[1]])]
    found |= {c for c in failing if not luhn("".join(x for x in text[c[0] : c[1]] if x in "0123456789"))}
    found |= set(outside([m.span() for m in _CHAIN.finditer(text) if m.end() - m.start() <= LONGEST], base))
    kind_of = {(s, e): KINDS.index(k) for s, e, k in base}
    out = []
    for group in clusters(list(found)):
        group = group[:24]
        out.append((group, [features(text, *s) for s in group], {i: kind_of[s] for i, s in enumerate(group) if s in kind_of}))
    for s, e, kind in base:  # the same place with a spoilt number, which is nothing
        if kind == "card":
            spoilt = text[: e - 1] + str((int(text[e - 1]) + 1) % 10) + text[e:]
            out.append(([(s, e)], [features(spoilt, s, e)], {}))
        elif kind == "ip":
            out.append(([(s, e + 3)], [features(text[:s] + "999" + text[s:], s, e + 3)], {}))
    return out


def fit_field(docs: DataFrame, max_rows: int = 600) -> Field:
    """Trains on at most `max_rows` documents that hold a digit or an @."""
    text = F.col("text").cast("string")
    rows = docs.filter(text.rlike(r"@|\+[0-9]|[0-9]{14}|[0-9]\.[0-9]")).select(text.alias("text"), F.xxhash64("doc_id", text).alias("h"))
    least = rows.select("h").orderBy("h").limit(max_rows).distinct()  # hashes first, so that texts of these rows only move
    chosen = rows.join(F.broadcast(least), "h").dropDuplicates(["h"]).sort("h")
    return Field().fit([x for row in chosen.toLocalIterator() for x in examples(row["text"])])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_personal_data(docs: DataFrame, model: Field | None = None, max_rows: int = 600) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added of every row of `docs`."""
    model = model or fit_field(docs, max_rows)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.turns))
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string, n_added bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(*shared.value)
        for batch in parts(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text) if text else []
                more = field.added(text, base) if text else []
                counts = [sum(k == kind for _, _, k in base) for kind in KINDS]
                rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(ordered(base + more)), len(more)))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
