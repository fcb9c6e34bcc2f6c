"""Token counts by a compiled finite-state transducer.

A byte-pair model without pieces that hold a space after another character cuts a text into segments: one space
marker and the characters up to the next. Within a segment the tokens of a prefix are known from a bounded window:
the longest suffix that a piece can begin with, and for each place in it the last token that ends there. That window
is the state. A transition on a character picks the longest piece that ends there and stands beside the token before
it (the two merge to nothing else), and carries the change of the token count. States and transitions are compiled
when first met and kept.

A chunk of text is a map of states: whatever state enters, the first space brings the same one. So a chunk is its
head up to the first space, the tokens counted after it, and its tail from the last space on; two maps compose in any
grouping. Texts beyond `CHUNK` characters are cut, and the maps of their chunks are composed pairwise, level by level.

Nulls count as empty texts: no bytes, no tokens. Every row of the input gives one row, repeated rows included.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
BEGIN, BEGIN_BACK = re.compile(r"(?<=[^ ]) "), re.compile(r" (?=[^ ])")
CHUNK = 1 << 18
#: Segments and states kept by one worker before it starts anew: memory only, no influence on results.
KEPT = 1_500_000


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces that a text can be made of, with their scores: no control, unknown or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return [(model.id_to_piece(i), model.get_score(i)) for i in plain]


class CountTransducer:
    """Counts tokens of texts; see the module."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.score = dict(pieces)
        if any(MARK in piece.lstrip(MARK) for piece in self.score):
            raise ValueError("a piece holds a space after another character: segments would not be independent")
        self.begins = {piece[:k] for piece in self.score for k in range(1, len(piece) + 1)}
        self.longest = max((len(p) for p in self.score if not p.strip(MARK)), default=1)
        self.beside: dict[tuple[str, str], bool] = {}
        self.states: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.moves: list[dict[str, tuple[int, int]]] = []
        self.spaces: dict[int, int] = {0: 0}
        self.segments: dict[str, int] = {}
        self.start = self.state(("", ((None, 0),)))

    def merged(self, text: str) -> list[str]:
        """Tokens of a short text by repeated merging of the best pair, leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                found = self.score.get(parts[k] + parts[k + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, before: str | None, token: str) -> bool:
        key = (before, token)
        found = self.beside.get(key)
        if found is None:
            whole = [token] if before is None else [before, token]
            found = self.beside[key] = self.merged("".join(whole)) == whole
        return found

    def state(self, key: tuple) -> int:
        found = self.ids.get(key)
        if found is None:
            found = self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        return found

    def width(self, token: str) -> int:
        """Tokens that a merged symbol stands for: one, or its bytes when it is no piece."""
        return 1 if token in self.score else len(token.encode("utf-8", "surrogatepass"))

    def move(self, state: int, char: str) -> tuple[int, int]:
        window, places = self.states[state]
        longer = window + char
        n = len(longer)
        for k in range(n - 1, 0, -1):
            token = longer[n - 1 - k :]
            if token in self.score and self.fits(places[n - 1 - k][0], token):
                break
        else:
            token, k = char, 0
        count = places[n - 1 - k][1] + self.width(token)
        keep = n
        while keep and longer[n - keep :] not in self.begins:
            keep -= 1
        places = (*places, (token, count))[n - keep :]
        found = self.moves[state][char] = (self.state((longer[n - keep :], tuple((t, c - count) for t, c in places))), count)
        return found

    def run(self, text: str, state: int | None = None) -> tuple[int, int]:
        """State after `text` and the change of the count."""
        moves, total = self.moves, 0
        at = self.start if state is None else state
        for char in text:
            step = moves[at].get(char) or self.move(at, char)
            at = step[0]
            total += step[1]
        return at, total

    def gap(self, n: int) -> int:
        """Tokens of `n` markers that no word takes. They merge leftmost first, since their scores are level."""
        longest = self.longest
        if n > 8 * longest:  # full pieces follow one another, so the count repeats with their length
            full = (n - 4 * longest) // longest
            return full + self.gap(n - full * longest)
        if n not in self.spaces:
            self.spaces[n] = len(self.merged(MARK * n))
        return self.spaces[n]

    def tokens(self, text: str) -> list[str]:
        """Tokens of one segment: the last token of each prefix, followed back from the end."""
        last, at = [], self.start
        for char in text:
            at = (self.moves[at].get(char) or self.move(at, char))[0]
            last.append(self.states[at][1][-1][0])
        out, end = [], len(text)
        while end:
            out.append(last[end - 1])
            end -= len(last[end - 1])
        return out[::-1]

    def segment(self, word: str) -> int:
        """Tokens of a word behind one marker."""
        found = self.segments.get(word)
        if found is None:
            if len(self.segments) > KEPT:
                self.segments.clear()
            if len(self.states) > KEPT:
                self.beside.clear()
                self.states, self.ids, self.moves = [], {}, []
                self.start = self.state(("", ((None, 0),)))
            found = self.run(MARK + word)[1]
            if len(word) <= 256:
                self.segments[word] = found
        return found

    def words(self, words: list[str]) -> int:
        """Tokens of words that stand behind one space each; an empty word is one more space before the next."""
        known, total, free = self.segments, 0, 0
        for word in words:
            if word:
                found = known.get(word)
                total += self.segment(word) if found is None else found
                if free:
                    alone = self.tokens(MARK + word)[0] == MARK
                    total += self.gap(free + 1) - 1 if alone else self.gap(free)
                    free = 0
            else:
                free += 1
        return total + (self.gap(free) if free else 0)

    def units(self, text: str) -> int:
        """Tokens of a text that begins with a space and is followed by a new segment."""
        return self.words(text[1:].split(" "))

    def chunk(self, text: str) -> tuple[str, int, str | None]:
        """State map of a chunk: head up to the first place where a segment surely begins, tokens of the segments
        inside, and the last segment; without such a place all is head and the tail is None."""
        first = BEGIN.search(text)
        if not first:
            return text, 0, None
        last = len(text) - 1 - BEGIN_BACK.search(text[::-1]).start()
        return text[: first.start()], self.units(text[first.start() : last]) if last > first.start() else 0, text[last:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """Map of two chunks that follow one another; associative."""
        head, inner, tail = a
        middle = self.chunk((head if tail is None else tail) + b[0])
        if tail is None:
            if b[2] is None:
                return middle
            return middle[0], (middle[1] + self.units(middle[2]) if middle[2] is not None else 0) + b[1], b[2]
        if b[2] is not None:
            return head, inner + self.units(tail + b[0]) + b[1], b[2]
        if middle[2] is None:
            return head, inner, middle[0]
        return head, inner + self.units(middle[0]) + middle[1], middle[2]

    def scan(self, text: str, size: int = CHUNK) -> int:
        """Tokens of a long text: maps of its chunks, composed pairwise, level by level."""
        text = " " + text
        maps = [self.chunk(text[k : k + size]) for k in range(0, len(text), size)]
        while len(maps) > 1:
            maps = [self.compose(*maps[k : k + 2]) if k + 1 < len(maps) else maps[k] for k in range(0, len(maps), 2)]
        head, inner, tail = maps[0]
        return self.units(head) + (inner + self.units(tail) if tail is not None else 0)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(MARK, " ") if MARK in text else text
        return self.words(text.split(" ")) if len(text) <= CHUNK else self.scan(text)


_LOADED: dict[str, CountTransducer] = {}


def transducer(path: str | None) -> CountTransducer:
    """The worker's transducer for a model file; what it has compiled serves all its later tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    if path not in _LOADED:
        _LOADED[path] = CountTransducer(read_pieces(path))
    return _LOADED[path]


def count_tokens(docs: DataFrame, model_path: str | None = None, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row of `docs` (doc_id, text)."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint"

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model_path)
        for batch in batches:
            texts = batch.column("text")
            tokens = pa.array([machine.count(t) for t in texts.to_pylist()], pa.int64())
            sizes = pc.binary_length(texts).cast(pa.int64()).fill_null(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, tokens], ["doc_id", "n_bytes", "n_tokens"])

    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(counts, schema)
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
