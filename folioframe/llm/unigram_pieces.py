"""SentencePiece encoding and decoding under a unigram model: Viterbi over a double-array trie of pieces.

Encoding puts a space marker before the text and for every space, and picks the pieces with the greatest sum of log
scores; a character that is no piece costs the least score less 10 and becomes one byte piece for each of its bytes.
At equal sums the longer last piece wins. No piece holds a marker behind another character, so the best path passes
every place where a marker follows one: the text is cut there, and each distinct segment of a batch is solved once,
all of them side by side in arrays. Segments beyond `WIDE` bytes are solved one at a time, in linear time.

Decoding joins the pieces, turns markers into spaces and bytes into text (bytes that are no UTF-8 become U+FFFD), and
drops the first space. It restores every text that holds no marker character of its own.

The model file's scores are taken as they are. Null texts are encoded like empty ones: no ids. Repeated rows stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import parts, widened

MARK = "▁"
MARK_BYTES = MARK.encode()
WIDE = 96
PENALTY = 10.0


@dataclass
class Pieces:
    """Double-array trie over the bytes of the pieces, and what each id decodes to."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray  # id that ends at a node, or -1
    score: np.ndarray  # by id
    raw: list[bytes]  # by id; empty for control pieces
    first_byte: int  # id of byte 0
    unknown: float
    spelled: np.ndarray  # ids that stand for a byte


def double_array(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, check and value arrays: the child of node s on byte b is t = base[s] + b + 1 where check[t] == s."""
    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for word, value in words.items():
        at = 0
        for byte in word:
            at = children[at].setdefault(byte, len(children))
            if at == len(children):
                children.append({})
        ends[at] = value
    size = 2 * len(children) + 2048
    base, check, value, free = [0] * size, [-1] * size, [-1] * size, bytearray(b"\x01") * size
    free[0] = 0
    place, low, queue, tried = {0: 0}, 1, [0], {}
    for node in queue:
        here = place[node]
        value[here] = ends.get(node, -1)
        steps = sorted(byte + 1 for byte in children[node])
        if not steps:
            continue
        low = free.index(1, low)
        # the first base from which all children fall on free cells; nodes with as many children go on where the last one ended
        first, found = steps[0], 0
        cell = max(low, tried.get(len(steps), 0), first)
        while True:
            cell = free.find(1, cell)
            if cell < 0 or cell + 258 > len(free):
                grow = len(free)
                base += [0] * grow
                check += [-1] * grow
                value += [-1] * grow
                free += bytearray(b"\x01") * grow
                cell = free.index(1, cell if cell >= 0 else grow)
            found = cell - first
            if all(free[found + step] for step in steps):
                break
            cell += 1
        if len(steps) > 1:
            tried[len(steps)] = cell
        base[here] = found
        for step in steps:
            child = children[node][step - 1]
            free[found + step] = 0
            check[found + step] = here
            place[child] = found + step
            queue.append(child)
    last = max(place.values()) + 258
    return tuple(np.array((x + [-1] * 258)[:last], np.int64) for x in (base, check, value))


def load_pieces(path: str | None = None) -> Pieces:
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    score = np.array([model.get_score(i) for i in ids])
    special = np.array([model.is_control(i) or model.is_unknown(i) for i in ids])
    spelled = np.array([model.is_byte(i) for i in ids])
    names = [model.id_to_piece(i) for i in ids]
    raw = [b"" if special[i] else bytes([int(names[i][1:-1], 16)]) if spelled[i] else names[i].encode() for i in ids]
    plain = {raw[i]: i for i in ids if not special[i] and not spelled[i]}
    if any(MARK_BYTES in w.removeprefix(MARK_BYTES * (len(w) // 3)).lstrip(b"\xe2\x96\x81") for w in plain):
        raise ValueError("a piece holds a space after another character: segments would not be independent")
    base, check, value = double_array(plain)
    first = int(np.flatnonzero(spelled).min())
    return Pieces(base, check, value, score, raw, first, float(score[~special & ~spelled].min()) - PENALTY, spelled)


def paths(model: Pieces, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best pieces of N segments given as an N x L matrix of bytes: ids in one array, and how many each has."""
    n, width = data.shape
    best = np.full((n, width + 1), -np.inf)
    best[:, 0] = 0.0
    back = np.zeros((n, width + 1), np.int32)  # where the last piece begins
    last = np.full((n, width + 1), -1, np.int32)  # its id, -1 for a byte
    lead = (data & 0xC0) != 0x80
    limit = len(model.check)
    for start in range(width):
        rows = np.flatnonzero((sizes > start) & lead[:, start])
        if not len(rows):
            continue
        so_far = best[rows, start]
        # a character without a piece: its bytes, one piece each
        nodes, alive, value_of_one = np.zeros(len(rows), np.int64), np.arange(len(rows)), np.zeros(len(rows), bool)
        char_end = np.full(len(rows), width)
        open_char = np.ones(len(rows), bool)
        for end in range(start + 1, min(start + 5, width + 1)):
            closed = open_char & ((sizes[rows] == end) | (lead[rows, end] if end < width else True))
            char_end[closed] = end
            open_char &= ~closed
        for end in range(start + 1, width + 1):
            here = rows[alive]
            cells = model.base[nodes[alive]] + data[here, end - 1].astype(np.int64) + 1
            ok = (cells < limit) & (sizes[here] >= end)
            cells = np.where(ok, cells, 0)
            ok &= model.check[cells] == nodes[alive]
            alive, cells = alive[ok], cells[ok]
            if not len(alive):
                break
            nodes[alive] = cells
            found = model.piece[cells]
            some = found >= 0
            at, ids = alive[some], found[some]
            value_of_one[at] |= char_end[at] == end
            total = so_far[at] + model.score[ids]
            better = total > best[rows[at], end]
            at, ids, total = at[better], ids[better], total[better]
            best[rows[at], end] = total
            back[rows[at], end] = start
            last[rows[at], end] = ids
        at = np.flatnonzero(~value_of_one)
        if len(at):
            total, ends = so_far[at] + model.unknown, char_end[at]
            better = total > best[rows[at], ends]
            at, total, ends = at[better], total[better], ends[better]
            best[rows[at], ends] = total
            for k in range(min(4, width - start)):  # the bytes of the character, one step each
                inside = start + 1 + k <= ends
                back[rows[at[inside]], start + 1 + k] = start + k
                last[rows[at[inside]], start + 1 + k] = -1
    out = np.zeros((n, width), np.int32)
    counts = np.zeros(n, np.int64)
    rows, at = np.arange(n), sizes.astype(np.int64).copy()
    rows = rows[at > 0]
    at = at[at > 0]
    while len(rows):
        ids = last[rows, at]
        ids = np.where(ids < 0, model.first_byte + data[rows, at - 1].astype(np.int32), ids)
        counts[rows] += 1
        out[rows, width - counts[rows]] = ids
        at = back[rows, at]
        rows, at = rows[at > 0], at[at > 0]
    lane = np.arange(width)
    return out[lane >= width - counts[:, None]], counts


def long_path(model: Pieces, text: bytes) -> np.ndarray:
    """The same for one long segment, place by place."""
    n = len(text)
    best, back, last = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    base, check, piece, score = (x.tolist() for x in (model.base, model.check, model.piece, model.score))
    limit = len(check)
    for start in range(n):
        if text[start] & 0xC0 == 0x80:
            continue
        stop = start + 1
        while stop < n and text[stop] & 0xC0 == 0x80:
            stop += 1
        node, single = 0, False
        for end in range(start + 1, n + 1):
            cell = base[node] + text[end - 1] + 1
            if cell >= limit or check[cell] != node:
                break
            node = cell
            found = piece[cell]
            if found >= 0:
                single |= end == stop
                total = best[start] + score[found]
                if total > best[end]:
                    best[end], back[end], last[end] = total, start, found
        if not single and best[start] + model.unknown > best[stop]:
            best[stop] = best[start] + model.unknown
            for k in range(start + 1, stop + 1):
                back[k], last[k] = k - 1, -1
    out, at = [], n
    while at:
        out.append(last[at] if last[at] >= 0 else model.first_byte + text[at - 1])
        at = back[at]
    return np.array(out[::-1], np.int32)


def segment_ids(model: Pieces, segments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct segments, one after another, and the offsets of each; segments are without their first marker."""
    marked = pc.binary_join_element_wise(pa.scalar(MARK_BYTES, pa.large_binary()), segments.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    sizes = pc.binary_length(marked).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(marked.to_pylist()), np.uint8) if len(marked) else np.zeros(0, np.uint8)
    data = np.concatenate([data, np.zeros(WIDE, np.uint8)])
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    below = 0
    for width in (6, 8, 10, 12, 16, 24, 48, WIDE):
        chosen = np.flatnonzero((sizes > below) & (sizes <= width))
        below = width
        for k in range(0, len(chosen), 65536):
            some = chosen[k : k + 65536]
            ids, counts = paths(model, data[offsets[some][:, None] + np.arange(width)], sizes[some])
            parts.append((some, ids, counts))
    for k in np.flatnonzero(sizes > WIDE).tolist():
        ids = long_path(model, data[offsets[k] : offsets[k + 1]].tobytes())
        parts.append((np.array([k]), ids, np.array([len(ids)])))
    counts = np.zeros(len(sizes), np.int64)
    for some, _, found in parts:
        counts[some] = found
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
    for some, ids, found in parts:
        starts = ends[some] - found
        step = np.arange(len(ids)) - np.repeat(np.cumsum(found) - found, found)
        out[np.repeat(starts, found) + step] = ids
    return out, np.concatenate([[0], ends])


def encode_batch(model: Pieces, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a batch, one after another, and the offsets of each text."""
    texts = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), MARK, " ")
    lists = pc.split_pattern(texts, " ")
    words = lists.flatten()
    rows = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
    blank = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    if empty.any():  # several spaces in a row begin one segment together
        keep = ~blank[rows]
        words, rows, empty = words.filter(pa.array(keep)), rows[keep], empty[keep]
        lone = np.flatnonzero(empty)
        if len(lone):
            joined, place = [], []
            n, k = len(words), 0
            values = words.to_pylist()
            while k < n:
                first = k
                while k + 1 < n and empty[k] and rows[k + 1] == rows[first]:
                    k += 1
                joined.append(MARK * (k - first) + values[k])
                place.append(rows[first])
                k += 1
            words, rows = pa.array(joined, pa.large_string()), np.array(place, np.int64)
    found = words.dictionary_encode()
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ids, offsets = segment_ids(model, found.dictionary)
    counts = np.diff(offsets)[codes] if len(codes) else np.zeros(0, np.int64)
    step = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    out = ids[np.repeat(offsets[:-1][codes], counts) + step] if len(codes) else np.zeros(0, np.int32)
    per_text = np.bincount(rows, weights=counts, minlength=len(texts)).astype(np.int64)
    return out, np.concatenate([[0], np.cumsum(per_text)])


def decode_batch(model: Pieces, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Texts of the ids between each two offsets."""
    pieces = pa.array(model.raw, pa.large_binary()).take(pa.array(ids))
    ends = np.frombuffer(pieces.buffers()[1], np.int64)[: len(pieces) + 1] if len(pieces) else np.zeros(1, np.int64)
    whole = pieces.buffers()[2].to_pybytes() if len(pieces) and pieces.buffers()[2] else b""
    out = []
    for a, b in zip(ends[offsets[:-1]].tolist(), ends[offsets[1:]].tolist(), strict=True):
        out.append(whole[a:b].replace(MARK_BYTES, b" ").removeprefix(b" ").decode("utf-8", "replace"))
    return out


def shared_pieces(spark: SparkSession, model_path: str | None) -> Broadcast:
    """The trie, built once; its size is bounded by the vocabulary."""
    return spark.sparkContext.broadcast(load_pieces(model_path))


def encode(docs: DataFrame, column: str = "text", into: str = "piece_ids", model_path: str | None = None, check: str | None = None) -> DataFrame:
    """Adds the ids of `column` as an array of ints, beside all columns of `docs`; with `check`, a boolean column of that
    name too, whether decoding the ids gives the text back."""
    model = shared_pieces(docs.sparkSession, model_path)
    kept = docs.drop(into, *([check] if check else []))
    schema = widened(kept, into, "array<int>")
    if check:
        schema.add(check, "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, column):
            ids, offsets = encode_batch(model.value, batch.column(column))
            more = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))]
            if check:
                texts = batch.column(column).fill_null("").to_pylist()
                more.append(pa.array([a == b for a, b in zip(decode_batch(model.value, ids, offsets), texts, strict=True)], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[f.name for f in schema])

    return kept.mapInArrow(run, schema)


def decode(rows: DataFrame, column: str = "piece_ids", into: str = "decoded", model_path: str | None = None) -> DataFrame:
    """Adds the text of the ids in `column`; null ids give a null text, unknown and control ids nothing."""
    model = shared_pieces(rows.sparkSession, model_path)
    schema = widened(rows.drop(into), into, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(column)
            flat = lists.flatten().fill_null(0).to_numpy(zero_copy_only=False)
            flat = np.where((flat >= 0) & (flat < len(model.value.raw)), flat, 0)
            offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))])
            texts = decode_batch(model.value, flat, offsets)
            found = pa.array(texts, pa.string(), mask=pc.is_null(lists).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, into])

    return rows.drop(into).mapInArrow(run, schema)


def digest(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, ids_sha256 (of the ids as little-endian 32-bit numbers) and restored: whether
    decoding the ids gives the text back (null counts as empty)."""
    model = shared_pieces(docs.sparkSession, model_path)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_pieces bigint, n_byte_pieces bigint, ids_sha256 string, restored boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            texts = batch.column("text").fill_null("")
            ids, offsets = encode_batch(model.value, texts)
            bytes_before = np.concatenate([[0], np.cumsum(model.value.spelled[ids])])
            raw = ids.astype("<i4").tobytes()
            sums = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            same = [a == b for a, b in zip(decode_batch(model.value, ids, offsets), texts.to_pylist(), strict=True)]
            columns = [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(np.diff(bytes_before[offsets])), pa.array(sums), pa.array(same)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_pieces", "n_byte_pieces", "ids_sha256", "restored"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
