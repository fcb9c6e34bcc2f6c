"""Fill-in-middle: texts are cut at token boundaries found by a learned index of ranks, and their parts change places.

A token is a run of other characters with the ASCII white space before it, or white space that ends a text. The offsets
of all token boundaries of a text, in code points, are a rising function of their rank. `RankIndex` fits it by straight
segments: from a first boundary the cone of slopes that stay within `ERROR` of every offset is narrowed until it is
empty, and there a new segment begins. What a segment misses is stored as a small residual, so that a cut is a
prediction by rank and an exact correction, whatever the rank.

The hash of seed and id draws two ranks, which part prefix, middle and suffix, and the form: `psm` and `spm` put marks
before the parts, `plain` leaves the text alone, as it does where a text is empty or already holds a mark. So a row's
result depends on its id and text alone, and the marks occur once each in the output; `restored` finds them again.

Null texts count as empty, a null id as one without digits. Every row gives one row, repeated rows included; other
columns are not carried. A batch is worked through in slices of a few megabytes, or one text where that is longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, parts, text_column

#: Largest distance, in code points, between a segment and the offsets it stands for.
ERROR = 128
MARKS = ("<P>", "<S>", "<M>")
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True


class RankIndex:
    """Rising offsets by rank: the first rank, offset and slope of each segment, and a residual for each rank."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        starts, slopes, at = [], [], 0
        while at < len(offsets):
            end, slope = self._segment(offsets, at, error)
            starts.append(at)
            slopes.append(slope)
            at = end
        self.starts, self.slopes = np.array(starts, np.int64), np.array(slopes)
        self.firsts = offsets[self.starts]
        ranks = np.arange(len(offsets))
        self.residuals = (offsets - self._predict(ranks)).astype(np.int16 if error < 1 << 14 else np.int64)

    @staticmethod
    def _segment(offsets: np.ndarray, at: int, error: int) -> tuple[int, float]:
        """The end of the longest segment from rank `at`, and a slope within its cone."""
        low, high, end, width = 0.0, np.inf, at + 1, 256
        while end < len(offsets):
            rise, run = offsets[end : end + width] - offsets[at], np.arange(end - at, min(end + width, len(offsets)) - at)
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            bad = lows > highs
            fit = int(bad.argmax()) if bad.any() else len(run)
            if fit:
                low, high = lows[fit - 1], highs[fit - 1]
            end += fit
            if fit < len(run):
                break
            width *= 2
        return end, (low + high) / 2 if end > at + 1 else 0.0

    def _predict(self, ranks: np.ndarray) -> np.ndarray:
        which = np.searchsorted(self.starts, ranks, side="right") - 1
        return self.firsts[which] + np.rint(self.slopes[which] * (ranks - self.starts[which])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets of any ranks."""
        return self._predict(ranks) + self.residuals[ranks]


def boundaries(texts: pa.Array) -> Iterator[np.ndarray]:
    """Offsets of the token boundaries of each text, the one before its first token included."""
    plain = texts.cast(pa.large_binary())
    limits = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[limits[0] : limits[-1]]
    limits = limits - limits[0]
    space = _SPACE[data]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = ~space
    ends[1:-1] &= space[1:]  # a token ends where white space follows
    ends[limits[1:][np.diff(limits) > 0]] = True  # or the text
    ends = np.flatnonzero(ends)
    if len(ends):
        leads = np.add.reduceat((data & 0xC0) != 0x80, np.concatenate([[0], ends[:-1]]), dtype=np.int64)
    cuts = np.searchsorted(ends, limits, side="right")
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield np.concatenate([[0], np.cumsum(leads[a:b])]) if b > a else np.zeros(1, np.int64)


def _draw(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digits[k : k + 8], 16) for k in (0, 8, 16, 24))


def fill_in_middle(docs: DataFrame, rate: int = 50, suffix_first: int = 80, seed: int = 42) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars and output of every document.

    `rate` of a hundred texts are cut, and `suffix_first` of a hundred of those take the form spm, the others psm.
    """
    p, s, m = MARKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            out = []
            texts = part.column("text")
            for doc_id, text, offsets in zip(part.column("doc_id").to_pylist(), texts.to_pylist(), boundaries(texts), strict=True):
                index, n = RankIndex(offsets), len(offsets) - 1
                h1, h2, h3, h4 = _draw(doc_id, seed)
                if not n or h3 % 100 >= rate or any(mark in text for mark in MARKS):
                    out.append((doc_id, n, "plain", None, None, text))
                    continue
                a, b = index.offsets(np.sort([h1 % (n + 1), h2 % (n + 1)])).tolist()
                prefix, middle, suffix = text[:a], text[a:b], text[b:]
                if h4 % 100 < suffix_first:
                    out.append((doc_id, n, "spm", a, b - a, s + suffix + p + prefix + m + middle))
                else:
                    out.append((doc_id, n, "psm", a, b - a, p + prefix + s + suffix + m + middle))
            columns = list(zip(*out, strict=True))
            kinds = [part.schema.field("doc_id").type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select("doc_id", text_column().alias("text")).mapInArrow(run, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of, by its form and marks."""
    part = F.split(F.col(output), "|".join(MARKS), -1)
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", psm).otherwise(spm)


def digest(docs: DataFrame) -> DataFrame:
    """Sizes, form and SHA-256 of the output and of the text restored from it."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    found = fill_in_middle(docs)
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored()).alias("restored_sha256"))


SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS unit
  FROM documents),
drawn AS (
  SELECT *, len(unit) AS n, ('0x' || h[1:8])::BIGINT % (len(unit) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(unit) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM doc),
cut AS (
  SELECT *, array_to_string(unit[1:least(a, b)], '') AS p, array_to_string(unit[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(unit[greatest(a, b) + 1:n], '') AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""
