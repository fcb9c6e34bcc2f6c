"""Small tables with every odd case: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

import random

WORDS = "the of and to in that was for on with der die und das ist von la de que el los las une est dans pour".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "er", "ing", ",", "."]) for _ in range(n))


def junk(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS).upper() + rng.choice(["!!", "***", "$$$"]) for _ in range(n))


LONG = prose(99, 30_000)


def rows() -> list[tuple]:
    out = [(i, prose(i, 60 + i % 50), "en" if i % 3 else "de", f"src{i % 3}", 100) for i in range(40)]
    out += [(100 + i, prose(i, 60 + i % 50) + (" more" if i % 2 else ""), "en", "src0", 100) for i in range(6)]
    out += [(200, None, "en", "src0", None), (201, "", None, "src1", 0), (202, "   \n\t ", "en", None, 6), (203, "one two", "fr", "src1", 7)]
    out += [(204, "Été 日本 😀\x00 ▁ a  b", None, None, None), (205, LONG, "en", "src2", len(LONG)), (206, "12 34 !!", "en", "src2", 8)]
    out += [(None, prose(1, 61), "en", "src0", 10), (None, None, None, None, None), (3, prose(3, 63), "en", "src0", 100), (3, prose(3, 63), "en", "src0", 100)]
    return out


COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = "score, node, n, label, times, row, train, h, word, key, _site, page, component, decoded, hash, shingle".split(", ")


def documents(spark, found: list[tuple] | None = None, extra: bool = False):
    df = spark.createDataFrame(rows() if found is None else found, COLUMNS)
    for name in EXTRA if extra else []:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def collected(df) -> list[tuple]:
    """Rows in order; floats to nine places, since sums run in the order of the partitions."""
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)
