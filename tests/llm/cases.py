"""Small tables with the awkward cases: nulls, empty and very long texts,
ties, repeated rows, shared ids, and extra columns with clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k long, vertex string, words string, tag string"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeéx") for _ in range(rng.randint(2, 6))) for _ in range(n))


def texts(seed: int = 7) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    base = sentence(rng, 90).split(" ")
    rows: list[tuple[int | None, str | None]] = []
    for i in range(20):  # near copies of one text
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "changed" + str(rng.randint(0, 5))
        rows.append((i, " ".join(w)))
    for i in range(20, 32):  # a passage that many share, at different places
        rows.append((i, sentence(rng, rng.randint(0, 40)) + "\n" + passage + " \n" + sentence(rng, rng.randint(0, 40))))
    long = sentence(rng, 9000)
    rows += [
        (40, None), (41, ""), (42, " \n\t "), (43, "one"), (44, "two words"), (45, long), (46, long),
        (47, "same " * 300), (48, "a" * 5000), (49, "b" * 99), (50, "Shared ID one " + passage[:50]), (50, "another text under the id " * 4),
        (51, "repeated row " + passage), (51, "repeated row " + passage), (None, "no id " + passage), (None, None),
        (52, "ÀÉ mixed CASE words\x00with\x0bodd\x0cblanks" + "\r\n" + passage.upper()),
    ]
    return rows


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, "en" if (i or 0) % 2 else None, f"src{(i or 0) % 3}", len(t or ""), 1, "v", "w", "t") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
