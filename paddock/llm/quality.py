"""Robust multivariate outliers among documents.

One pass over whole texts takes the counts of each document. Documents
that fail the base rules go; for the rest, a vector of transformed
statistics is compared with the robust centre and scatter of its language
and source: a minimum-covariance-determinant estimate found by
concentration steps from the deterministic start of medians and median
deviations, repeated until no group's determinant falls any more. Each
step is two grouped aggregations over all rows (the distance quantile, then
the moments of the rows within it), so a group of any size is estimated
without gathering it; groups with too few rows use the estimate of their
language, or of the whole corpus.

Null text has no words and fails; null language or source is a group of
its own; repeated rows are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, mix, prefix_hash, shingles, ship, span_hash, stored, text_chunks, text_table

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
PUNCT = np.zeros(256, bool)
PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True

#: least standard deviation of each transformed statistic, where the
#: estimated one is smaller: it keeps constant statistics from rejecting
FLOORS = {"length": 1.0, "word_size": 0.08, "symbols": 0.06, "dup_lines": 0.15, "repeats": 0.12, "upper": 0.08, "punctuation": 0.06}
DIMS = len(FLOORS)
STATS = [f"x{k}" for k in range(DIMS)]
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def row_sums(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=c[1:])
    return c[off[1:]] - c[off[:-1]]


def document_counts(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every row of a chunk."""
    n = len(off) - 1
    w = Words(buf, off)
    letters = (buf & 0xC0) != 0x80
    out = {
        "n_words": w.counts(),
        "word_chars": row_sums(letters & ~_space(buf), off),
        "n_symbols": row_sums(SYMBOLS[buf], off),
        "n_upper": row_sums(UPPER[buf], off),
        "n_punct": row_sums(PUNCT[buf], off),
    }
    # words inside a 3-word window that the row has twice or more
    covered = np.zeros(len(w.h), bool)
    if len(w.h) >= 3:
        key = shingles(w.h, 3)
        ok = w.row[2:] == w.row[:-2]
        at = np.flatnonzero(ok)
        key = mix(key[at] + w.row[at].astype(np.uint64))
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        hit = at[count[inverse] > 1]
        for k in range(3):
            covered[hit + k] = True
    out["n_repeat_words"] = np.bincount(w.row[covered], minlength=n)
    # lines with a word that equal an earlier line of the row
    breaks = np.flatnonzero(buf == 10)
    starts = np.sort(np.concatenate([off[:-1], breaks + 1]))
    row = np.searchsorted(off, starts, "right") - 1
    inside = (row < n) & (starts < off[np.minimum(row, n - 1) + 1]) if n else np.zeros(0, bool)
    starts, row = starts[inside], row[inside]
    # an empty row shares its start with the next one: one line each suffices, as lines without words do not count
    starts, first = np.unique(starts, return_index=True)
    row = row[first]
    following = np.concatenate([breaks, [len(buf)]])
    ends = np.minimum(following[np.searchsorted(following, starts)], off[row + 1])
    full = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends, row = starts[full], ends[full], row[full]
    key = mix(span_hash(prefix_hash(buf), starts, ends) + row.astype(np.uint64))
    _, first = np.unique(key, return_index=True)
    lines = np.bincount(row, minlength=n)
    out["n_lines"] = lines
    out["n_dup_lines"] = lines - np.bincount(row[first], minlength=n)
    return out


def _space(buf: np.ndarray) -> np.ndarray:
    from .common import SPACE

    return SPACE[buf]


def statistics(c: dict[str, np.ndarray]) -> list[np.ndarray]:
    """The transformed statistics, in the order of FLOORS: logarithms of
    sizes, square roots of shares."""
    words = np.maximum(c["n_words"], 1)
    chars = np.maximum(c["word_chars"], 1)
    return [
        np.log(words),
        np.log(chars / words),
        np.sqrt(c["n_symbols"] / chars),
        np.sqrt(c["n_dup_lines"] / np.maximum(c["n_lines"], 1)),
        np.sqrt(c["n_repeat_words"] / words),
        np.sqrt(c["n_upper"] / chars),
        np.sqrt(c["n_punct"] / chars),
    ]


MEASURED = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{x} double" for x in STATS)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, buf, off in text_chunks(batch):
            c = document_counts(buf, off)
            keep = [batch.column(k)[rows] for k in ("doc_id", "lang", "source")]
            yield pa.RecordBatch.from_arrays(
                [*keep, *(pa.array(c[k].astype(np.int64)) for k in COUNTS), *(pa.array(x) for x in statistics(c))],
                names=["doc_id", "lang", "source", *COUNTS, *STATS],
            )


def measure(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    flat = text_table(docs, F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    return flat.mapInArrow(_measure, MEASURED)


def _distance() -> Column:
    """Squared Mahalanobis distance to the group's centre m0.. under the inverse scatter p_i_j."""
    d = [F.col(x) - F.col(f"m{k}") for k, x in enumerate(STATS)]
    terms = [d[i] * d[j] * F.col(f"p_{i}_{j}") * (1 if i == j else 2) for i, j in _pairs()]
    return sum(terms[1:], terms[0])


def _pairs() -> list[tuple[int, int]]:
    return list(itertools.combinations_with_replacement(range(DIMS), 2))


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Moments of each group -> centre, inverse scatter and the log of the
    scatter's determinant. In units of the floors, a direction whose variance
    is below 1 gets 1; the others keep theirs."""
    least = np.array(list(FLOORS.values()))
    units = np.outer(least, least)
    for b in batches:
        n = b.column("n").to_numpy()
        mean = np.stack([b.column(f"s{k}").to_numpy() for k in range(DIMS)], 1) / n[:, None]
        cov = np.zeros((len(n), DIMS, DIMS))
        for i, j in _pairs():
            cov[:, i, j] = cov[:, j, i] = b.column(f"q_{i}_{j}").to_numpy() / n - mean[:, i] * mean[:, j]
        variance, axes = np.linalg.eigh(cov * CONSISTENCY / units)
        variance = np.maximum(variance, 1.0)
        inverse = (axes / variance[:, None, :]) @ axes.transpose(0, 2, 1) / units
        arrays = [b.column("g"), pa.array(np.log(variance).sum(1)), *(pa.array(mean[:, k]) for k in range(DIMS)), *(pa.array(inverse[:, i, j]) for i, j in _pairs())]
        yield pa.RecordBatch.from_arrays(arrays, names=["g", "ld", *(f"m{k}" for k in range(DIMS)), *(f"p_{i}_{j}" for i, j in _pairs())])


SOLVED = "g string, ld double, " + ", ".join(f"m{k} double" for k in range(DIMS)) + ", " + ", ".join(f"p_{i}_{j} double" for i, j in _pairs())


def _group(*cols: Column) -> Column:
    return F.concat_ws("\x1f", *(F.coalesce(c, F.lit("\x1e")) for c in cols))


#: rows that the scatter is taken from
SHARE = 0.75
#: what makes the scatter of that share of a normal cloud the whole cloud's: share / P(chi-square of DIMS + 2 <= q),
#: q being the quantile of that share of a chi-square of DIMS (9.037)
CONSISTENCY = 1.3248
#: a determinant's logarithm that falls by less has stopped
STILL = 1e-4


def fit(measured: DataFrame, min_rows: int = 200) -> tuple[DataFrame, DataFrame]:
    """(groups g of language and source with the key of the estimate they
    use, estimates by that key)."""
    rows = measured.withColumn("g", _group(F.col("lang"), F.col("source"))).withColumn("l", _group(F.col("lang")))
    sizes = rows.groupBy("g", "l").agg(F.count("*").alias("n"))
    langs = sizes.groupBy("l").agg(F.sum("n").alias("nl"))
    finest = F.when(F.col("n") >= min_rows, F.col("g")).when(F.col("nl") >= min_rows, F.col("l")).otherwise(F.lit("\x1d"))
    uses = stored(sizes.join(langs, "l").select("g", finest.alias("key")), "mcd-groups")
    needed = uses.select("key").distinct()
    levels = rows.select(F.explode(F.array("g", "l", F.lit("\x1d"))).alias("key"), *STATS).join(needed, "key", "left_semi").withColumnRenamed("key", "g")
    quant = lambda c, q: F.percentile_approx(c, q, F.lit(2000))
    centre = stored(levels.groupBy("g").agg(*(quant(x, 0.5).alias(f"m{k}") for k, x in enumerate(STATS))), "mcd-centre")
    spread = levels.join(centre, "g").groupBy("g").agg(*(quant(F.abs(F.col(x) - F.col(f"m{k}")), 0.5).alias(f"d{k}") for k, x in enumerate(STATS)))
    least = list(FLOORS.values())
    inverse = [(F.lit(1.0) / (F.greatest(F.pow(F.col(f"d{i}") * 1.4826, 2), F.lit(least[i] ** 2))) if i == j else F.lit(0.0)).alias(f"p_{i}_{j}") for i, j in _pairs()]
    estimate = stored(centre.join(spread, "g").select("g", F.lit(float("inf")).alias("best"), *(f"m{k}" for k in range(DIMS)), *inverse), "mcd-start")
    step, fallen = 0, float("inf")
    while fallen > STILL:
        near = levels.join(estimate, "g").withColumn("d2", _distance())
        cut = stored(near.groupBy("g").agg(quant("d2", SHARE).alias("cut")), f"mcd-cut-{step}")
        core = near.join(cut, "g").where("d2 <= cut")
        sums = [F.sum(x).alias(f"s{k}") for k, x in enumerate(STATS)] + [F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"q_{i}_{j}") for i, j in _pairs()]
        solved = core.groupBy("g").agg(F.count("*").alias("n"), *sums).mapInArrow(_solve, SOLVED)
        following = solved.join(estimate.select("g", F.col("best").alias("before")), "g")
        estimate = stored(following.withColumn("best", F.least("ld", "before")).withColumn("fallen", F.col("before") - F.col("ld")), f"mcd-{step}")
        # against the least so far, which is bounded below: an approximate quantile can't make it go round
        fallen = estimate.agg(F.max("fallen")).first()[0] or 0.0
        step += 1
    return uses, estimate.drop("ld", "best", "before", "fallen")


#: squared distance that one in a thousand rows of a normal cloud exceeds: the 0.999 quantile of a chi-square of DIMS = 7
CUTOFF = 24.322


def judge(docs: DataFrame, cutoff: float = CUTOFF, min_rows: int = 200) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, distance (null where base_failed), kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    table = stored(measure(docs).withColumn("base_failed", failed), "quality")
    uses, estimate = fit(table.where("NOT base_failed"), min_rows=min_rows)
    found = uses.join(estimate.withColumnRenamed("g", "key"), "key").drop("key")
    joined = table.withColumn("g", F.when(~F.col("base_failed"), _group(F.col("lang"), F.col("source")))).join(found, "g", "left")
    scored = joined.withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff)
    return scored.select("doc_id", *COUNTS, "base_failed", "distance", kept.alias("kept"))
