"""Repeated word passages by difference-cover anchors.

Positions whose residue modulo ``PERIOD`` is in a difference cover are
anchors: for any two places of a repeated window there is one offset below
the period at which both are anchors. So only those hash the words after
them; anchors with equal hashes are extended on both sides, and a window is
repeated if its whole extension is found elsewhere, in any document. All
words of repeated windows go, the first occurrence's too.

Null text has no words; rows that share an id but not a text are documents
of their own, equal rows are one (their passages don't repeat each other);
null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, _powers, mix, shingles, ship, signed, stored
from .common import _R as RADIX
from .common import _R_INV as RADIX_INV
from . import repeats
from .repeats import NULL_DOC, Anchors

#: fixed values: a perfect difference cover (every residue is a difference of two)
PERIOD = 21
COVER = (3, 6, 7, 12, 14)


def sequence_prefix(h: np.ndarray) -> np.ndarray:
    x = h * _powers(len(h), RADIX)
    out = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(x, out=out[1:])
    return out


def sequence_hash(prefix: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    h = (prefix[e] - prefix[s]) * _powers(len(prefix), RADIX_INV)[s]
    return mix(h + (e - s).astype(np.uint64) * np.uint64(RADIX))


def find(window: int):
    """Anchors of a chunk for windows of so many words."""
    size = window - PERIOD + 1  # words that every window has after an anchor in its first PERIOD places
    back = window - size

    def run(buf: np.ndarray, off: np.ndarray) -> Anchors:
        w = Words(buf, off)
        first, last = w.first[w.row], w.first[w.row + 1]
        i = np.arange(len(w.h))
        at = i[np.isin((i - first) % PERIOD, COVER) & (i + size <= last) & (last - first >= window)]
        group = shingles(w.h, size)[at] if len(at) else np.zeros(0, np.uint64)
        left = np.minimum(at - first[at], back)
        right = np.minimum(last[at] - at, window)
        keep = left + right >= window
        at, group, left, right = at[keep], group[keep], left[keep], right[keep]
        context = mix(sequence_hash(sequence_prefix(w.h), at - left, at + right) + left.astype(np.uint64) * np.uint64(window + 1) + right.astype(np.uint64))
        return w.row[at], at - first[at], group, context, left, right

    return run


def _edge_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Every window at an edge anchor: hash and place; equal ones of a batch
    as one row with both ends of their places."""
    back = PERIOD - 1
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size, last = 0, None
    for doc, tag, at, _, text in repeats.marked_texts(batches):
        if not len(at) or (doc, tag) == last:  # nothing at an edge, or a repeated row
            continue
        last = (doc, tag)
        w = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        starts = np.unique((at[:, None] - np.arange(back + 1)[None]).ravel())
        starts = starts[(starts >= 0) & (starts + window <= len(w.h))]
        h = signed(sequence_hash(sequence_prefix(w.h), starts, starts + window))
        held.append((h, np.full(len(h), doc), tag + starts))
        size += len(h)
        if size >= 500_000:
            yield _window_rows(held)
            held, size = [], 0
    if held:
        yield _window_rows(held)


def _window_rows(held) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=["hash", "doc", "place"])


def _finish(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Documents with marks (place; stop 0: the whole context of an anchor)."""
    back = PERIOD - 1
    out: list[tuple] = []
    for doc, _, starts, stops, text in repeats.marked_texts(batches):
        w = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        n = len(w.h)
        whole = stops == 0
        s = np.where(whole, np.maximum(starts - back, 0), starts)
        e = np.where(whole, np.minimum(starts + window, n), stops)
        gone = repeats.covered(n, s, e)
        kept = np.flatnonzero(~gone)
        body = b" ".join([text[a:b] for a, b in zip(w.starts[kept].tolist(), w.ends[kept].tolist(), strict=True)])
        out.append((None if doc == NULL_DOC else doc, n, int(gone.sum()), hashlib.sha256(body).hexdigest(), body.decode()))
        if len(out) >= 500:
            yield _result(out)
            out = []
    if out:
        yield _result(out)


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _result(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept words."""
    ship(docs.sparkSession)
    text, names = repeats.own_ids(docs)
    back = PERIOD - 1
    rows = text.mapInArrow(lambda it: repeats.anchor_rows(it, find(window), False), repeats.ROWS)
    rows = rows.repartition("group").sortWithinPartitions("group", "context", "doc", "place")
    spans = stored(rows.mapInArrow(lambda it: repeats.settle(it, (back, window), False), repeats.SPANS), "anchors")
    edges = spans.where(F.col("kind") == repeats.EDGE)
    windows = stored(repeats.with_texts(text, edges).mapInArrow(lambda it: _edge_windows(it, window), "hash long, doc long, place long"), "edge-windows")
    ends = windows.groupBy("hash").agg(F.min(F.struct("doc", "place")).alias("a"), F.max(F.struct("doc", "place")).alias("b")).where("a <> b").select("hash")
    again = windows.join(ends, "hash", "left_semi").select("doc", "place", (F.col("place") + window).alias("stop"))
    marks = spans.where(F.col("kind") == repeats.COVER).select("doc", "place", "stop").unionByName(again)
    return repeats.named(repeats.with_texts(text, marks).mapInArrow(lambda it: _finish(it, window), RESULT), names)
