"""Shared first and last steps of the two repeated-passage operators.

A document is a sequence of units (bytes or words). Anchors are units that
equal windows are sure to share; an anchor's context is all that any window
holding it can reach. Anchors are grouped by the hash of what follows
them; equal contexts settle every window at an anchor at once, and only
contexts that agree in part (the edges of repeats) need a closer look.

Within a batch, equal contexts are settled before the shuffle, so a passage
that a third of all documents share costs one row for each batch.

Documents are known by their id. Where ids are null or shared, ``own_ids``
numbers the distinct texts under each id (null: the least) and works on the
numbers, so rows that share an id but not a text are documents of their own,
and equal rows are one document.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import sequence_numbers
from .common import mix, signed, stored, text_chunks, text_table

NULL_DOC = -(1 << 63)
PLACE_BITS = 40
ANCHOR, COVER, EDGE = 0, 1, 2

ROWS = "group long, context long, doc long, place long, kind byte"
SPANS = "doc long, place long, stop long, kind byte"


def tag_of(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The packed upper part of each row's places."""
    raw = memoryview(np.ascontiguousarray(buf))
    tags = [zlib.crc32(raw[s:e]) & 0xFFFFF for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
    return np.array(tags, np.int64) << PLACE_BITS


def docs_of(column: pa.Array) -> np.ndarray:
    return column.fill_null(NULL_DOC).to_numpy(zero_copy_only=False)


def own_ids(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """doc_id and text of every row, and None; or, where an id is null or
    stands on several rows, numbers that ascend as the ids do in place of
    doc_id, and the names (own, doc_id) of the numbers. Texts under one id are
    told apart by a 64-bit hash and their length."""
    text = text_table(docs)
    if text.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").isEmpty():
        return text, None
    keys = {"h": F.xxhash64("text"), "size": F.coalesce(F.length("text"), F.lit(-1))}
    known = text.select("doc_id", *(c.alias(k) for k, c in keys.items())).distinct().withColumn("all", F.lit(""))
    names = stored(sequence_numbers(known, "all", ["doc_id", "h", "size"]).select(F.col("doc_id").alias("id"), F.col("h").alias("hash"), F.col("size").alias("length"), F.col("seq").alias("own")), "own-ids")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hash")) & (F.col("size") == F.col("length"))
    rows = text.withColumns(keys).join(names.hint("merge"), same)
    return stored(rows.select(F.col("own").alias("doc_id"), "text"), "own-texts"), names.select("own", F.col("id").alias("doc_id"))


def named(result: DataFrame, names: DataFrame | None) -> DataFrame:
    """The rows of a result under their documents' ids again."""
    if names is None:
        return result
    return result.withColumnRenamed("doc_id", "own").join(names.hint("merge"), "own").select(*result.columns)


Anchors = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # row, position, group, context, left, right


def merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals by document."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    low = np.int64((1 << PLACE_BITS) - 1)
    tag = start & ~low
    fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])
    # running maximum of stops within a document: each is lifted above the one before
    base = np.cumsum(fresh) * (1 << PLACE_BITS + 1)
    high = np.maximum.accumulate(base + (stop & low))
    begin = fresh.copy()
    begin[1:] |= (start[1:] & low) + base[1:] > high[:-1]
    at = np.flatnonzero(begin)
    last = np.concatenate([at[1:], [len(doc)]]) - 1
    return doc[at], start[at], tag[at] + (high[last] - base[last])


def anchor_rows(batches: Iterator[pa.RecordBatch], find: Callable[[np.ndarray, np.ndarray], Anchors], keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Rows of ROWS: an ANCHOR for each distinct context of the batch, and
    COVER spans (context: stop) for what equal contexts settle at once: all
    but the first occurrence, or all if not ``keep_first``."""
    for batch in batches:
        parts: list[tuple[np.ndarray, ...]] = []
        for rows, buf, off in text_chunks(batch):
            row, at, group, context, left, right = find(buf, off)
            doc, tag = docs_of(batch.column(0)[rows]), tag_of(buf, off)
            parts.append((group, context, doc[row], tag[row] + at, left, right))
        if not parts:
            continue
        group, context, doc, place, left, right = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((place, doc, context, group))
        group, context, doc, place, left, right = (c[order] for c in (group, context, doc, place, left, right))
        if not len(group):
            continue
        again = np.zeros(len(group), bool)
        again[1:] = (group[1:] == group[:-1]) & (context[1:] == context[:-1])
        same = np.zeros(len(group), bool)
        same[1:] = again[1:] & (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])  # a repeated row
        settled = again & ~same
        if not keep_first:
            run = np.cumsum(~again) - 1
            many = np.bincount(run[settled], minlength=run[-1] + 1) > 0
            settled = many[run] & ~same
        d, s, e = merged(doc[settled], (place - left)[settled], (place + right)[settled])
        yield _rows(signed(mix(d.view(np.uint64) * np.uint64(5) + s.view(np.uint64))), e, d, s, COVER)
        first = ~again
        yield _rows(signed(group[first]), signed(context[first]), doc[first], place[first], ANCHOR)


def _rows(group, context, doc, place, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(c) for c in (group, context, doc, place)), pa.array(np.full(len(doc), kind, np.int8))], names=["group", "context", "doc", "place", "kind"])


def settle(batches: Iterator[pa.RecordBatch], reach: tuple[int, int], keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (group, context, doc, place) -> SPANS: COVER spans as
    they are; an anchor whose context occurred before (or again, if not
    ``keep_first``) as COVER with stop 0, meaning its whole context; the first
    anchor of each context in a group of several as EDGE. The state carried
    between batches is one anchor, whatever the size of a group."""
    held: tuple | None = None  # last first-of-context: group, context, doc, place, edge sent, cover sent, last doc, last place
    for batch in batches:
        g, c, d, p, kind = (batch.column(k).to_numpy() for k in range(5))
        passed = kind == COVER
        if passed.any():
            yield _spans(d[passed], p[passed], c[passed], COVER)
            g, c, d, p = (x[~passed] for x in (g, c, d, p))
        if not len(g):
            continue
        edge_sent = cover_sent = False
        before = (None, None)
        if held:
            g, c, d, p = (np.concatenate([[h], x]) for h, x in zip(held[:4], (g, c, d, p), strict=True))
            edge_sent, cover_sent, before = held[4], held[5], held[6:8]
        new_group = np.concatenate([[True], g[1:] != g[:-1]])
        first = new_group.copy()
        first[1:] |= c[1:] != c[:-1]
        pd, pp = np.concatenate([[d[0]], d[:-1]]), np.concatenate([[p[0]], p[:-1]])
        if held and len(d) > 1:
            pd[1], pp[1] = before
        same = ~first & (d == pd) & (p == pp)
        dup = ~first & ~same
        reps = np.flatnonzero(first)
        # a context is an edge if another one in its group comes before or after it
        edge = ~new_group[reps]
        edge[:-1] |= g[reps[1:]] == g[reps[:-1]]
        if held and edge_sent:
            edge[0] = False if len(reps) else edge[0]
        if keep_first:
            cover = np.flatnonzero(dup)
            many = np.zeros(len(reps), bool)
        else:
            run = np.cumsum(first) - 1
            many = np.bincount(run[dup], minlength=len(reps)) > 0
            was = many.copy()
            if held and cover_sent:
                was[0] = False
            cover = np.concatenate([np.flatnonzero(dup), reps[was]])
        yield _spans(d[cover], p[cover], np.zeros(len(cover), np.int64), COVER)
        at = reps[edge]
        yield _spans(d[at], p[at], g[at], EDGE)
        k = reps[-1]
        carried = held is not None and k == 0
        held = (g[k], c[k], d[k], p[k], bool(edge[-1]) or (carried and edge_sent) or not new_group[k], bool(many[-1]) or (carried and cover_sent), d[-1], p[-1])


def _spans(doc, place, stop, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(place), pa.array(stop), pa.array(np.full(len(doc), kind, np.int8))], names=["doc", "place", "stop", "kind"])


TEXTS = "doc long, tag long, body binary"


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard as zstd

    pack = zstd.ZstdCompressor(level=1)
    for batch in batches:
        for rows, buf, off in text_chunks(batch):
            raw = memoryview(np.ascontiguousarray(buf))
            body = [pack.compress(raw[s:e]) for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(docs_of(batch.column(0)[rows])), pa.array(tag_of(buf, off)), pa.array(body, pa.binary())], names=["doc", "tag", "body"])


def with_texts(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """doc, tag, place, stop, body: the marks (doc, place, stop) of a document,
    sorted, and then its text, in one partition."""
    bodies = text_table(docs).mapInArrow(_bodies, TEXTS).select("doc", "tag", F.lit((1 << 62) - 1 + (1 << 62)).alias("place"), F.lit(0).cast("long").alias("stop"), "body")
    tagged = marks.select("doc", F.expr(f"shiftleft(shiftright(place, {PLACE_BITS}), {PLACE_BITS})").alias("tag"), "place", "stop", F.lit(None).cast("binary").alias("body"))
    both = bodies.unionByName(tagged)
    return both.repartition("doc", "tag").sortWithinPartitions("doc", "tag", "place")


def marked_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bytes]]:
    """(doc, tag, starts, stops, text) of each document of ``with_texts``;
    starts and stops without the tag."""
    import zstandard as zstd

    unpack = zstd.ZstdDecompressor()
    low = (1 << PLACE_BITS) - 1
    starts: list[np.ndarray] = []
    stops: list[np.ndarray] = []
    key = None
    for batch in batches:
        doc, tag, place, stop = (batch.column(k).to_numpy() for k in range(4))
        body = batch.column(4)
        at = 0
        for k in np.flatnonzero(body.is_valid().to_numpy(zero_copy_only=False)).tolist():
            own = (int(doc[k]), int(tag[k]))
            if own != key:
                # marks of documents that have no text row can't occur
                key, starts, stops = own, [], []
                lead = slice(at, k)
                starts.append(place[lead] & low)
                stops.append(stop[lead] & low)
            else:
                starts.append(place[at:k] & low)
                stops.append(stop[at:k] & low)
            at = k + 1
            yield own[0], own[1], np.concatenate(starts), np.concatenate(stops), unpack.decompress(body[k].as_py(), max_output_size=1 << 31)
        if at < len(doc):
            own = (int(doc[-1]), int(tag[-1]))
            if own != key:
                key, starts, stops = own, [], []
            starts.append(place[at:] & low)
            stops.append(stop[at:] & low)


def covered(n: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Mask of the units inside any [start, stop)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, np.minimum(starts, n), 1)
    np.add.at(d, np.minimum(stops, n), -1)
    return np.cumsum(d[:-1]) > 0
