"""SimHash near duplicates by an inverted index of positional bytes.

A fingerprint of 64 bits is 8 positional bytes (place and value). Two that
differ in at most ``bits`` bits differ in at most as many bytes, so they share
8 - ``bits`` positional bytes at least: the minimum that the count filter asks
for. Distinct fingerprints are posted, pairs in a posting have their shared
positional bytes tallied, pairs that reach the minimum stay, and their bits
are compared.

A posting of one positional byte would hold a 256th of all fingerprints, so
postings are of several: the bytes of a fingerprint are ordered from the rarest
of the corpus to the most frequent, and a pair that shares m of 8 has its
``depth`` rarest shared bytes among the first 8 - m + ``depth`` of both. Each
fingerprint is posted under every choice of ``depth`` of those. A posting of
more than ``TALLY`` fingerprints isn't tallied pair by pair: its members are
posted again under m shared bytes, which complete the tally; such a posting
has at most 256 ** (8 - m) members whatever the corpus, and partners are
looked up in it by each pattern of differing bits.

Postings give spanning edges, not pairs. Equal fingerprints are one vertex.

Null and empty texts, and those without words, have the fingerprint zero and
link like others; repeated rows get a row each; rows without an id take part,
and a component of such rows only has no id; an empty table gives no rows.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import FOLD, SPACE, Words, ship, stored, text_chunks, text_table
from .graph import components, components_of

#: the seed of the shingle hash
SEED = 42
#: positional bytes that a first posting has in common
DEPTH = 4
#: fingerprints of a posting whose pairs are tallied one by one
TALLY = 512
#: shingles hashed at a time
SLICE = 1 << 16


def spaced(w: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a chunk, folded, with one space between those of a row;
    where each begins and ends in it."""
    keep = ~SPACE[w.buf]
    later = np.ones(len(w.starts), bool)
    later[w.first[:-1][w.first[:-1] < len(later)]] = False
    gaps = w.starts[later] - 1
    keep[gaps] = True
    flat = w.buf.copy()
    flat[gaps] = 32
    place = np.cumsum(keep) - 1
    return flat[keep].tobytes(), place[w.starts], place[w.ends - 1] + 1


def fingerprints(buf: np.ndarray, off: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of each text: a bit is set where over half of its shingles' hashes have it."""
    w = Words(FOLD[buf], off)
    flat, begins, ends = spaced(w)
    words = w.counts()
    i = np.arange(len(w.starts))
    last = w.first[1:][w.row] if len(i) else i
    head = np.flatnonzero((i + size <= last) | ((i == w.first[:-1][w.row]) & (words[w.row] < size))) if len(i) else i
    row = w.row[head]
    a, b = begins[head], ends[np.minimum(head + size, last[head]) - 1]
    votes = np.zeros((len(words), 64), np.int64)
    for s in range(0, len(head), SLICE):
        some = slice(s, s + SLICE)
        spans = zip(a[some].tolist(), b[some].tolist(), strict=True)
        h = np.fromiter((xxh64_intdigest(flat[x:y], SEED) for x, y in spans), "<u8", len(row[some]))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        edge = np.flatnonzero(np.diff(row[some], prepend=-1))
        votes[row[some][edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int64)
    total = np.bincount(row, minlength=len(words))
    return np.packbits(2 * votes > total[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, buf, off in text_chunks(batch):
            f = fingerprints(buf, off, size)
            yield pa.RecordBatch.from_arrays([batch.column(0)[rows], pa.array(f.view(np.int64))], names=["doc_id", "fp"])


def _bytes(fp: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(fp.astype("<i8")).view(np.uint8).reshape(-1, 8)


def _tokens(fp: np.ndarray) -> np.ndarray:
    """The 8 positional bytes of each fingerprint as numbers below 2,048."""
    return _bytes(fp).astype(np.int64) + 256 * np.arange(8)


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(2048, np.int64)
    for batch in batches:
        n += np.bincount(_tokens(batch.column(0).to_numpy()).ravel(), minlength=2048)
    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n)), pa.array(n[n > 0])], names=["token", "n"])


def _key(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """One number for the positional bytes at ``places`` (six at most)."""
    places = np.sort(places, axis=1)
    key = (1 << places).sum(1)
    for v in np.take_along_axis(values, places, 1).T:
        key = key << 8 | v
    return key


def _post(batches: Iterator[pa.RecordBatch], rank: np.ndarray, shared: int, depth: int) -> Iterator[pa.RecordBatch]:
    """fp -> (key, fp) for each choice of ``depth`` among its 8 - shared + depth rarest bytes."""
    for batch in batches:
        fp = batch.column(0).to_numpy()
        values = _bytes(fp).astype(np.int64)
        order = np.argsort(rank[_tokens(fp)], axis=1)
        keys = [_key(values, order[:, list(c)]) for c in combinations(range(8 - shared + depth), depth)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.tile(fp, len(keys)))], names=["key", "fp"])


def _deepen(batches: Iterator[pa.RecordBatch], rank: np.ndarray, shared: int, depth: int) -> Iterator[pa.RecordBatch]:
    """(key, fp) -> (key of ``shared`` bytes, fp): the key's bytes and each
    choice of the missing ones among the bytes that are more frequent."""
    for batch in batches:
        key, fp = (batch.column(c).to_numpy() for c in ("key", "fp"))
        values = _bytes(fp).astype(np.int64)
        order = np.argsort(rank[_tokens(fp)], axis=1)
        held = (key >> 8 * depth)[:, None] >> order & 1  # by rarity: in the key?
        last = 7 - np.argmax(held[:, ::-1], axis=1)
        inside = np.argsort(1 - held, axis=1, kind="stable")[:, :depth]
        keys, owners = [], []
        for c in combinations(range(8), shared - depth):
            ok = last < c[0]
            at = np.concatenate([inside[ok], np.tile(np.array(c), (int(ok.sum()), 1))], 1)
            keys.append(_key(values[ok], np.take_along_axis(order[ok], at, 1)))
            owners.append(fp[ok])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(owners))], names=["key", "fp"])


def tallied(key: np.ndarray, fp: np.ndarray, shared: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one posting (rows sorted by key) that share enough positional
    bytes and differ in few enough bits."""
    found = []
    at = np.arange(len(key))
    for k in range(1, len(key)):
        at = at[at + k < len(key)]
        at = at[key[at] == key[at + k]]
        if not len(at):
            break
        apart = fp[at] ^ fp[at + k]
        tally = (_bytes(apart) == 0).sum(1)
        ok = tally >= shared
        ok[ok] = np.bitwise_count(apart[ok].view(np.uint64)) <= bits
        found.append(np.stack([at[ok], at[ok] + k]))
    got = np.concatenate(found, 1) if found else np.zeros((2, 0), np.int64)
    return got[0], got[1]


def looked_up(fp: np.ndarray, free: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Such pairs of a posting whose members agree but for the bits ``free``,
    by each pattern of differing bits."""
    single = [1 << k for k in range(64) if free >> k & 1]
    order = np.argsort(fp, kind="stable")
    known = fp[order]
    found = []
    for n in range(1, bits + 1):
        for c in combinations(single, n):
            pattern = np.array([sum(c)], np.uint64).view(np.int64)[0]
            aim = fp ^ pattern
            at = np.minimum(np.searchsorted(known, aim), len(fp) - 1)
            ok = np.flatnonzero((known[at] == aim) & (fp < aim))
            found.append(np.stack([ok, order[at[ok]]]))
    a, b = np.concatenate(found, 1)
    return a, b


def _edges(key: np.ndarray, fp: np.ndarray, shared: int, bits: int) -> pa.RecordBatch:
    """Spanning edges of the links inside each of the postings (sorted by key)."""
    starts = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
    sizes = np.diff(np.append(starts, len(key)))
    size = np.repeat(sizes, sizes)
    small = np.flatnonzero((size > 1) & (size <= TALLY))
    a, b = tallied(key[small], fp[small], shared, bits)
    pairs = [np.stack([small[a], small[b]])]
    for s, n in zip(starts[sizes > TALLY].tolist(), sizes[sizes > TALLY].tolist(), strict=True):
        mask = int(key[s]) >> 8 * shared  # only postings of ``shared`` bytes are that large
        free = sum(255 << 8 * p for p in range(8) if not mask >> p & 1)
        a, b = looked_up(fp[s : s + n], free, bits)
        pairs.append(np.stack([a + s, b + s]))
    a, b = np.concatenate(pairs, 1)
    names, idx = np.unique(fp, return_inverse=True)
    label = components_of(len(names), idx[a], idx[b])
    own = np.flatnonzero(label != np.arange(len(names)))
    return pa.RecordBatch.from_arrays([pa.array(names[own]), pa.array(names[label[own]])], names=["a", "b"])


def _match(batches: Iterator[pa.RecordBatch], shared: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Postings sorted by key -> spanning edges; a posting may span batches."""
    key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        key = np.concatenate([key, batch.column("key").to_numpy()])
        fp = np.concatenate([fp, batch.column("fp").to_numpy()])
        whole = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last posting may go on
        if whole:
            yield _edges(key[:whole], fp[:whole], shared, bits)
            key, fp = key[whole:], fp[whole:]
    if len(key):
        yield _edges(key, fp, shared, bits)


def links(vertices: DataFrame, bits: int = 2, depth: int = DEPTH) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components
    are those of all links of at most ``bits`` differing bits (1 or 2)."""
    ship(vertices.sparkSession)
    shared = 8 - bits
    fps = vertices.select("fp")
    counts = fps.mapInArrow(_count_tokens, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()  # 2,048 rows at most
    n = np.zeros(2048, np.int64)
    for r in counts:
        n[r.token] = r.n
    rank = np.argsort(np.argsort(n, kind="stable"), kind="stable")
    postings = fps.mapInArrow(lambda it: _post(it, rank, shared, depth), "key long, fp long")
    heavy = stored(postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > TALLY).select("key"), "heavy-postings")
    light = postings.join(heavy.hint("merge"), "key", "left_anti")
    deep = postings.join(heavy.hint("merge"), "key", "left_semi").mapInArrow(lambda it: _deepen(it, rank, shared, depth), "key long, fp long").distinct()

    def edges(p: DataFrame) -> DataFrame:
        return p.repartition("key").sortWithinPartitions("key").mapInArrow(lambda it: _match(it, shared, bits), "a long, b long")

    return edges(light).unionByName(edges(deep))


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest
    doc_id that links of at most ``bits`` differing bits reach, of every row."""
    ship(docs.sparkSession)
    known = stored(text_table(docs).mapInArrow(lambda it: _fingerprints(it, words), "doc_id long, fp long"), "fingerprints")
    vertices = stored(known.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = components(links(vertices, bits)).withColumnRenamed("vertex", "fp")
    placed = vertices.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(placed.join(ids, "component").select("fp", "component_id"), "fingerprint-names")
    return known.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
