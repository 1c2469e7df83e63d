"""Exact set-similarity join of word n-grams by PartEnum signatures.

The hash domain of the shingles is cut into ``n1`` parts of ``n2`` pieces.
Two sets with at most H differing elements agree, in some part, on all but
``k2`` pieces when n1 (k2 + 1) > H, so each set has one signature for each
part and each choice of n2 - k2 pieces. H follows from the larger size, so
sizes fall into bands, each with its own number of parts; a set signs for
its own band and for those its larger partners may be in.

An empty choice of pieces says nothing, so it isn't signed; bands keep
spare parts for that, and the few sets with more such parts than are spare
sign those as well, so no pair is lost.

Sets that share a signature form families; equal sets are one vertex from
the start, and within a batch a signature is sent once, so a signature that
a third of all documents share costs a row for each batch. A family is
first sieved by parity sketches (a bit for each hash value, flipped by each
element; sets differ in at least as many elements as their sketches in
bits), which are far smaller than texts, and what the sieve leaves
connected is checked exactly. Both go in pairs of bounded blocks, each of
which reports a spanning forest of its links and never the pairs.

Null and empty text have no shingles and are linked with nothing; equal
rows are one vertex; rows without an id take part and count as the largest
id; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, free_name, mix, released, shingles, ship, signed, stored, text_chunks, text_table
from .graph import components, runs, spanned

#: shingles of a block; a family of more is checked block by block
BLOCK_SHINGLES = 1_000_000
#: shingles of a block of sketches (some 0.4 bytes each)
SIEVE_SHINGLES = 20_000_000


@dataclass
class Bands:
    """The bands of a threshold: parts[j], spare[j] and the largest size top[j]."""

    percent: int
    n2: int = 1
    k2: int = 0
    parts: list[int] = field(default_factory=list)
    spare: list[int] = field(default_factory=list)
    top: list[int] = field(default_factory=list)

    def most(self, size: int) -> int:
        """Differing elements of linked sets of which the larger has so many."""
        return 2 * size * (100 - self.percent) // (100 + self.percent)

    def _grow(self, size: int) -> None:
        while not self.top or self.top[-1] < size:
            n1 = max(self.parts[-1] + 1, math.ceil(1.35 * self.parts[-1])) if self.parts else 1
            last = self.top[-1] if self.top else 0
            least = last + 1  # of two sets, the larger need not be short of parts
            chosen = (self.n2 - self.k2) / self.n2
            ways = math.comb(self.n2, self.k2)
            while True:
                empty = n1 * min(1.0, ways * math.exp(-chosen * least / n1))
                spare = min(math.ceil(empty + 3 * math.sqrt(empty)), n1 // 4)
                # sizes whose differences leave more than `spare` parts within k2 errors
                room = (n1 - spare) * (self.k2 + 1) - 1
                top = ((room + 1) * (100 + self.percent) - 1) // (2 * (100 - self.percent)) if room >= 0 else 0
                if n1 == 1:
                    top = max(top, 1)
                if top > last:
                    break
                n1 += 1
            self.parts.append(n1)
            self.spare.append(spare)
            self.top.append(top)

    def of(self, size: int) -> range:
        """Bands in which a set of this size signs."""
        self._grow(100 * size // self.percent + 1)
        first = int(np.searchsorted(self.top, size))
        last = int(np.searchsorted(self.top, 100 * size // self.percent))
        return range(first, last + 1)


def signatures(u: np.ndarray, bands: Bands) -> np.ndarray:
    """Signatures of the sorted distinct hashes ``u``; none where the bands
    have one part only, as equal sets are one vertex anyway."""
    out = []
    total = np.zeros(len(u) + 1, np.uint64)
    np.cumsum(mix(u.copy()), out=total[1:])
    for j in bands.of(len(u)):
        n1, n2, k2 = bands.parts[j], bands.n2, bands.k2
        if n1 * (k2 + 1) == 1:
            continue
        pieces = n1 * n2
        edges = (np.arange(1, pieces, dtype=np.uint64) << np.uint64(32)) // np.uint64(pieces) << np.uint64(32)
        at = np.concatenate([[0], np.searchsorted(u, edges), [len(u)]])
        sums = (total[at[1:]] - total[at[:-1]]).reshape(n1, n2)
        sizes = np.diff(at).reshape(n1, n2)
        ids = mix(np.arange(n1, dtype=np.uint64) + np.uint64(j << 40))
        choices = list(combinations(range(n2), n2 - k2))
        filled = np.stack([sizes[:, list(c)].sum(1) > 0 for c in choices], 1)
        weak = int((~filled).any(1).sum())
        for k, c in enumerate(choices):
            s = mix(sums[:, list(c)].sum(1, dtype=np.uint64) + ids + np.uint64(k + 1))
            out.append(s if weak > bands.spare[j] else s[filled[:, k]])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_sets(buf: np.ndarray, off: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    w = Words(buf, off, fold=True)
    for r in range(len(off) - 1):
        h = w.h[w.first[r] : w.first[r + 1]]
        yield np.unique(shingles(h, size) if len(h) >= size else shingles(h, max(1, len(h))))


def set_key(u: np.ndarray) -> int:
    return int(mix(np.array([np.uint64(len(u)) + mix(u.copy()).sum(dtype=np.uint64)], np.uint64)).view(np.int64)[0])


def sketch(u: np.ndarray) -> bytes:
    """Parities of the elements by the low bits of their hashes: the least
    power of two of bits (64 or more) that is twice the elements or more."""
    bits = max(64, 1 << (2 * len(u) - 1).bit_length())
    odd = np.bincount((mix(u.copy()) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sieve(n: np.ndarray, sketches: list[bytes], sides: np.ndarray, across: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs that ``sieved`` yields."""
    pairs = list(sieved(n, sketches, sides, across, percent))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *(a for a, _ in pairs)]), np.concatenate([none, *(b for _, b in pairs)])


def sieved(n: np.ndarray, sketches: list[bytes], sides: np.ndarray, across: bool, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (of different sides if ``across``) whose sizes and sketches allow
    a link, those of one set at a time. A longer sketch is folded to the
    shorter one's bits."""
    order = np.argsort(n, kind="stable")
    words = np.array([len(x) // 8 for x in sketches])
    groups = {}
    for w in np.unique(words).tolist():
        at = order[words[order] == w]
        m = np.frombuffer(b"".join([sketches[i] for i in at]), np.uint64).reshape(-1, w)
        groups[w] = (at, n[at], m, m[:, : w // 2] ^ m[:, w // 2 :] if w > 1 else None)
    for w, (at, size, m, _) in groups.items():
        for k, i in enumerate(at.tolist()):
            most = 100 * size[k] // percent
            parts = [(at, size, m, k + 1)]
            if 2 * w in groups:
                at2, size2, _, folded = groups[2 * w]
                parts.append((at2, size2, folded, 0))
            for other, sizes, bits, lo in parts:
                hi = int(np.searchsorted(sizes, most, "right"))
                if hi <= lo:
                    continue
                apart = np.bitwise_count(bits[lo:hi] ^ m[k]).sum(1, dtype=np.int64)
                j = other[lo:hi][apart * (100 + percent) <= (sizes[lo:hi] + size[k]) * (100 - percent)]
                if across:
                    j = j[sides[j] != sides[i]]
                if len(j):
                    yield np.full(len(j), i), j


def _sift(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Block pairs (family, i, j, side, vertex, n_shingles, sketch) -> spanning edges."""
    for (_, i, j), rows in runs(batches, 3):
        name, n, side = (rows.column(c).to_numpy() for c in ("vertex", "n_shingles", "side"))
        label = spanned(len(n), sieved(n, rows.column("sketch").to_pylist(), side, i != j, percent))
        own = np.flatnonzero(label != np.arange(len(n)))
        yield pa.RecordBatch.from_arrays([pa.array(name[own]), pa.array(name[label[own]])], names=["a", "b"])


def _keys(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, buf, off in text_chunks(batch):
            got = [(len(u), set_key(u) if len(u) else None, sketch(u) if len(u) else None) for u in shingle_sets(buf, off, size)]
            cols = [pa.array([g[k] for g in got], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0)[rows], batch.column(2)[rows], *cols], names=["doc_id", "row", "n_shingles", "vertex", "sketch"])


def _sign(batches: Iterator[pa.RecordBatch], size: int, bands: Bands) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: set[int] = set()
        sigs, owners = [], []
        for _, buf, off in text_chunks(batch):
            for u in shingle_sets(buf, off, size):
                if len(u) and (key := set_key(u)) not in seen:
                    seen.add(key)
                    s = signatures(u, bands)
                    sigs.append(s)
                    owners.append(np.full(len(s), key, np.int64))
        if not sigs:
            continue
        s, v = np.concatenate(sigs), np.concatenate(owners)
        order = np.argsort(s)
        s, v = s[order], v[order]
        fresh = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
        # a signature goes out once for the batch; its other owners are tied to the first
        first = v[fresh][np.cumsum(fresh) - 1]
        tie = ~fresh & (v != first)
        ties = np.unique(np.stack([v[tie], first[tie]], 1), axis=0)
        own = mix(ties[:, 0].view(np.uint64) * np.uint64(3) + ties[:, 1].view(np.uint64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([signed(s[fresh]), signed(own), signed(own)])), pa.array(np.concatenate([v[fresh], ties[:, 0], ties[:, 1]]))], names=["sig", "vertex"]
        )


def _pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (sig, vertex) -> (vertex, first vertex of the signature)."""
    last, hub = None, None
    for batch in batches:
        s, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(s):
            continue
        fresh = np.concatenate([[s[0] != last], s[1:] != s[:-1]])
        heads = np.where(fresh, v, 0)
        run = np.cumsum(fresh)
        firsts = np.concatenate([[hub if hub is not None else 0], heads[fresh]])
        h = firsts[run]
        last, hub = s[-1], h[-1]
        keep = v != h
        pair = np.unique(np.stack([np.maximum(v, h)[keep], np.minimum(v, h)[keep]], 1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common elements of each left and right set. Elements of few sets are
    counted pair by pair, those of many by a matrix product."""
    n = np.array([len(x) for x in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    _, element = np.unique(flat, return_inverse=True)
    is_left, is_right = np.zeros(len(sets), bool), np.zeros(len(sets), bool)
    is_left[left], is_right[right] = True, True
    nl = np.bincount(element, is_left[owner])
    nr = np.bincount(element, is_right[owner])
    row, col = np.zeros(len(sets), int), np.zeros(len(sets), int)
    row[left], col[right] = np.arange(len(left)), np.arange(len(right))
    out = np.zeros(len(left) * len(right), np.int64)
    pairs = nl * nr
    few = (pairs > 0) & (pairs <= 256)
    order = np.argsort(element, kind="stable")
    begin = np.concatenate([[0], np.cumsum(np.bincount(element, minlength=len(nl)))])
    at = np.flatnonzero(few[element[order]])
    o, el = owner[order][at], element[order][at]
    lo, le = row[o[is_left[o]]], el[is_left[o]]
    ro, re = col[o[is_right[o]]], el[is_right[o]]
    if len(le) and len(re):
        rb = np.searchsorted(re, le)
        cnt = np.searchsorted(re, le, "right") - rb
        upto = np.concatenate([[0], np.cumsum(cnt)])
        s = 0
        while s < len(le):  # at most some 2^20 pairs at a time
            e = max(s + 1, int(np.searchsorted(upto, upto[s] + (1 << 20), "right")) - 1)
            c = cnt[s:e]
            rep = np.repeat(lo[s:e], c)
            idx = np.repeat(rb[s:e] - (upto[s:e] - upto[s]), c) + np.arange(upto[e] - upto[s])
            np.add.at(out, rep * len(right) + ro[idx], 1)
            s = e
    out = out.reshape(len(left), len(right))
    many = np.flatnonzero(pairs > 256)
    for s in range(0, len(many), 1024):
        block = many[s : s + 1024]
        a = np.zeros((len(sets), len(block)), np.float32)
        for k, e in enumerate(block):
            a[owner[order[begin[e] : begin[e + 1]]], k] = 1
        out += np.rint(a[left] @ a[right].T).astype(np.int64)
    return out


def _links(sets: list[np.ndarray], n: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of left and right sets, those of a few left ones at a time."""
    for b in range(0, len(left), 512):
        part = left[b : b + 512]
        common = overlaps(sets, part, right)
        for s in range(0, len(part), 64):
            some, k = part[s : s + 64], common[s : s + 64]
            union = n[some][:, None] + n[right][None] - k
            x, y = np.nonzero((100 * k >= percent * union) & (some[:, None] != right[None]))
            yield some[x], right[y]


def _check(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Block pairs (family, i, j, side, vertex, text) -> spanning edges of their links."""
    for (_, i, j), rows in runs(batches, 3):
        sets, names, sides = [], [], []
        seen = set()
        side = rows.column("side").to_numpy()
        wanted = rows.column("vertex").to_numpy()
        at = 0
        for batch in rows.to_batches():
            for _, buf, off in text_chunks(batch):
                for u in shingle_sets(buf, off, size):
                    key = set_key(u)
                    if key == wanted[at] and key not in seen:  # rows that share an id may differ
                        seen.add(key)
                        sets.append(u)
                        names.append(key)
                        sides.append(side[at])
                    at += 1
        s = np.array(sides)
        left = np.flatnonzero(s == i)
        right = left if i == j else np.flatnonzero(s == j)
        if not len(left) or not len(right):
            continue
        n = np.array([len(u) for u in sets])
        label = spanned(len(sets), _links(sets, n, left, right, percent))
        own = np.flatnonzero(label != np.arange(len(sets)))
        name = np.array(names, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(name[own]), pa.array(name[label[own]])], names=["a", "b"])


def _blocks(members: DataFrame, shingles: int, *columns: str, sizes: DataFrame | None = None) -> DataFrame:
    """Members of families dealt to pairs of blocks of about so many shingles:
    family, i, j, side and ``columns``, each pair of blocks together."""
    total = (members if sizes is None else sizes).groupBy("family").agg(F.ceil(F.sum("n_shingles") / shingles).cast("int").alias("blocks"))
    side = F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int").alias("side")
    dealt = members.join(total, "family").select("family", side, "blocks", *columns)
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("family", F.least("side", "o").alias("i"), F.greatest("side", "o").alias("j"), "side", *columns)
    return dealt.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")


def row_key() -> Column:
    """Tells rows apart by id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def linked(docs: DataFrame, words: int, percent: int, n2: int, k2: int) -> DataFrame:
    """doc_id, row (its key), n_shingles, vertex and component of every row;
    the last two null without shingles."""
    ship(docs.sparkSession)
    text = text_table(docs)
    keyed = text_table(docs, row_key().alias("row"))
    keys = stored(keyed.mapInArrow(lambda it: released(_keys(it, words)), "doc_id long, row long, n_shingles long, vertex long, sketch binary"), "sets")
    known = keys.where("vertex IS NOT NULL").groupBy("vertex")
    # each vertex by one of its rows
    vertices = known.agg(F.min("row").alias("row"), F.max("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    postings = text.mapInArrow(lambda it: released(_sign(it, words, Bands(percent, n2, k2))), "sig long, vertex long")
    pairs = postings.repartition("sig").sortWithinPartitions("sig").mapInArrow(_pair_up, "a long, b long").distinct()
    wide = components(pairs).withColumnRenamed("component", "family").join(vertices, "vertex")
    sifted = _blocks(wide, SIEVE_SHINGLES, "vertex", "n_shingles", "sketch").mapInArrow(lambda it: released(_sift(it, percent)), "a long, b long")
    families = stored(components(sifted).withColumnRenamed("component", "family").join(vertices.drop("sketch"), "vertex"), "families")
    blocks = _blocks(member_texts(docs, families), BLOCK_SHINGLES, "vertex", "text", sizes=families)
    links = blocks.mapInArrow(lambda it: released(_check(it, words, percent)), "a long, b long")
    found = stored(components(links), "components")
    return keys.join(found, "vertex", "left").select("doc_id", "row", "n_shingles", "vertex", F.coalesce("component", "vertex").alias("component"))


def member_texts(docs: DataFrame, families: DataFrame) -> DataFrame:
    """The families' rows with the text of the row (its key) that stands for
    each vertex; other texts under its id stay out. A shuffle at every size."""
    return text_table(docs, row_key().alias("row")).drop("doc_id").hint("merge").join(families, "row")


def join(docs: DataFrame, words: int = 3, percent: int = 90, n2: int = 1, k2: int = 0) -> DataFrame:
    """doc_id, n_shingles, component_id: documents link when 100 * common >=
    percent * union; the component is named by its smallest doc_id."""
    named = linked(docs, words, percent, n2, k2)
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = named.join(least, "component", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, n2: int = 1, k2: int = 0) -> DataFrame:
    """The rows of ``docs``, all columns, less every document whose group has
    a smaller doc_id; rows that repeat the smallest id stay."""
    name = free_name(docs, "gone")
    gone = join(docs, words, percent, n2, k2).where("component_id < doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone.hint("merge"), F.col("doc_id").cast("long") == F.col(name), "left_anti")


def keep_one_row(docs: DataFrame, words: int = 5, percent: int = 80, n2: int = 1, k2: int = 0) -> DataFrame:
    """The rows of ``docs``, all columns, with exactly one row of each group:
    that of the smallest doc_id (nulls last), then the least key of id and
    text, then the least other columns. Rows without shingles stay."""
    rows = linked(docs, words, percent, n2, k2).where("component IS NOT NULL")
    rows = rows.groupBy("component", "row").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    rows = stored(rows, "group-rows")
    # null sorts first in a minimum, so whether it is null goes before
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    key, stays = free_name(docs, "row_key"), free_name(docs, "stays")
    marks = rows.join(first, "component").select(F.col("row").alias(key), (F.col("row") == F.col("first.row")).alias(stays), F.col("n").alias("rows"))
    marks = stored(marks.where(~F.col(stays) | (F.col("rows") > 1)).select(key, stays), "row-marks")
    # texts are shuffled at every size, once for both uses
    marked = docs.withColumn(key, row_key()).join(marks.hint("merge"), key, "left")
    own = [F.col(f"`{c}`") for c in docs.columns]
    others = marked.where(F.col(stays).isNull()).select(own)
    repeated = marked.where(F.col(stays)).groupBy(key).agg(F.min(F.struct(*own)).alias("r")).select("r.*")
    return others.unionByName(repeated)
