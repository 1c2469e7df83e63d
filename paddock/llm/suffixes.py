"""Exact removal of repeated byte strings by a distributed merge sort of
suffixes that never compares a known prefix twice.

Only suffixes whose string can repeat are sorted. Every string of ``length``
bytes holds an anchor, the least of its k-gram hashes, which depends on the
string alone; anchors whose surroundings occur once, or only together with
all that any string there can reach, are settled by their hashes. What is
left, the edges of repeats, is sorted: each task sorts its suffixes into
runs and sends them front-coded (length of the prefix shared with the
suffix before, then the rest) to the partition of their leading k bytes;
there a loser tree merges the runs, comparing from the known common prefix
on and passing the prefix length along. Suffixes with a common prefix come
out together with the lengths they share, and each is matched backwards
too: two occurrences that share b bytes before and f from the anchor on
cover each other's bytes if b + f is at least ``length``.

Null text is empty; rows that share an id but not a text are documents of
their own in the order of their texts' hashes, equal rows are one document;
null ids come first; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .common import mix, prefix_hash, ship, span_hash, stored
from .graph import runs as key_runs
from .repeats import NULL_DOC, Anchors

K = 36


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    have, step = x, 1
    while 2 * step <= width:
        have = np.minimum(have[:-step], have[step:])
        step *= 2
    rest = width - step
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


def find(length: int, k: int = K):
    """Anchors of a chunk: the least k-gram of every string of ``length`` bytes."""
    width = length - k + 1

    def run(buf: np.ndarray, off: np.ndarray) -> Anchors:
        n = len(buf)
        none = np.zeros(0, np.int64)
        if n < length:
            return none, none, none.astype(np.uint64), none.astype(np.uint64), none, none
        prefix = prefix_hash(buf)
        at = np.arange(n - k + 1)
        h = span_hash(prefix, at, at + k)
        # the place breaks ties, in the same way wherever the string stands
        bits = np.uint64(max(1, int(n).bit_length()))
        low = (np.uint64(1) << bits) - np.uint64(1)
        least = sliding_min((h & ~low) | at.astype(np.uint64), width)
        inside = np.zeros(len(least), bool)
        for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            if e - s >= length:
                inside[s : e - length + 1] = True
        at = np.unique(least[inside] & low).astype(np.int64)
        row = np.searchsorted(off, at, "right") - 1
        left = np.minimum(at - off[row], length - k)
        right = np.minimum(off[row + 1] - at, length)
        context = mix(span_hash(prefix, at - left, at + right) + left.astype(np.uint64) * np.uint64(length + 1) + right.astype(np.uint64))
        return row, at - off[row], h[at], context, left, right

    return run


def front_code(suffixes: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Of a sorted run: prefix lengths shared with the suffix before, and the rests."""
    shared = np.zeros(len(suffixes), np.int32)
    rest = [suffixes[0]] if suffixes else []
    for i in range(1, len(suffixes)):
        shared[i] = m = common_prefix(suffixes[i - 1], suffixes[i], 0)
        rest.append(suffixes[i][m:])
    return shared, b"".join(rest)


def common_prefix(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    x = int.from_bytes(a[start:n], "big") ^ int.from_bytes(b[start:n], "big")
    return n - (x.bit_length() + 7) // 8


class Run:
    """A front-coded run, read suffix by suffix; ``shared`` is the prefix
    length that the current suffix has in common with the last one merged."""

    __slots__ = ("suffix", "shared", "item", "_lcp", "_size", "_rest", "_at", "_next")

    def __init__(self, lcp, size, rest: bytes):
        self._lcp, self._size, self._rest = lcp, size, rest
        self._at, self._next = 0, -1
        self.suffix: bytes | None = b""
        self.step()

    def step(self) -> None:
        self._next += 1
        if self._next == len(self._lcp):
            self.suffix = None
            return
        m = self._lcp[self._next]
        e = self._at + self._size[self._next] - m
        self.suffix = self.suffix[:m] + self._rest[self._at : e]
        self._at, self.shared, self.item = e, m, self._next


def _beats(a: int, b: int, runs: list[Run]) -> bool:
    """Whether run a's suffix goes before run b's. Both know the prefix they
    share with the last winner: the longer one is nearer to it and smaller;
    only equal lengths need a comparison, from there on, after which the
    loser knows its prefix with the winner."""
    x, y = runs[a], runs[b]
    if x.suffix is None or y.suffix is None:
        return y.suffix is None and (x.suffix is not None or a < b)
    if x.shared != y.shared:
        return x.shared > y.shared
    m = common_prefix(x.suffix, y.suffix, x.shared)
    first = x.suffix[m:] < y.suffix[m:] or (x.suffix == y.suffix and a < b)
    (y if first else x).shared = m
    return first


def merge(runs: list[Run]) -> Iterator[tuple[int, int, int, bytes]]:
    """(run, item, prefix length shared with the one before, suffix) in order,
    by a tree of losers."""
    k = len(runs)
    if not k:
        return
    tree = [-1] * k

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        win, lose = (a, b) if _beats(a, b, runs) else (b, a)
        tree[node] = lose
        return win

    for r in runs:
        r.shared = 0
    winner = play(1) if k > 1 else 0
    while runs[winner].suffix is not None:
        r = runs[winner]
        yield winner, r.item, r.shared, r.suffix
        r.step()
        node = (winner + k) // 2
        while node >= 1:
            if _beats(tree[node], winner, runs):
                tree[node], winner = winner, tree[node]
            node //= 2


BLOCKS = "bucket int, lcp binary, size binary, rest binary, before binary, doc binary, place binary"
BUCKETS = 4096
RUN_ITEMS = 50_000


def _sorted_runs(batches: Iterator[pa.RecordBatch], length: int, k: int) -> Iterator[pa.RecordBatch]:
    """The suffixes at edge anchors, in front-coded sorted runs by bucket;
    ``before`` holds the bytes before each, nearest first, padded with its count."""
    items: list[tuple] = []
    last = None
    for doc, tag, at, _, text in repeats.marked_texts(batches):
        if (doc, tag) == last:  # a repeated row
            continue
        last = (doc, tag)
        for a in np.unique(at).tolist():
            back = text[max(0, a - (length - k)) : a][::-1]
            suffix = text[a : a + length]
            items.append((_bucket(suffix[:k]), suffix, doc, tag + a, back))
        if len(items) >= RUN_ITEMS:
            yield from _runs_of(items, length - k)
            items = []
    if items:
        yield from _runs_of(items, length - k)


def _bucket(lead: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(lead, digest_size=4).digest(), "big") % BUCKETS


def _runs_of(items: list[tuple], reach: int) -> Iterator[pa.RecordBatch]:
    items.sort()
    out: dict[str, list] = {c: [] for c in ("bucket", "lcp", "size", "rest", "before", "doc", "place")}
    i = 0
    while i < len(items):
        j = i
        while j < len(items) and items[j][0] == items[i][0]:
            j += 1
        part = items[i:j]
        lcp, rest = front_code([p[1] for p in part])
        out["bucket"].append(part[0][0])
        out["lcp"].append(lcp.astype("<i4").tobytes())
        out["size"].append(np.array([len(p[1]) for p in part], "<i4").tobytes())
        out["rest"].append(rest)
        out["before"].append(b"".join(bytes([len(p[4])]) + p[4].ljust(reach, b"\0") for p in part))
        out["doc"].append(np.array([p[2] for p in part], "<i8").tobytes())
        out["place"].append(np.array([p[3] for p in part], "<i8").tobytes())
        i = j
    yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int32() if c == "bucket" else pa.binary()) for c, v in out.items()})


def _match(batches: Iterator[pa.RecordBatch], length: int, k: int) -> Iterator[pa.RecordBatch]:
    """Merge the runs of each bucket; report what an earlier occurrence covers."""
    reach = length - k
    found: list[tuple[int, int, int]] = []
    for _, table in key_runs(batches, 1):
        blocks = {c: table.column(c).to_pylist() for c in table.column_names}
        num = lambda c, t: [np.frombuffer(x, t) for x in blocks[c]]
        doc, place = [x.tolist() for x in num("doc", "<i8")], [x.tolist() for x in num("place", "<i8")]
        runs = [Run(m.tolist(), s.tolist(), r) for m, s, r in zip(num("lcp", "<i4"), num("size", "<i4"), blocks["rest"], strict=True)]
        group: list[tuple[int, int]] = []
        shared: list[int] = []
        suffixes: list[bytes] = []

        def close() -> None:
            if len(group) > 1:
                d = [doc[r][i] for r, i in group]
                p = [place[r][i] for r, i in group]
                w = reach + 1
                back = [blocks["before"][r][i * w : (i + 1) * w] for r, i in group]
                if len(group) <= PAIRWISE:
                    back = [x[1 : 1 + x[0]] for x in back]
                    found.extend(_covered_pairwise(d, p, back, shared, length))
                else:
                    found.extend(_covered_in_group(np.array(d), np.array(p), back, shared, suffixes, length))

        for r, i, m, suffix in merge(runs):
            if m < k and group:
                close()
                group, shared, suffixes = [], [], []
            group.append((r, i))
            shared.append(m)
            suffixes.append(suffix)
        close()
        if len(found) >= 10_000:
            yield _marks(found)
            found = []
    if found:
        yield _marks(found)


def _marks(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    d, s, e = repeats.merged(*(np.array(c, np.int64) for c in zip(*found, strict=True)))
    return pa.RecordBatch.from_arrays([pa.array(d), pa.array(s), pa.array(e)], names=["doc", "place", "stop"])


#: groups of more are matched by classes, at a cost linear in the group
PAIRWISE = 40


def _covered_pairwise(doc: list[int], place: list[int], back: list[bytes], shared: list[int], length: int) -> Iterator[tuple[int, int, int]]:
    """Small groups, pair by pair: what each shares forwards is the least
    prefix length between them in sorted order."""
    for j in range(1, len(doc)):
        f = length
        for i in range(j - 1, -1, -1):
            f = min(f, shared[i + 1])
            need = length - f
            if min(len(back[i]), len(back[j])) < need or back[i][:need] != back[j][:need]:
                continue
            b = common_prefix(back[i], back[j], need)
            later = j if (doc[i], place[i]) < (doc[j], place[j]) else i
            yield doc[later], place[later] - b, place[later] + f


def _covered_in_group(doc, place, back: list[bytes], shared: list[int], suffixes: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """A group is sorted by suffix; ``shared[i]`` is the prefix of i with i - 1.
    For each count b of bytes before, the strings from b before to
    length - b after are equal where the befores agree on b bytes and the
    suffixes on length - b: classes of both are runs of sorted orders. All
    but the earliest of a class are covered. Linear in the group for each b."""
    n = len(doc)
    lcp = np.array(shared)
    size = np.array([len(s) for s in suffixes])
    have = np.array([x[0] for x in back])
    order = np.lexsort((place, doc))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    # order of the befores, nearest byte first, and what neighbours in it share
    by_back = np.array(sorted(range(n), key=lambda i: back[i][1 : 1 + have[i]]))
    near = np.zeros(n, np.int64)
    for x in range(1, n):
        a, b = back[by_back[x - 1]], back[by_back[x]]
        near[x] = common_prefix(a[1 : 1 + a[0]], b[1 : 1 + b[0]], 0)
    spans: list[np.ndarray] = []
    back_class = np.zeros(n, np.int64)
    for b in range(int(have.max()) + 1):
        able = (have >= b) & (size >= length - b)
        if able.sum() < 2:
            continue
        fwd_class = np.cumsum(np.concatenate([[False], lcp[1:] < length - b]))
        back_class[by_back] = np.cumsum(np.concatenate([[False], near[1:] < b]))
        i = np.flatnonzero(able)
        key = fwd_class[i] * (n + 1) + back_class[i]
        o = np.lexsort((rank[i], key))
        later = np.concatenate([[False], key[o][1:] == key[o][:-1]])
        hit = i[o[later]]
        if len(hit):
            spans.append(np.stack([doc[hit], place[hit] - b, place[hit] - b + length]))
    if spans:
        d, s, e = repeats.merged(*np.concatenate(spans, 1))
        yield from zip(d.tolist(), s.tolist(), e.tolist(), strict=True)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"


def _finish(batches: Iterator[pa.RecordBatch], length: int, k: int) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    held = 0
    for doc, _, starts, stops, text in repeats.marked_texts(batches):
        whole = stops == 0
        s = np.where(whole, np.maximum(starts - (length - k), 0), starts)
        e = np.where(whole, np.minimum(starts + length, len(text)), stops)
        gone = repeats.covered(len(text), s, e)
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        out.append((None if doc == NULL_DOC else doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
        held += len(kept)
        if held >= 4 << 20 or len(out) >= 2000:
            yield _result(out)
            out, held = [], 0
    if out:
        yield _result(out)


def _result(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.string()] * 2
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def remove_repeats(docs: DataFrame, length: int = 100, k: int = K) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the remaining
    bytes) and kept (those bytes as text; cut characters are replaced)."""
    ship(docs.sparkSession)
    text, names = repeats.own_ids(docs)
    back = length - k
    rows = text.mapInArrow(lambda it: repeats.anchor_rows(it, find(length, k), True), repeats.ROWS)
    rows = rows.repartition("group").sortWithinPartitions("group", "context", "doc", "place")
    spans = stored(rows.mapInArrow(lambda it: repeats.settle(it, (back, length), True), repeats.SPANS), "suffix-spans")
    edges = spans.where(F.col("kind") == repeats.EDGE)
    blocks = repeats.with_texts(text, edges).mapInArrow(lambda it: _sorted_runs(it, length, k), BLOCKS)
    matched = blocks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _match(it, length, k), "doc long, place long, stop long")
    marks = spans.where(F.col("kind") == repeats.COVER).select("doc", "place", "stop").unionByName(stored(matched, "suffix-matches"))
    return repeats.named(repeats.with_texts(text, marks).mapInArrow(lambda it: _finish(it, length, k), RESULT), names)
