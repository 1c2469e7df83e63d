"""Connected components of a distributed edge list, and streaming over
runs of equal keys in sorted partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one batch -> (vertex, smallest vertex of its tree)."""
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        names, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = components_of(len(names), idx[: len(a)], idx[len(a) :])
        own = np.flatnonzero(label != np.arange(len(names)))
        yield pa.RecordBatch.from_arrays([pa.array(names[own]), pa.array(names[label[own]])], names=["a", "b"])


def components_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n vertices."""
    label = np.arange(n)
    while True:
        before = label
        low = np.minimum(label[a], label[b])
        label = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
        if (label == before).all():
            return label


def spanned(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]], most: int = 1 << 20) -> np.ndarray:
    """Smallest reachable index of each of n vertices. Edges come in parts and
    are kept as a forest, so that of a group whose members are all linked no
    more than about ``most`` edges, or one part, are held."""
    label = np.arange(n)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for a, b in pairs:
        held.append((a, b))
        size += len(a)
        if size >= most:
            label = components_of(n, np.concatenate([np.arange(n), *(x for x, _ in held)]), np.concatenate([label, *(y for _, y in held)]))
            held, size = [], 0
    return components_of(n, np.concatenate([np.arange(n), *(x for x, _ in held)]), np.concatenate([label, *(y for _, y in held)]))


#: of the edges between vertices, a hub has more than one in so many
HUBS = 1000
#: ends of edges up to which the minima of all vertices are broadcast
FEW_ENDS = 1 << 17


def with_least(rows: DataFrame, least: DataFrame, ends: int) -> DataFrame:
    """Edges (a, b) with m, the value that ``least`` (a, m, n) has for a. The
    degrees n add up to ``ends`` or less, so fewer than HUBS of the vertices
    have a degree beyond ends / HUBS: these are broadcast, and no task gets
    all edges of a hub; the others are shuffled. Of no more than FEW_ENDS, a few
    MB, all are broadcast: one exchange instead of four spares the driver, whose
    threads and plans add up over the steps."""
    if ends <= FEW_ENDS:
        return rows.select("a", "b").join(F.broadcast(least.select("a", "m")), "a")
    most = ends // HUBS
    hubs = least.where(F.col("n") > most).select("a", F.col("m").alias("hub"))
    seen = rows.join(F.broadcast(hubs), "a", "left")
    others = seen.where("hub IS NULL").select("a", "b").join(least.where(F.col("n") <= most).select("a", "m"), "a")
    return seen.where("hub IS NOT NULL").select("a", "b", F.col("hub").alias("m")).unionByName(others.select("a", "b", "m"))


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of the edges (a, b): the smallest
    vertex reachable. Alternates large-star and small-star steps; minima are
    pre-aggregated and the few hubs meet their edges by broadcast, so a vertex
    of any degree is no single task's load."""
    ship(edges.sparkSession)
    e = stored(edges.select("a", "b").where("a <> b").mapInArrow(_forest, "a long, b long").distinct(), "edges")
    n, mark = e.count(), None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("n"))
        large = with_least(both.where("b > a"), least, 2 * n).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        # a vertex with one neighbour has nothing to pass on
        passed = with_least(large, least.where("n > 1"), n).where("b <> m")
        small = least.select("a", F.col("m").alias("b")).union(passed.select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        e = stored(small, "edges")
        got = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == got:
            break
        n, mark = got.n, got
    roots = e.select(F.col("b").alias("vertex")).distinct().withColumn("component", F.col("vertex"))
    return e.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(roots)


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) for each run of equal leading ``keys`` columns of a sorted
    partition; a run may span batches."""
    held: list[pa.RecordBatch] = []
    key: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            own = tuple(c[s] for c in cols)
            if own != key and held:
                yield key, pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(s, e - s))
    if held:
        yield key, pa.Table.from_batches(held)
