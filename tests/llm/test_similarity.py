"""Operators on shingles and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paddock.llm import anchors, jaccard, suffixes
from paddock.llm.graph import components

from .cases import empty, frame, sentence, texts

BLANK = r"[\x20\x09-\x0D]+"


def words(t):
    return [w for w in re.split(BLANK, t or "") if w]


def shingle_set(t, n):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(t)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def brute_components(rows, n, percent):
    sets = [shingle_set(t, n) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    out = Counter()
    for i, (d, _) in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out[d, len(sets[i]), min(members) if members and sets[i] else d] += 1
    return out


@pytest.mark.parametrize(("n", "percent", "n2", "k2"), [(3, 90, 1, 0), (5, 80, 1, 0), (2, 70, 3, 1)])
def test_jaccard_join_finds_the_components(spark, n, percent, n2, k2):
    got = jaccard.join(frame(spark), n, percent, n2, k2).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(texts(), n, percent)
    assert jaccard.join(empty(spark), n, percent).count() == 0


def test_keep_one_keeps_the_smallest(spark):
    kept = jaccard.keep_one(frame(spark), 3, 90)
    assert kept.columns == frame(spark).columns
    want = Counter(d for (d, _, c), k in brute_components(texts(), 3, 90).items() for _ in range(k) if d is None or c is None or d <= c)
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_the_pipeline_keeps_one_row_of_each_group(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta eta", "one two three four five six seven eight", "red green blue white black grey pink")
    rows = [(1, a), (2, a), (2, b), (2, None), (2, None), (None, a), (None, c), (None, c), (None, ""), (3, c.upper()), (None, "lone null row of its own words"), (4, "x " + b), (5, "same id twice here it is"), (5, "same id twice here it is")]
    docs = frame(spark, rows)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.schema == docs.schema
    want = [(1, a), (2, b), (2, None), (2, None), (None, ""), (3, c.upper()), (None, "lone null row of its own words"), (5, "same id twice here it is")]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want)
    null_only = frame(spark, [(None, a)] * 3)
    assert [r.text for r in corpus_pipeline.drop_near_copies(spark, null_only, "").collect()] == [a]


def test_every_similar_pair_shares_a_signature():
    rng = np.random.default_rng(3)
    for percent, n2, k2 in ((90, 1, 0), (80, 1, 0), (80, 3, 1)):
        bands = jaccard.Bands(percent, n2, k2)
        for _ in range(300):
            n = int(rng.integers(10, 400))
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            b = a.copy()
            drop = int(rng.integers(0, len(a) // 5 + 1))
            b = np.unique(np.concatenate([b[drop:], rng.integers(0, 2**63, int(rng.integers(0, n // 8 + 1))).astype(np.uint64) * np.uint64(2) + np.uint64(1)]))
            common, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            if 100 * common >= percent * union and jaccard.set_key(a) != jaccard.set_key(b):
                assert set(jaccard.signatures(a, bands).tolist()) & set(jaccard.signatures(b, bands).tolist())


def test_the_sieve_passes_every_similar_pair():
    rng = np.random.default_rng(9)
    sets = []
    for _ in range(40):
        base = np.unique(rng.integers(0, 2**63, int(rng.integers(5, 300))).astype(np.uint64))
        sets += [base, np.unique(np.concatenate([base[int(rng.integers(0, 4)) :], rng.integers(0, 2**63, int(rng.integers(0, 9))).astype(np.uint64)]))]
    n = np.array([len(x) for x in sets])
    sides = np.arange(len(sets)) % 2
    for across in (False, True):
        a, b = jaccard.sieve(n, [jaccard.sketch(x) for x in sets], sides, across, 80)
        got = {frozenset(p) for p in zip(a.tolist(), b.tolist(), strict=True)}
        for i in range(len(sets)):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= 80 * (n[i] + n[j] - common) and (not across or sides[i] != sides[j]):
                    assert frozenset((i, j)) in got
        assert len(got) < 400


def test_blocks_report_the_links_across_them(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 200)  # the near copies fill many blocks
    monkeypatch.setattr(jaccard, "SIEVE_SHINGLES", 300)
    got = jaccard.join(frame(spark), 3, 90).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(texts(), 3, 90)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 20] + [(100, 100), (7, 200)]
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got[39] == 21 and got[200] == 1 and got[59] == 41 and 100 not in got


def order(rows):
    """Distinct documents in the order of ids (null first) and text tags."""
    distinct = {(d, t or "") for d, t in rows}
    return sorted(distinct, key=lambda x: (x[0] is not None, x[0] or 0, zlib.crc32(x[1].encode()) & 0xFFFFF))


def brute_bytes(rows, length):
    seen, out = set(), {}
    for d, t in order(rows):
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = True
            seen.add(w)
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = len(re.findall(rb"\x01+", gone.astype(np.uint8).tobytes()))
        out[d, t] = (d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return Counter(out[d, t or ""] for d, t in rows)


@pytest.mark.parametrize(("length", "k"), [(100, 36), (30, 12)])
def test_suffix_merge_removes_later_occurrences(spark, length, k):
    got = suffixes.remove_repeats(frame(spark).repartition(5), length, k).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes(texts(), length)
    assert suffixes.remove_repeats(empty(spark)).count() == 0


def test_groups_are_matched_alike_by_pairs_and_by_classes(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PAIRWISE", 1)
    got = suffixes.remove_repeats(frame(spark).repartition(5)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes(texts(), 100)


def test_loser_tree_merges_front_coded_runs():
    import random

    rng = random.Random(5)
    for k in (1, 2, 3, 7):
        runs, every = [], []
        for _ in range(k):
            own = sorted("".join(rng.choice("ab") for _ in range(rng.randint(1, 12))).encode() for _ in range(rng.randint(0, 40)))
            every += own
            lcp, rest = suffixes.front_code(own)
            runs.append(suffixes.Run(lcp.tolist(), [len(x) for x in own], rest))
        merged = list(suffixes.merge(runs))
        assert [m[3] for m in merged] == sorted(every)
        for a, b in zip(merged, merged[1:], strict=False):
            assert b[2] == suffixes.common_prefix(a[3], b[3], 0)


def brute_words(rows, window):
    docs = order(rows)
    count = Counter(tuple(words(t)[i : i + window]) for _, t in docs for i in range(len(words(t)) - window + 1))
    out = {}
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[d, t] = (d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return Counter(out[d, t or ""] for d, t in rows)


@pytest.mark.parametrize("window", [35, 24])
def test_difference_cover_removes_all_occurrences(spark, window):
    got = anchors.remove_repeats(frame(spark).repartition(5), window).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_words(texts(), window)
    assert anchors.remove_repeats(empty(spark)).count() == 0


def test_merged_intervals_keep_texts_under_one_id_apart():
    from paddock.llm.repeats import PLACE_BITS, merged

    t = 3 << PLACE_BITS
    d, s, e = merged(*(np.array(x) for x in ([1, 1, 1, 1, 2, 1], [5, 0, t + 2, t + 50, 1, 8], [20, 6, t + 9, t + 60, 4, 30])))
    assert list(zip(d.tolist(), s.tolist(), e.tolist(), strict=True)) == [(1, 0, 30), (1, t + 2, t + 9), (1, t + 50, t + 60), (2, 1, 4)]


def test_cover_meets_every_shift():
    p, c = anchors.PERIOD, anchors.COVER
    assert {(a - b) % p for a in c for b in c} == set(range(p))


def test_random_corpora_with_small_batches(spark):
    import random

    rng = random.Random(11)
    pool = [sentence(rng, 45) for _ in range(4)]
    rows = [(i, " ".join(rng.choice(pool) if rng.random() < 0.5 else sentence(rng, 20) for _ in range(rng.randint(0, 4)))) for i in range(60)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # groups span batches
    try:
        got = suffixes.remove_repeats(frame(spark, rows).repartition(3)).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes(rows, 100)
        got = anchors.remove_repeats(frame(spark, rows).repartition(3)).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_words(rows, 35)
        got = jaccard.join(frame(spark, rows).repartition(3), 3, 60).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 3, 60)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_minima_of_few_edges_are_one_broadcast(spark, monkeypatch):
    """Small graphs cost the driver one join a step; either way gives the same rows, hubs or not."""
    from paddock.llm import graph

    pairs = [(1, b) for b in range(2, 60)] + [(100 + k, 101 + k) for k in range(30)] + [(59, 130), (400, 401)]
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(3)
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))

    def both(least):
        few = graph.with_least(edges, least, 2 * len(pairs))
        monkeypatch.setattr(graph, "FEW_ENDS", 0)
        split = graph.with_least(edges, least, 2 * len(pairs))
        monkeypatch.undo()
        return few, split

    for some in (least, least.where("n > 1")):
        few, split = both(some)
        assert Counter(map(tuple, few.collect())) == Counter(map(tuple, split.collect())) and few.columns == split.columns
    assert few._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
