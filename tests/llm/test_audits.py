"""SimHash, Merkle manifest and filter audit against brute force, and the
shipping of code to workers that don't see the repository."""

from __future__ import annotations

import hashlib
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from paddock.llm import interaction, merkle, simhash

from .cases import empty, frame, sentence, texts

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
BLANK = r"[\x20\x09-\x0D]+"


def words(t):
    return [w for w in re.split(BLANK, t or "") if w]


def sources(i):
    """As cases.frame gives them."""
    return f"src{(i or 0) % 3}"


# --- SimHash -----------------------------------------------------------------------


def brute_fingerprint(t):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(fps, bits=2):
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_and_components(spark):
    rows = texts()
    fps = [brute_fingerprint(t) for _, t in rows]
    label = brute_classes(fps)
    least = {}
    for (d, _), c in zip(rows, label, strict=True):
        ids = [x for x in (least.get(c), d) if x is not None]
        least[c] = min(ids) if ids else None
    want = Counter((d, f"{f:016x}", least[c]) for (d, _), f, c in zip(rows, fps, label, strict=True))
    assert Counter(map(tuple, simhash.near_duplicates(frame(spark)).collect())) == want


def test_no_rows_and_rows_without_ids(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []
    got = simhash.near_duplicates(frame(spark, [(None, "a b c d"), (None, "a b c d"), (3, None)])).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == {(None, None): 2, (3, 3): 1}


def as_signed(x):
    return x - (1 << 64) if x >> 63 else x


def planted(seed, common, free, n):
    """Fingerprints alike but for ``free`` bits, many of them linked."""
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        f = common | rng.getrandbits(free)
        out.add(f)
        for _ in range(3):
            g = f
            for _ in range(rng.randint(1, 3)):
                g ^= 1 << rng.randrange(64)
            out.add(g)
    return sorted(out)


@pytest.mark.parametrize("free", [64, 32, 24, 13])
def test_links_of_crowded_postings(spark, free):
    """With 32 free bits or fewer, postings of four bytes hold most fingerprints, more than are tallied one by one."""
    common = random.Random(free).getrandbits(64) >> free << free
    fps = planted(free, common, free, 1500)
    vertices = spark.createDataFrame([(as_signed(f), "x") for f in fps], "fp long, key string")
    edges = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(vertices).collect()]
    at = {f: i for i, f in enumerate(fps)}
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        x, y = find(at[a]), find(at[b])
        label[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == brute_classes(fps)


def test_looked_up_equals_tally():
    rng = np.random.default_rng(3)
    fp = np.unique(rng.integers(0, 1 << 16, 900) << 8 | 5)
    key = np.zeros(len(fp), np.int64)
    free = 0xFFFF << 8
    one = {frozenset((int(fp[a]), int(fp[b]))) for a, b in zip(*simhash.tallied(key, fp, 6, 2), strict=True)}
    two = {frozenset((int(fp[a]), int(fp[b]))) for a, b in zip(*simhash.looked_up(fp, free, 2), strict=True)}
    assert one == two and one


# --- Merkle manifest ---------------------------------------------------------------


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def way(levels, i):
    out = []
    for level in levels[:-1]:
        s = i - i % 3
        out.append((level[s:i], level[i + 1 : s + 3]))
        i //= 3
    return out


def brute_manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf_of(*r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = climb([trees[g][-1][0] for g in names])
    out = Counter()
    for k, g in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = way(trees[g], i) + way(top, k)
            now = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                now = leaf_of(*r[:4], None if r[4] is None else r[4].replace("\n", ""))
            for left, right in path:
                now = sha("".join(left) + now + "".join(right))
            proof = sha("".join(h for left, right in path for h in left + right))
            out[r[0], leaf, trees[g][-1][0], top[-1][0], proof, now, now == top[-1][0]] += 1
    return out


def found():
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return {"text": F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def test_manifest_of_awkward_rows(spark):
    df = frame(spark).withColumn("source", F.when(F.col("doc_id") % 5 != 0, F.col("source")))
    df = df.withColumns({c: F.lit(c) for c in ("grp", "digest", "found", "pos", "block", "seq", "all", "above", "root", "leaf")})
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]
    got = merkle.audit(df, COLUMNS, found())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == brute_manifest(rows)


@pytest.mark.parametrize("n, groups, levels", [(1, 1, 2), (9, 1, 2), (10, 2, 2), (400, 4, 1), (2000, 30, 2), (7000, 3, 7)])
def test_manifest_of_many_blocks(spark, n, groups, levels):
    rng = random.Random(n)
    rows = [(i, f"s{rng.randrange(groups) if rng.random() < 0.6 else 0}", "en", 3, f"text\n{i}" if i % 3 else f"t{i}") for i in rng.sample(range(10 * n), n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert Counter(map(tuple, merkle.audit(df, COLUMNS, found(), levels=levels).collect())) == brute_manifest(rows)


def test_versions_copy_ancestors_only(spark):
    rows = [(i, "s", "en", 3, f"a\n{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.audit(df, COLUMNS, found(), copies=True, levels=2).collect()
    height = len(climb(["x"] * 100)) - 1
    for r in got:
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0
        assert len(r.copies) == (height if changed else 0) and r.verified != changed
        assert not changed or r.copies[-1] == r.folded_root
    nodes = {h for level in climb([r.leaf for r in sorted(got, key=lambda r: r.doc_id)]) for h in level}
    assert not nodes & {h for r in got for h in r.copies}


def test_manifest_of_nothing(spark):
    assert merkle.audit(empty(spark), COLUMNS, found()).collect() == []


# --- filter audit ------------------------------------------------------------------


def brute_audit(rows, labels):
    """rows: doc_id, source, text; labels: doc_id -> (quality, toxic)."""
    least = {}
    for d, _, t in rows:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    parts = defaultdict(list)
    for d, s, t in rows:
        t = t or ""
        w = words(t)
        fails = {
            "A": len(w) < 50,
            "B": 100 * len(set(w)) < 65 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": d is not None and least[t] < d,
        }
        parts[s or ""].append(({k for k, v in fails.items() if v}, *labels.get(d, (None, None))))
    out = {}
    for part, own in parts.items():
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                redundant = sum(f in x[0] for x in own) - len(gone)
                alone = sum(x[0] == {f} for x in own)
                out[part, order, step + 1] = [len(left), len(gone), redundant, alone, sum(x[1] == 1 for x in gone), sum(x[2] == 1 for x in gone)]
                total[f] += len(gone)
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order):
                out[part, order, step + 1].append(total[f])
    return out


def test_filter_audit(spark):
    rng = random.Random(4)
    clean = [sentence(rng, 60) for _ in range(6)]
    rows = texts() + [(100 + i, clean[i % 6]) for i in range(20)] + [(None, clean[0]), (5, clean[0] + " #"), (6, "SHOUT " * 70)]
    df = frame(spark, rows).withColumn("source", F.when(F.col("doc_id") % 7 != 0, F.col("source")))
    df = df.withColumns({c: F.lit(1) for c in ("hash", "bits", "n", "part", "parts", "good", "toxic", "slice", "step")})
    labels = {i: (i % 2, i % 3 == 0) for i in range(0, 120, 2)}
    said = spark.createDataFrame([(i, q, int(t)) for i, (q, t) in labels.items()] + [(0, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    labels[0] = (1, 1)
    got = interaction.audit(df, said).collect()
    want = brute_audit([(r.doc_id, r.source, r.text) for r in df.collect()], labels)
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in got} == want
    assert len(got) == 600 * len({k[0] for k in want})


def test_filter_audit_of_hot_text_and_nothing(spark):
    rows = [(i, "one text " * 30) for i in range(2500)] + [(i, None) for i in range(3000, 3003)]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = interaction.audit(frame(spark, rows), labels).collect()
    assert sum(r.removed for r in got if r.filter_order == "EABCD" and r.step == 1) == 2499 + 2
    assert interaction.audit(empty(spark), labels).collect() == []


# --- code on the workers -----------------------------------------------------------

ELSEWHERE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from paddock.llm import anchors, jaccard, merkle, pseudonyms, simhash, suffixes
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
d = s.createDataFrame([(1, "a b c d", "s", "en", 7), (2, "a b c d", "s", "en", 7)], {schema!r})
print("rows", simhash.near_duplicates(d).count(), jaccard.join(d).count(), merkle.audit(d, ["doc_id"], {{}}).count())
print("rows", anchors.remove_repeats(d, 35).count(), suffixes.remove_repeats(d, 100).count(), pseudonyms.pseudonymise(d, b"k").count())
"""


def test_workers_need_no_repository(tmp_path):
    """Started elsewhere, with the repository on the driver's path only."""
    script = tmp_path / "main.py"
    script.write_text(ELSEWHERE.format(repo=REPO, schema="doc_id long, text string, source string, lang string, n_chars long"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert got.stdout.count("rows 2 2 2") == 2, got.stderr[-2000:]
