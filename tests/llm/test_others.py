"""The other operators and the pipeline on awkward and planted rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paddock.llm import decontaminate, licences, packing, pseudonyms, quality, toxicity, warc
from paddock.llm.queries import ORACLE, QUERIES

from .cases import SCHEMA, empty, frame, sentence, texts

PATH = public_tokenizers.path("word_bpe_49k.json")


# --- decontamination ---------------------------------------------------------------


def bench_words(t):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded) if w]


def brute_hits(rows, items, size=10):
    wins = set()
    for i, t in items:
        w = bench_words(t)
        if w:
            n = min(size, len(w))
            wins |= {(i, tuple(w[s : s + n])) for s in range(len(w) - n + 1)}
    out = Counter()
    for d, t in rows:
        w = bench_words(t)
        hit, ids = set(), set()
        for i, win in wins:
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    ids.add(i)
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out[d, len(w), len(hit), len(ids), digest, bool(hit)] += 1
    return out


def bench_items():
    rows = texts()
    shared = " ".join(rows[20][1].split("\n")[1].split(" ")[5:30])
    return [("10", shared.upper()), ("9", shared), ("a", "two words"), ("b", None), ("c", "!!"), ("d", "not in there at all"), (None, "same same same same")]


def test_decontamination_equals_brute_force(spark):
    items = [("null" if i is None else i, t) for i, t in bench_items() if i is not None]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.report(frame(spark), bench).collect()
    assert Counter(tuple(r) for r in got) == brute_hits(texts(), items)
    clean = decontaminate.remove_contaminated(frame(spark), bench)
    assert clean.columns == frame(spark).columns
    want = Counter(k[0] for k, n in brute_hits(texts(), items).items() for _ in range(n) if not k[-1])
    assert Counter(r.doc_id for r in clean.collect()) == want
    assert decontaminate.report(empty(spark), bench).count() == 0
    none = decontaminate.report(frame(spark), bench.where("false")).collect()
    assert len(none) == len(texts()) and not any(r.contaminated for r in none)


def test_proximity_matches_are_reported_apart(spark):
    bench = spark.createDataFrame([("x", "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id string, text string")
    near = "alpha beta gamma delta epsilon inserted zeta eta theta iota kappa"
    docs = frame(spark, [(1, near), (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (3, "nothing")])
    rows = {r.doc_id: r for r in decontaminate.find(docs, bench, 10, slop=2).collect()}
    assert rows[1].items == [] and rows[1].near_items == ["x"] and rows[1].n_hit == 0
    assert rows[2].items == ["x"] and rows[2].near_items == [] and rows[3].near_items == []


def test_native_operators_have_no_python_nodes(spark):
    bench = spark.createDataFrame(bench_items(), "item_id string, text string")
    plan = decontaminate.report(frame(spark), bench)._jdf.queryExecution().toString()
    assert not re.search("MapInArrow|MapInPandas|ArrowEvalPython|BatchEvalPython|CartesianProduct|BroadcastNestedLoop", plan)


# --- quality -------------------------------------------------------------------------


def brute_counts(t):
    t = t or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    c = Counter(zip(w, w[1:], w[2:], strict=False))
    cover = {i + k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def test_quality_counts_and_base_rules(spark):
    rows = [*texts(), (60, "a line\nother\na line\n\n\na line"), (61, "# * | <b>\n \n \n# * | <b>"), (62, "\nx\n")]
    got = quality.judge(frame(spark, rows), min_rows=5).collect()
    have = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    want = Counter()
    for d, t in rows:
        c = brute_counts(t)
        want[(d, *c, c[0] < 50 or 100 * c[4] > 50 * c[0])] += 1
    assert have == want
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.judge(empty(spark)).count() == 0


def test_outliers_of_a_group_are_rejected(spark):
    rng = random.Random(2)
    rows = [(i, "\n".join(sentence(rng, 30) for _ in range(4))) for i in range(400)]
    rows += [(1000 + i, " ".join(w + "###$$$" for w in sentence(rng, 120).split(" "))) for i in range(30)]
    got = {r.doc_id: r.kept for r in quality.judge(frame(spark, rows), min_rows=50).collect()}
    assert all(got[i] for i in range(400)) and not any(got[1000 + i] for i in range(30))


def test_junk_between_the_quantiles_is_rejected(spark):
    # a tenth of the characters are symbols: distance 29 to 40 under scatter + floors
    rng = random.Random(8)
    rows = [(i, "\n".join(sentence(rng, 30) for _ in range(4))) for i in range(600)]
    for i in range(20):
        w = sentence(rng, 120).split(" ")
        rows.append((1000 + i, "\n".join(" ".join(x + "#|" * (k % 4 == 0) for k, x in enumerate(w[s : s + 30])) for s in range(0, 120, 30))))
    got = {r.doc_id: r for r in quality.judge(frame(spark, rows), min_rows=50).collect()}
    assert not any(got[1000 + i].kept for i in range(20))
    assert sum(not got[i].kept for i in range(600)) <= 6
    tight = quality._solve(iter([solvable(np.diag([4.0, 0.25, 1, 1, 1, 1, 1]))]))  # in squared floors
    b = next(tight)
    assert np.allclose([b.column("p_0_0")[0].as_py(), b.column("p_1_1")[0].as_py()], [1 / (4 * quality.CONSISTENCY), 1 / quality.FLOORS["word_size"] ** 2])


def solvable(cov):
    """The moments of 1000 rows of centre 0 whose scatter is ``cov`` squared floors."""
    least = np.array(list(quality.FLOORS.values()))
    cov = cov * np.outer(least, least)
    cols = {"g": ["a"], "n": [1000], **{f"s{k}": [0.0] for k in range(quality.DIMS)}, **{f"q_{i}_{j}": [1000 * cov[i, j]] for i, j in quality._pairs()}}
    return pa.RecordBatch.from_pydict(cols)


# --- toxicity ------------------------------------------------------------------------


def toxic_rows(n=1500, seed=4):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = sentence(rng, 60).split(" ")
        bad = rng.random() < 0.2
        if bad:
            for _ in range(rng.randint(2, 5)):
                w.insert(rng.randrange(len(w)), "zorgle" + rng.choice(["", "ra", "tto", "bing"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_learns_word_beginnings_and_holds_out(spark):
    rows, labels = toxic_rows()
    lab = spark.createDataFrame([(i, None, t) for i, t in labels] + [(None, None, 1), (5000, None, None)], "doc_id long, quality int, toxic int")
    docs = frame(spark, [*rows, *texts(9)[32:]])
    got = toxicity.score(docs, lab).collect()
    assert len(got) == len(rows) + len(texts(9)[32:])
    truth = dict(labels)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    first = {r.doc_id: r.predicted for r in got[: len(rows)]}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([first[i] == truth[i] for i in held]) > 0.97
    # labels of held-out rows are not read
    flipped = [(i, None, 1 - t if i in set(held) else t) for i, t in labels]
    again = toxicity.score(docs, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int")).collect()
    assert [r.score for r in again] == [r.score for r in got]
    kept = toxicity.remove_toxic(docs, lab)
    assert kept.columns == docs.columns and kept.count() == sum(1 for r in got if not r.predicted)
    assert toxicity.score(empty(spark), lab).count() == 0
    assert toxicity.score(frame(spark), lab.where("false")).count() == len(texts())


def test_grammar_weighs_clauses():
    g = toxicity.Grammar()
    i, t, you, no, said = toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT
    w = lambda *k: g.clause(list(k), [1.0] * len(k))
    assert w(you, i) > w(i) > w(said, i) > w(no, i) > 0
    assert w(you, t) > w(t) and w(you, no, t) < w(you, t) and w(said, you, t) < w(you, t)


# --- packing -------------------------------------------------------------------------


def test_packing_holds_every_token_once(spark):
    rows = [*texts(), (70, "<|endoftext|> don't 'S A'LL!! ÉCOLE, x" + "\x7f" + "y " + "été; 12 ﬁ")]
    cap = 300
    got = packing.pack(frame(spark, rows), PATH, cap).collect()
    tok = Tokenizer.from_file(PATH)
    want = Counter()
    for d, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), cap):
            part = ids[k : k + cap]
            want[d, k // cap, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= cap
    hist = Counter(r.length for r in got)
    greedy = sum(m for _, m in packing.best_fit_runs(list(hist), list(hist.values()), cap))
    assert len(by) <= greedy + 2
    assert packing.pack(empty(spark), PATH, cap).count() == 0


def test_plan_is_scale_free_and_near_the_bound():
    rng = np.random.default_rng(1)
    hist = Counter(rng.integers(1, 2048, 3000).tolist())
    for scale in (1, 1000):
        seqs = packing.plan({k: v * scale for k, v in hist.items()}, 2048)
        placed = Counter()
        for items, m in seqs:
            assert sum(items) <= 2048
            for x in items:
                placed[x] += m
        assert placed == Counter({k: v * scale for k, v in hist.items()})
        bound = -(-sum(k * v * scale for k, v in hist.items()) // 2048)
        assert sum(m for _, m in seqs) <= bound * 1.01 + 2


# --- pseudonyms ------------------------------------------------------------------------

SAMPLE = (
    "call +1 (555) 555-5657, mail that.92@mail2.example.com. ip 108.51.216.133 card 4111 1111 1111 1111 or 4111111111111111; "
    'ssn 123-45-6789 born 1980-02-29 or 31/12/1999, 29.02.2000 iban DE89 3704 0044 0532 0130 00 token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"!!'
)


def test_pseudonyms_keep_formats_link_values_and_invert(spark):
    rows = [(1, SAMPLE), (2, "again 108.51.216.133 " + SAMPLE), (3, "no values 999.1.1.1 4111111111111112 2021-02-30"), *texts()]
    docs = frame(spark, rows)
    out = pseudonyms.pseudonymise(docs, b"key").collect()
    new = out[0].text
    assert len(re.findall(r"\d{1,3}(?:\.\d{1,3}){3}", new)) == 1 and "108.51.216.133" not in new
    cards = re.findall(r"card ([\d ]+) or (\d+);", new)[0]
    assert cards[0].replace(" ", "") == cards[1] and pseudonyms.luhn_valid(cards[1]) and cards[1] != "4111111111111111"
    assert re.search(r"iban (DE\d\d) ((?:\d{4} ){4}\d\d)", new) and re.search(r"token = \"[0-9a-f]{40}\"", new)
    flat = re.search(r"iban ([A-Z0-9 ]+) token", new)[1].replace(" ", "")
    assert pseudonyms.iban_check(flat[:2], flat[4:]) == flat[2:4]
    ip = re.search(r"ip ([\d.]+)", new)[1]
    assert out[1].text == f"again {ip} {new}"  # linked across documents
    assert out[2].text == rows[2][1] and sum(out[2][2:]) == 0
    back = pseudonyms.pseudonymise(spark.createDataFrame([(r.doc_id, r.text) for r in out], "doc_id long, text string"), b"key", back=True).collect()
    assert [(r.doc_id, r.text) for r in back] == rows
    assert pseudonyms.pseudonymise(docs, b"other").first().text != new
    kept = pseudonyms.replace_in(docs, b"key")
    assert kept.schema == docs.schema and [r.text for r in kept.collect()] == [r.text for r in out]
    assert pseudonyms.pseudonymise(empty(spark), b"key").count() == 0


def test_values_among_other_groups_are_replaced_and_invert():
    card, iban = "4111 1111 1111 1111", "AT61 1904 3002 3457 3201"
    forms = ["{c} 12/27", "{c} 123", "4111111111111111 123", "4111111111111111-12", "12 {c}", "qty 1234 {c} 7", "{c} 5500 0000 0000 0004 99", "{c}-12345", "2024 01 15 {c}"]
    forms += ["{i} BIC BKAUATWW", "{i} EUR", "AT611904300234573201 EUR 5", "{i} BANK AUSTRIA", "AB12 CDEF GHIJ {i}", "378282246310005 1234", "{c} 555-555-5657", "9 {c} 123-45-6789"]
    for key in range(40):
        there, back = pseudonyms.Scrubber(b"%d" % key), pseudonyms.Scrubber(b"%d" % key, True)
        for form in forms:
            text = form.format(c=card, i=iban)
            new, counts = there.scrub(text)
            kind = "iban" if "AT61" in text else "card"
            assert counts[kind] == text.count("5500") + 1, (text, new)
            assert not any(v in new for v in (card, "4111111111111111", iban, "AT611904300234573201", "378282246310005", "5500 0000 0000 0004", "555-555-5657", "123-45-6789"))
            assert back.scrub(new)[0] == text
        assert there.scrub(iban)[0] in there.scrub(iban + " EUR")[0]  # linked
        assert there.scrub(card)[0] in there.scrub(card + " 12/27")[0]
    assert "4111 1111 1111 1112 123" == there.scrub("4111 1111 1111 1112 123")[0]


def test_feistel_is_a_permutation():
    f = pseudonyms.Feistel(b"x")
    for n in (1, 2, 10, 97, 1000):
        got = [f.permute(i, n, "t") for i in range(n)]
        assert sorted(got) == list(range(n)) and [f.permute(x, n, "t", True) for x in got] == list(range(n))


# --- WARC ------------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    rng = random.Random(3)
    body = "<html>" + sentence(rng, 400) + "</html>"
    rows = [(i, f"http://h/{i} x\r\n", "<html><head><title>page</title></head><p>" + sentence(rng, rng.randint(0, 300)) + "<footer>all the same at the end of every page</footer></html>") for i in range(99)]
    rows += [(100, "http://a", body), (101, None, body), (102, "http://b", body), (103, "u", None), (104, "u", ""), (105, "u", "small"), (106, "u", "small"), (None, "u", body), (102, "again", body)]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, digest int, payload string").repartition(4)
    folder = f"file://{tmp_path}/warc"
    manifest = warc.write_archives(pages, folder, archive_limit=60_000)
    got = warc.read_archives(manifest, payloads=True).collect()
    assert sum(r.records for r in manifest.collect()) == len(got) == len(rows)
    want = Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        last = max((p for p, _, x in rows if x == h and p is not None), default=None) if len(b) >= 1000 else None
        refers = last if last is not None and i != last else None
        want[i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if refers is not None else "response", refers, None if refers is not None else b] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == want
    leads = [f.read_bytes()[:4] for f in (tmp_path / "warc").glob("*.zst")]
    assert set(leads) == {warc.DICT_MAGIC.to_bytes(4, "little")}
    none = pages.where("false")
    assert warc.read_archives(warc.write_archives(none, folder + "2")).count() == 0


# --- licences ----------------------------------------------------------------------------


def test_licences_are_told_apart(spark):
    rng = random.Random(8)
    lines = {"apache": "Licensed under the Apache License, Version 2.0.", "gpl": "This work is licensed under the GNU General Public License, version 3.", "mit": "Released under the MIT License.", "cc-by-nc": "Licensed under CC BY-NC 4.0."}
    rows, want = [], {}
    for i in range(200):
        kind = rng.choice([None, *lines])
        text = "\n".join([sentence(rng, 30), *([lines[kind]] if kind else []), sentence(rng, 20)])
        rows.append((1000 + i, text))
        want[1000 + i] = kind
    rows.append((500, "The apache helicopter landed near the public school.\nHe lost his driving license."))
    docs = frame(spark, [*rows, *[r for r in texts() if r[0] is not None and r[0] >= 40 and r[0] < 50]])
    got = licences.scan(docs).collect()
    for r in got:
        if r.doc_id in want:
            assert (r.family, r.families) == (want[r.doc_id], want[r.doc_id] or ""), r
            assert r.confirmed == (want[r.doc_id] is not None)
        elif r.doc_id == 500 or r.doc_id >= 40:
            assert r.n_paragraphs == 0 and r.family is None
    assert licences.scan(empty(spark)).count() == 0


# --- registration and the pipeline -----------------------------------------------------------


def test_triggers_come_from_all_paragraphs(spark):
    # first lines of a hot source have licence words; the licences stand further down
    rng = random.Random(5)
    rows = [(i, "\n".join([f"License: ISC, version 2, gnu mit apache copyright header {i}" if i % 3 else sentence(rng, 6), *(sentence(rng, 6) for _ in range(300))])) for i in range(60)]
    rows += [(100 + i, "\n".join([sentence(rng, 6) for _ in range(5)] + [line])) for i, line in enumerate(("Released under the MIT License.", "SPDX-License-Identifier: Apache-2.0"))]
    words = licences.template_table(spark).withColumn("words", licences.words_of(F.col("text")))
    model = licences.learn(frame(spark, rows))
    assert {"license", "mit", "gnu", "copyright"} <= set(model.triggers)  # 40 of over 18,000 paragraphs
    got = {r.doc_id: r.family for r in licences.scan(frame(spark, rows)).collect()}
    assert got[100] == "mit" and got[101] == "apache"
    every = licences.pick_triggers(frame(spark, rows), words, F.array(F.lit("none at all")), -1.0)
    assert all(set(every) & set(r.words) for r in words.where("family <> 'unknown'").collect())  # each wording keeps one


def test_queries_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES)
    assert numbers == list(range(1, 11)) and set(ORACLE) <= set(QUERIES)


@pytest.fixture(scope="module")
def pipeline_dir(spark, tmp_path_factory):
    rows, labels = toxic_rows(400, 6)
    rng = random.Random(1)
    rows += [(1000 + i, rows[2][1]) for i in range(3)]  # copies
    rows += [(2000, sentence(rng, 20) + " " + " ".join(f"leak{i}" for i in range(14)))]
    rows += [(2001, f"{sentence(rng, 30)} that.92@mail2.example.com {sentence(rng, 5)}"), (2002, None), (2003, ""), (2004, sentence(rng, 4000))]
    d = str(tmp_path_factory.mktemp("pipe"))
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([("b1", " ".join(f"leak{i}" for i in range(14)))], "item_id string, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, dict(rows), dict(labels)


def test_pipeline_stages_take_effect(spark, pipeline_dir):
    import corpus_pipeline as cp

    d, rows, labels = pipeline_dir
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_copies", "decontamination", "pii", "packing"]
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    kept = []
    for n, f in cp.STAGES[:-1]:
        docs = cp.stored(f(spark, docs, d), n)
        assert docs.columns == columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
    toxic = {i for i, t in labels.items() if t}
    assert not {*kept[0]} & {i for i in toxic if rows[i].count("zorgle") > 1}
    assert {2000, 2001, 2002, 2003, 2004} <= {*kept[0]} and {i for i, t in labels.items() if not t} <= {*kept[0]}
    copies = [i for i in rows if rows[i] == rows[2] and i in kept[0]]
    assert [i for i in copies if i in kept[1]] == [min(copies)] if copies else True
    assert {*kept[0]} - {*kept[1]} == {*copies[1:]}
    assert {*kept[1]} - {*kept[2]} == {2000}
    assert {*kept[3]} == {*kept[2]} and "mail2.example.com" not in kept[3][2001] and kept[3][2002] is None
    packed = cp.run(spark, d).collect()
    assert {r.doc_id for r in packed} == {*kept[3]}
    tok = Tokenizer.from_file(PATH)
    for i, t in list(kept[3].items())[:50]:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        own = sorted((r.start, r.length, r.ids_crc32) for r in packed if r.doc_id == i)
        assert own == [(k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())) for k in range(0, len(ids), 2048)]


def test_pipeline_on_empty_documents(spark, pipeline_dir, tmp_path):
    import shutil

    import corpus_pipeline as cp

    d, _, _ = pipeline_dir
    for t in ("labels", "benchmark"):
        shutil.copytree(f"{d}/{t}.parquet", f"{tmp_path}/{t}.parquet")
    spark.read.parquet(f"{d}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
    assert SCHEMA
