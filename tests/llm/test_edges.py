"""Long words, ids that are null or shared in number, and columns with the operators' own names."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paddock.llm import anchors, decontaminate, jaccard, packing, suffixes
from paddock.llm.common import free_name

from .cases import frame, sentence, texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_a_word_of_over_a_million_ids(spark):
    digits = "1234567" * 157_143  # one word, one id a digit
    rows = [(1, digits), (2, f"some words {digits[:40]} and {digits[:7]}"), (3, "plain")]
    ids = {d: Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids + [0] for d, t in rows}
    assert len(ids[1]) > 1 << 20
    got = packing.pack(frame(spark, rows), PATH, 2048).collect()
    assert {d: sum(r.length for r in got if r.doc_id == d) for d in ids} == {d: len(x) for d, x in ids.items()}
    for r in got:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(part) == r.ids_crc32


def near_copies(n):
    rng = random.Random(9)
    base = sentence(rng, 120).split(" ")
    return [" ".join(base[:100] + [f"x{i}"] + base[100:]) for i in range(n)]


def test_texts_without_ids_meet_their_family_once(spark, monkeypatch):
    rows = [(None, t) for t in near_copies(150)] + [(7, t) for t in near_copies(300)[150:]]
    joined = []
    member_texts = jaccard.member_texts
    monkeypatch.setattr(jaccard, "member_texts", lambda d, f: joined.append(member_texts(d, f)) or joined[-1])
    got = jaccard.join(frame(spark, rows), 3, 80).collect()
    assert {r.component_id for r in got} == {7} and len(got) == 300
    assert joined[0].count() == 300  # a row a text, not one for each pair


def test_columns_named_as_the_operators_name_theirs(spark):
    rows = texts()
    own = ["_row", "_stays", "_k", "_gone", "row_key", "stays", "hit_key", "gone", "row", "n", "rows", "component", "r"]
    df = frame(spark, rows).withColumns({c: F.concat(F.lit(c), F.col("n_chars")) for c in own})
    items = spark.createDataFrame([("1", " ".join(rows[20][1].split("\n")[1].split(" ")[5:30]))], "item_id string, text string")
    plain = frame(spark, rows)
    for f in (lambda d: jaccard.keep_one_row(d), lambda d: jaccard.keep_one(d), lambda d: decontaminate.remove_contaminated(d, items)):
        out = f(df)
        assert out.columns == df.columns
        got = sorted(map(tuple, out.collect()), key=repr)
        assert all(r[out.columns.index(c)] == f"{c}{r[4]}" for r in got for c in own)
        assert [r[: len(plain.columns)] for r in got] == sorted(map(tuple, f(plain).collect()), key=repr)


def test_free_name(spark):
    df = spark.createDataFrame([], "A int, a_ int")
    assert free_name(df, "a") == "a__" and free_name(df, "b") == "b"


def alike(passage):
    """Two different texts, one with the passage, whose CRC-32 agree in 20 bits."""
    seen = {}
    for i in range(100_000):
        for own in (True, False):
            t = f"start{i} of it " + (passage if own else "another text ") + f" end{i}"
            tag = zlib.crc32(t.encode()) & 0xFFFFF
            other = seen.setdefault((tag, own), t)
            if (tag, not own) in seen:
                return (other, seen[tag, not own]) if own else (seen[tag, not own], other)
    raise AssertionError


def test_texts_without_ids_whose_checksums_agree(spark):
    passage = sentence(random.Random(1), 40)
    with_it, without = alike(passage)
    rows = [(None, without), (None, with_it), (7, f"here {passage} there")]
    got = {(r.doc_id, r.n_words): r.n_removed for r in anchors.remove_repeats(frame(spark, rows), 35).collect()}
    assert got == {(None, len(without.split())): 0, (None, len(with_it.split())): 40, (7, 42): 40}
    got = {(r.doc_id, r.n_bytes): r.n_removed for r in suffixes.remove_repeats(frame(spark, rows), 100).collect()}
    assert got == {(None, len(without.encode())): 0, (None, len(with_it.encode())): 0, (7, len(rows[2][1].encode())): len(f" {passage} ".encode())}


def test_many_rows_without_an_id(spark):
    """Two thousand texts under no id, a passage in three of them and in one with an id."""
    passage = sentence(random.Random(2), 50)
    rows = [(None, f"row {i} " + (passage if i % 700 == 5 else "plain text")) for i in range(2000)] + [(3, passage), (3, "short")]
    got = anchors.remove_repeats(frame(spark, rows), 35).collect()
    assert len(got) == 2002 and sorted(r.n_removed for r in got if r.n_removed) == [50] * 4
    got = suffixes.remove_repeats(frame(spark, rows), 100).collect()
    assert len(got) == 2002 and sum(r.n_removed > 0 for r in got) == 3
    assert [r.n_removed for r in got if r.doc_id == 3 and r.n_bytes > 10] == [len(passage.encode())]
