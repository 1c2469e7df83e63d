"""Benchmark passages in a corpus by a positional inverted index.

Everything is DataFrame and SQL functions. Benchmark items become windows of
consecutive words. The corpus is read once for the document counts of the
benchmark's terms; windows with a term the corpus lacks can't occur. The
index then stores the postings (term, document, position) of each window's
rarest terms, and the lists are intersected from the rarest on, each
shifted by the term's offset in the window. What is left is compared word
for word in its document.

With ``slop`` the lists of the rarer terms may be off by so many places;
such proximity matches are reported beside the exact ones.

The windows, bounded by the benchmark, are broadcast only when they number
at most ``BROADCAST_WINDOWS``; larger ones are joined by shuffles.

Null and empty texts have no words. A repeated row gets the result of its
twin, rows that share an id but not a text are documents of their own; null
ids are kept; an empty corpus gives no rows, an empty benchmark no hits.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored, text_table

#: fixed value: what separates words, after A-Z are folded: ASCII but digits and letters
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAREST = 3
#: rows of at most some 300 bytes each
BROADCAST_WINDOWS = 200_000


def words_of(text: str) -> Column:
    folded = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(folded, SEPARATORS), "")


def windows_of(benchmark: DataFrame, size: int) -> DataFrame:
    """(wid, item_id, win): every ``size`` consecutive words of an item, or the
    whole item if it is shorter; items without words have none."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.select("item_id", words_of("text").alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    wins = items.select("item_id", "words", F.explode(starts).alias("s")).select("item_id", F.slice("words", F.col("s"), F.lit(size)).alias("win"))
    return wins.withColumn("wid", F.xxhash64("win")).distinct()


def _sized(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def keyed(docs: DataFrame) -> DataFrame:
    return text_table(docs).withColumn("k", F.xxhash64("doc_id", "text"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(k, pos, term) of the given terms in every document."""
    tokens = keyed(docs).select("k", F.posexplode(words_of("text")).alias("pos", "term"))
    return tokens.join(terms, "term", "left_semi")


def candidates(docs: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """(k, start, wid, win, near): places where the rarest terms of a window
    stand at their offsets; near: some stand within ``slop`` places only."""
    distinct = stored(windows.groupBy("wid").agg(F.first("win").alias("win")), "windows")
    small = distinct.count() <= BROADCAST_WINDOWS
    terms = distinct.select("wid", F.posexplode("win").alias("offset", "term"))
    vocabulary = _sized(terms.select("term").distinct(), small)
    tokens = docs.select(F.explode(words_of("text")).alias("term"))
    counts = stored(tokens.join(vocabulary, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n")), "term-counts")
    known = terms.join(_sized(counts, small), "term", "left").select("wid", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term").alias("t"))
    # at most as many terms as a window has words
    ranked = known.groupBy("wid").agg(F.array_sort(F.collect_list("t")).alias("t")).where(F.col("t")[0]["n"] > 0)
    picks = [F.coalesce(F.get("t", F.lit(i)), F.col("t")[0]) for i in range(RAREST)]
    chosen = ranked.select("wid", *(p["offset"].alias(f"o{i}") for i, p in enumerate(picks)), *(p["term"].alias(f"t{i}") for i, p in enumerate(picks)))
    chosen = stored(chosen.join(distinct, "wid"), "window-terms")
    wanted = chosen.select(F.explode(F.array(*(f"t{i}" for i in range(RAREST)))).alias("term")).distinct()
    index = stored(postings(docs, _sized(wanted, small)).distinct(), "postings")
    found = index.withColumnRenamed("term", "t0").join(_sized(chosen, small), "t0")
    found = found.withColumn("start", F.col("pos") - F.col("o0")).where("start >= 0").drop("pos", "t0").withColumn("near", F.lit(False))
    for i in range(1, RAREST):
        shift = F.explode(F.sequence(F.lit(-slop), F.lit(slop))) if slop else F.lit(0)
        found = found.withColumn("shift", shift).withColumn("pos", F.col("start") + F.col(f"o{i}") + F.col("shift")).withColumn("term", F.col(f"t{i}"))
        found = found.join(index, ["k", "pos", "term"]).withColumn("near", F.col("near") | (F.col("shift") != 0)).drop("pos", "term", "shift")
    return found.select("k", F.col("start").cast("int").alias("start"), "wid", "win", "near").distinct()


HITS = """aggregate(array_sort(exact), named_struct('e', 0, 'n', 0L),
  (a, x) -> named_struct('e', greatest(a.e, x.start + x.len), 'n', a.n + greatest(0, x.start + x.len - greatest(a.e, x.start))),
  a -> a.n)"""


def find(docs: DataFrame, benchmark: DataFrame, size: int = 10, slop: int = 0) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside exact
    matches), items (ids with exact matches, sorted), near_items (ids with
    proximity matches only; none without ``slop``), exact (start, len, wid)."""
    windows = stored(windows_of(benchmark, size), "benchmark")
    places = candidates(docs, windows, slop).groupBy("k").agg(F.collect_list(F.struct("start", F.size("win").alias("len"), "wid", "win")).alias("at"))
    read = keyed(docs).hint("merge").join(places, "k", "left")  # texts are shuffled at every size
    read = read.withColumn("words", words_of("text"))
    empty = "array()"
    matched = read.select("doc_id", "k", F.size("words").cast("long").alias("n_words"), F.expr(f"filter(coalesce(at, cast({empty} as array<struct<start:int,len:int,wid:bigint,win:array<string>>>)), c -> slice(words, c.start + 1, c.len) = c.win)").alias("exact"), "at")
    matched = matched.withColumn("exact", F.expr("array_distinct(transform(exact, c -> named_struct('start', c.start, 'len', c.len, 'wid', c.wid)))"))
    matched = matched.withColumn("seen", F.expr("array_distinct(transform(at, c -> c.wid))")).drop("at")
    matched = stored(matched, "matches")
    items = windows.select("wid", "item_id")
    ids = lambda col, name: matched.where(F.size(col) > 0).select("k", F.explode(F.array_distinct(col)).alias("wid")).join(items, "wid").groupBy("k").agg(F.array_sort(F.collect_set("item_id")).alias(name))
    out = matched.withColumn("n_hit", F.expr(HITS)).join(ids(F.col("exact.wid"), "items"), "k", "left")
    none = F.expr("cast(array() as array<string>)")
    out = out.withColumn("items", F.coalesce("items", none))
    if slop:
        out = out.join(ids(F.col("seen"), "any_items"), "k", "left").withColumn("near_items", F.array_except(F.coalesce("any_items", none), "items"))
    else:
        out = out.withColumn("near_items", none)
    return out.select("doc_id", "n_words", "n_hit", "items", "near_items", "exact", "k")


def report(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find(docs, benchmark, size)
    joined = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), joined.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, without any benchmark window."""
    name = free_name(docs, "hit_key")
    hit = find(docs, benchmark, size).where("n_hit > 0").select(F.col("k").alias(name)).distinct()
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.join(hit.hint("merge"), key == F.col(name), "left_anti")
