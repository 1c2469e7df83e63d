"""Filter interaction audit: what each of five filters removes alone, in each
order, and again.

A row that fails filters A to D says so itself. E fails a text that stands
under a smaller id as well: an existential self-join (left semi) on the
text's hash, the exact text and a smaller doc_id marks it. The other side of
that join is one row a text, its smallest id, as one witness is enough; hashes
that stand once don't reach the join, and the rows of a hot hash are dealt to
as many parts as its count asks for, each with its own copy of the witness.
The failures are united with the others by id and added up to bit
combinations; orders and steps are worked out from those (32 a part at most).

Null text counts as empty, null source as the empty part; a row without an
id is no witness and never fails E; repeated rows are rows of their own, and
rows under one id are judged by their own texts; several labels of an id count
as toxic or good if any says so; an empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

FILTERS = "ABCDE"
#: rows of one hash that share a part of the self-join
GROUP = 1000


def failures(text: Column) -> Column:
    """Bits of the filters that the text alone decides: A 1, B 2, C 4, D 8."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    few = F.size(words) < 50
    dull = 100 * F.size(F.array_distinct(words)) < 65 * F.size(words)
    loud = 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text)
    odd = text.rlike(r"[#$%&*|]")
    return sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate((few, dull, loud, odd))), F.lit(0))


def earlier_twins(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, hash, text and more) whose text stands under a smaller doc_id too."""
    known = docs.where("doc_id IS NOT NULL")
    repeated = known.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    repeated = stored(repeated.select("hash", F.ceil(F.col("n") / GROUP).cast("int").alias("parts")), "repeated-hashes")
    # a shuffle at every size, whose hot keys are split as it runs
    held = stored(known.join(repeated.hint("merge"), "hash"), "repeated-texts")
    first = held.groupBy("hash", "text").agg(F.min("doc_id").alias("first"), F.first("parts").alias("parts"))
    slices = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("s")
    witness = first.select(F.col("hash").alias("h"), F.col("text").alias("t"), "first", slices)
    left = held.withColumn("slice", F.pmod(F.xxhash64("doc_id"), "parts").cast("int"))
    same = (F.col("hash") == F.col("h")) & (F.col("slice") == F.col("s")) & (F.col("text") == F.col("t"))
    return left.join(witness.hint("merge"), same & (F.col("first") < F.col("doc_id")), "left_semi").select(docs.columns)


def failed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits, n, good, toxic: rows of each part by the filters they fail."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part, text).withColumn("hash", F.xxhash64("text"))
    base = rows.select("doc_id", "hash", "part", failures(F.col("text")).alias("bits"), F.lit(1).alias("n"))
    twins = earlier_twins(rows).select("doc_id", "hash", "part", F.lit(1 << 4).alias("bits"), F.lit(0).alias("n"))
    each = base.unionByName(twins).groupBy("doc_id", "hash", "part").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    said = labels.select(F.col("doc_id").cast("long").alias("labelled"), "quality", "toxic").where("labelled IS NOT NULL")
    said = said.groupBy("labelled").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # rows without an id are dealt by their hash and match nothing
    meets = (F.col("meet") == F.col("labelled")) & F.col("doc_id").isNotNull()
    each = each.withColumn("meet", F.coalesce("doc_id", "hash")).join(said.hint("merge"), meets, "left")
    share = [F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")]
    return each.groupBy("part", "bits").agg(F.sum("n").alias("n"), *share)


def plan() -> list[dict]:
    """The 600 steps of all orders: order, step, bit of its filter, bits of the filters before."""
    out = []
    for p in permutations(range(len(FILTERS))):
        name = "".join(FILTERS[k] for k in p)
        out += [{"filter_order": name, "step": s + 1, "bit": 1 << k, "before": sum(1 << q for q in p[:s])} for s, k in enumerate(p)]
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step: kept, removed,
    redundant, unique_fails, good_lost, toxic_lost and shapley."""
    steps = F.from_json(F.lit(json.dumps(plan())), "array<struct<filter_order:string,step:int,bit:int,before:int>>")
    each = failed(docs, labels).select("part", "bits", "n", "good", "toxic", F.explode(steps).alias("s")).select("*", "s.*")
    fails, passed = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits").bitwiseAND(F.col("before")) == 0
    removed = fails & passed
    # of the 120 orders, an equal share has each failing filter first among those that fail
    turns = F.when(fails, F.col("n") * F.lit(120) / F.bit_count("bits")).otherwise(0).cast("long")

    def total(c: Column, when: Column, name: str) -> Column:
        return F.sum(F.when(when, c).otherwise(F.lit(0))).cast("long").alias(name)

    return each.groupBy("part", "filter_order", "step").agg(
        total(F.col("n"), passed & ~fails, "kept"),
        total(F.col("n"), removed, "removed"),
        total(F.col("n"), fails & ~passed, "redundant"),
        total(F.col("n"), F.col("bits") == F.col("bit"), "unique_fails"),
        total(F.col("good"), removed, "good_lost"),
        total(F.col("toxic"), removed, "toxic_lost"),
        F.sum(turns).cast("long").alias("shapley"),
    )
