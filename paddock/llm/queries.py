"""The registered queries of this subpackage: each applies one operator,
with production parameters, to its whole table. ``ORACLE`` has the DuckDB
SQL where SQL can express the result."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import anchors, decontaminate, interaction, jaccard, licences, merkle, packing, pseudonyms, quality, simhash, suffixes, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    """Where the public vocabulary lies; PADDOCK_TOKENIZER overrides it."""
    if own := os.environ.get("PADDOCK_TOKENIZER"):
        return own
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), 2048)


@query
def op10_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive(spark, table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op10_warc_dictionary"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), q AS (
  SELECT page_id, n, sha1(body) AS digest, max(page_id) OVER (PARTITION BY body) AS last FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM q
"""


@query
def op4_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query
def op7_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), 3, 90)


@query
def op5_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.remove_repeats(table(spark, sf_dir, "documents"), 35).drop("kept")


@query
def op3_suffix_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), 100).drop("kept")


@query
def op2_benchmark_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


_WORDS = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
ORACLE["op2_benchmark_index"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)
), m AS (SELECT dw.doc_id, dw.s, dw.n, bw.item_id FROM dw JOIN bw USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


def pseudonym_key() -> bytes:
    """The key of the pseudonyms; PADDOCK_PSEUDONYM_KEY names the real one."""
    return os.environ.get("PADDOCK_PSEUDONYM_KEY", "a key for tests").encode()


@query
def op9_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), pseudonym_key())


@query
def op6_licence_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))

_TOKENS = "list_filter(string_split_regex(%s, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op1_ngram_jaccard"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_TOKENS % _FOLDED} AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + 2), ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS s FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), low AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""

ORACLE["op3_suffix_merge"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
wins AS (
  SELECT doc_id, s, substr(h, 2 * s - 1, 200) AS win
  FROM (SELECT doc_id, h, unnest(generate_series(1, n - 99)) AS s FROM d WHERE n >= 100)
), later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS r FROM wins) WHERE r > 1),
edges AS (SELECT doc_id, s, max(s + 100) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM later),
runs AS (SELECT doc_id, s, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM edges),
spans AS (SELECT doc_id, r, min(s) AS s, max(s) + 100 AS e FROM runs GROUP BY doc_id, r),
marked AS (SELECT doc_id, s, e, lag(e, 1, 1) OVER (PARTITION BY doc_id ORDER BY s) AS from_, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC) AS back FROM spans),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n_removed,
    string_agg(substr(h, 2 * from_ - 1, 2 * (s - from_)) || CASE WHEN back = 1 THEN substr(h, 2 * e - 1) ELSE '' END, '' ORDER BY s) AS body
  FROM marked JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(body, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLE["op5_difference_cover"] = f"""
WITH d AS (SELECT doc_id, {_TOKENS % "coalesce(text, '')"} AS w FROM documents),
wins AS (
  SELECT doc_id, s, array_to_string(list_slice(w, s, s + 34), ' ') AS win
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS s FROM d WHERE len(w) >= 35)
), again AS (SELECT win FROM wins GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 34)) AS p FROM wins SEMI JOIN again USING (win)),
words AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS p, unnest(w) AS word FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS body FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(counts.n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""


@query
def op11_simhash_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), 3, 2)


@query
def op12_merkle_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other row, by its id's CRC-32, has lost the line breaks of its text."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = {"text": F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    return merkle.audit(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], found)


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_FIELD = "CASE WHEN %s IS NULL THEN '-' ELSE octet_length(encode(CAST(%s AS VARCHAR)))::VARCHAR || ':' || CAST(%s AS VARCHAR) END"
_LEAF = " || ".join(_FIELD % (c, c, c) for c in ("doc_id", "source", "lang", "n_chars"))
# CRC-32 by its polynomial: each byte, then eight shifts (-1)
_CRC = """xor(4294967295::BIGINT, list_reduce(
  list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_prepend(ascii(c)::BIGINT, [-1::BIGINT for i in range(8)])))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END))"""
ORACLE["op12_merkle_versions"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, sha256({_LEAF} || {_FIELD % (("text",) * 3)}) AS leaf,
    CASE WHEN {_CRC} % 2 = 0 THEN sha256({_LEAF} || {(_FIELD % (("text",) * 3)).replace("text", "replace(text, chr(10), '')")}) END AS found
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d
), nodes AS (
  SELECT g, 0 AS level, pos, leaf AS h, n FROM leaves
  UNION ALL
  SELECT g, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY g, level, pos // 3, n
), subroots AS (
  SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS level, pos, h, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM upper WHERE n > 1 GROUP BY level, pos // 3, n
), heights AS (SELECT g, max(level) AS height FROM nodes GROUP BY g),
way AS (  -- the levels of each leaf, below its subroot and above
  SELECT l.g, l.pos AS leaf_pos, u.level, l.pos // (3 ** u.level)::BIGINT AS pos FROM leaves l JOIN heights USING (g), LATERAL (SELECT unnest(range(height)) AS level) u
), upper_way AS (
  SELECT s.g, u.level, s.pos // (3 ** u.level)::BIGINT AS pos FROM subroots s, (SELECT unnest(range((SELECT max(level) FROM upper))) AS level) u
), beside AS (
  SELECT way.g, leaf_pos, way.level, coalesce(string_agg(h, '' ORDER BY nodes.pos) FILTER (nodes.pos < way.pos), '') AS l,
    coalesce(string_agg(h, '' ORDER BY nodes.pos) FILTER (nodes.pos > way.pos), '') AS r
  FROM way JOIN nodes ON nodes.g = way.g AND nodes.level = way.level AND nodes.pos // 3 = way.pos // 3 GROUP BY way.g, leaf_pos, way.level
  UNION ALL
  SELECT leaves.g, leaves.pos, height + w.level, coalesce(string_agg(h, '' ORDER BY upper.pos) FILTER (upper.pos < w.pos), ''),
    coalesce(string_agg(h, '' ORDER BY upper.pos) FILTER (upper.pos > w.pos), '')
  FROM leaves JOIN heights USING (g) JOIN upper_way w ON w.g = leaves.g JOIN upper ON upper.level = w.level AND upper.pos // 3 = w.pos // 3
  GROUP BY leaves.g, leaves.pos, height, w.level
), proofs AS (
  SELECT g, leaf_pos, sha256(string_agg(l || r, '' ORDER BY level)) AS proof, list(l ORDER BY level) AS ls, list(r ORDER BY level) AS rs FROM beside GROUP BY g, leaf_pos
), fold AS (
  SELECT leaves.g, pos, 1 AS k, coalesce(found, leaf) AS h, ls, rs FROM leaves LEFT JOIN proofs ON proofs.g = leaves.g AND leaf_pos = pos
  UNION ALL
  SELECT g, pos, k + 1, sha256(ls[k] || h || rs[k]), ls, rs FROM fold WHERE k <= len(ls)
), folded AS (SELECT g, pos, h FROM fold WHERE k > coalesce(len(ls), 0)), root AS (SELECT h FROM upper WHERE n = 1)
SELECT doc_id, leaf, subroots.h AS subroot, root.h AS root, coalesce(proof, sha256('')) AS proof_sha256, folded.h AS folded_root, folded.h = root.h AS verified
FROM leaves JOIN subroots ON subroots.g = leaves.g JOIN folded ON folded.g = leaves.g AND folded.pos = leaves.pos
LEFT JOIN proofs ON proofs.g = leaves.g AND leaf_pos = leaves.pos, root
"""

ORACLE["op13_filter_audit"] = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_TOKENS % "t"} AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
said AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(ws) < 50)::INT + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(least < doc_id, false)::INT AS bits
  FROM w LEFT JOIN said USING (doc_id)
), c AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit,
    list_sum(list_transform(string_split(filter_order[:step], ''), lambda q: 1 << (ascii(q) - 65))) - (1 << (ascii(filter_order[step]) - 65)) AS before
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders)
), r AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (bits & (before + bit)::BIGINT = 0), 0) AS kept,
    coalesce(sum(n) FILTER (bits & before::BIGINT = 0 AND bits & bit <> 0), 0) AS removed,
    coalesce(sum(n) FILTER (bits & before::BIGINT <> 0 AND bits & bit <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (bits = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (bits & before::BIGINT = 0 AND bits & bit <> 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (bits & before::BIGINT = 0 AND bits & bit <> 0), 0) AS toxic_lost
  FROM c, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
"""
