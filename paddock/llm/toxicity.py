"""Toxicity by a weighted finite-state grammar of clauses.

Word classes (insult, threat, target, negation, reported speech) are the
alphabet. Small transducers rewrite the class string of a clause: negation
marks the next hostile words as denied, reported speech those after it as
quoted, a target in the clause marks them as directed. Their composition
is one machine whose last tape carries weights; a clause scores the weight
of its matched path, so a word counts by the clause it stands in. Clauses
add up to a document's evidence, and a logistic curve makes a score of it.

The insult lexicon and its weights are learned: units (whole words and
word beginnings, folded to lower case) that labelled toxic documents hold
far oftener than others. Learning reads at most ``max_train`` labelled
documents (an id-hash sample, the same at every run); labels, language,
source and id are never inputs of a score.

Null and empty text get the score of a text without evidence; rows without
a label are scored but not learned from; repeated rows are scored each; an
empty table gives no rows, and no labels give scores by the seed words only.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FOLD, Words, ship, span_hash, text_chunks, text_table

MAX_TRAIN = 8000
MAX_UNITS = 4000
EVIDENCE = 5
PREFIXES = (3, 4, 5, 6, 7, 8)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: seed words of the classes; insults are learned besides
SEEDS = {
    INSULT: "idiot idiots stupid moron morons imbecile scum loser losers trash pathetic worthless disgusting clown fool dumb ugly",
    THREAT: "kill hurt destroy beat shoot hang burn punch strangle murder",
    TARGET: "you your yours yourself he she they them him her his their tu toi vous du dich ihr sie usted ustedes ti te",
    NEGATION: "not no never isn't aren't wasn't don't doesn't nobody ne pas jamais nicht kein keine nie nunca ni",
    REPORT: "said says wrote writes called calls quoted quote reported claims claimed according dit sagte schrieb dijo",
}

DELIM = np.zeros(256, bool)  # what separates words: ASCII other than letters and the apostrophe
DELIM[[c for c in range(128) if not chr(c).isalpha() and c != 39]] = True
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n()\"|"]] = True


@dataclass
class Transducer:
    """arcs: (state, symbol) -> (state, symbol written); missing: copy, stay."""

    start: int
    arcs: dict[tuple[int, str], tuple[int, str]] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol), (state, symbol))


def negation(reach: int = 3) -> Transducer:
    """After a negation, the next ``reach`` classed words are denied."""
    t = Transducer(0)
    for s in range(reach + 1):
        t.arcs[s, "neg"] = (reach, "neg")
        for x in ("insult", "threat"):
            t.arcs[s, x] = (max(0, s - 1), f"{x}-denied" if s else x)
        for x in ("target", "report"):
            t.arcs[s, x] = (max(0, s - 1), x)
    return t


def reporting() -> Transducer:
    """Hostile words after a verb of speech are quoted."""
    t = Transducer(0)
    for s in (0, 1):
        t.arcs[s, "report"] = (1, "report")
    for x in ("insult", "threat", "insult-denied", "threat-denied"):
        t.arcs[1, x] = (1, f"{x.partition('-')[0]}-quoted")
    return t


def directing() -> Transducer:
    """Plain hostile words are directed once the clause has named a target."""
    t = Transducer(0)
    for s in (0, 1):
        t.arcs[s, "target"] = (1, "target")
    for x in ("insult", "threat"):
        t.arcs[1, x] = (1, f"{x}-directed")
    return t


#: what the composition writes, and what each output adds to a clause
OUTPUTS = {"insult": 1.0, "insult-directed": 1.25, "insult-denied": 0.25, "insult-quoted": 0.4, "threat": 0.1, "threat-directed": 0.5, "threat-denied": 0.02, "threat-quoted": 0.05}
CLASSES = {INSULT: "insult", THREAT: "threat", TARGET: "target", NEGATION: "neg", REPORT: "report"}


class Grammar:
    """The composition of the transducers as one table over the classes."""

    def __init__(self) -> None:
        parts = [negation(), reporting(), directing()]
        start = tuple(p.start for p in parts)
        self.table: dict[tuple[int, int], tuple[int, float]] = {}
        number = {start: 0}
        todo = [start]
        while todo:
            states = todo.pop()
            for k, symbol in CLASSES.items():
                nxt, out = [], symbol
                for part, s in zip(parts, states, strict=True):
                    s2, out = part.step(s, out)
                    nxt.append(s2)
                to = tuple(nxt)
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                self.table[number[states], k] = (number[to], OUTPUTS.get(out, 0.0))

    def clause(self, classes: list[int], weights: list[float]) -> float:
        state, total = 0, 0.0
        for k, w in zip(classes, weights, strict=True):
            state, factor = self.table[state, k]
            total += factor * w
        return total


def fold(buf: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and U+00C0-U+00DE."""
    out = FOLD[buf]
    if len(buf) > 1:
        wide = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)
        out[1:][wide] += 0x20
    return out


def units(w: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, word indexes, hashes): whole words under 0, beginnings of
    so many bytes of longer words under their length."""
    yield 0, np.arange(len(w.h)), w.h
    size = w.ends - w.starts
    for k in PREFIXES:
        at = np.flatnonzero(size > k)
        yield k, at, span_hash(w.prefix, w.starts[at], w.starts[at] + k)


#: toxic and other documents that hold a unit, and that hold it twice or more
COUNTED = ("pos", "neg", "pos2", "neg2")


def _unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, buf, off in text_chunks(batch):
            toxic = batch.column("toxic")[rows].to_numpy(zero_copy_only=False)
            w = Words(fold(buf), off, delim=DELIM)
            for k, at, h in units(w):
                h2, inverse = np.unique(h, return_inverse=True)
                pair, times = np.unique(inverse * len(toxic) + w.row[at], return_counts=True)
                unit, t = pair // len(toxic), toxic[pair % len(toxic)] == 1
                cols = [np.bincount(unit[m], minlength=len(h2)) for m in (t, ~t, t & (times > 1), ~t & (times > 1))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h2), k, np.int32)), pa.array(h2.view(np.int64)), *map(pa.array, cols)], names=["kind", "unit", *COUNTED])


@dataclass
class Model:
    insults: dict[int, tuple[np.ndarray, np.ndarray]]  # unit length -> sorted hashes, weights
    seeds: tuple[np.ndarray, np.ndarray]  # sorted hashes, classes
    beta: np.ndarray


def _seed_table() -> tuple[np.ndarray, np.ndarray]:
    words, classes = zip(*((w, k) for k, ws in SEEDS.items() for w in ws.split()), strict=True)
    raw = [w.encode() for w in words]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    h = Words(np.frombuffer(b"".join(raw), np.uint8), off, delim=DELIM).h
    order = np.argsort(h)
    return h[order], np.array(classes)[order]


def lookup(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index into the sorted table, or -1."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def evidence(buf: np.ndarray, off: np.ndarray, model: Model, grammar: Grammar) -> np.ndarray:
    """Per row: total and largest clause weight, matched clauses, hostile words and their share."""
    n = len(off) - 1
    w = Words(fold(buf), off, delim=DELIM)
    cls = np.zeros(len(w.h), np.int64)
    weight = np.zeros(len(w.h))
    at = lookup(w.h, model.seeds[0])
    cls[at >= 0] = model.seeds[1][at[at >= 0]]
    weight[(cls == INSULT) | (cls == THREAT)] = 1.0
    for k, idx, h in units(w):
        if k not in model.insults:
            continue
        at = lookup(h, model.insults[k][0])
        hit = idx[at >= 0]
        cls[hit] = INSULT
        weight[hit] = np.maximum(weight[hit], model.insults[k][1][at[at >= 0]])
    breaks = np.cumsum(BREAK[buf]) if len(buf) else np.zeros(0, np.int64)
    marked = np.flatnonzero(cls)
    clause = breaks[w.starts[marked]]
    row = w.row[marked]
    out = np.zeros((n, EVIDENCE))
    hostile = (cls[marked] == INSULT) | (cls[marked] == THREAT)
    group = np.cumsum(np.concatenate([[0], (np.diff(clause) != 0) | (np.diff(row) != 0)])) if len(marked) else np.zeros(0, int)
    live = np.zeros(group[-1] + 1 if len(group) else 0, bool)
    live[group[hostile]] = True
    keep = np.flatnonzero(live[group]) if len(group) else np.zeros(0, int)
    for _, part in itertools.groupby(keep.tolist(), key=lambda i: group[i]):
        i = list(part)
        r = row[i[0]]
        v = grammar.clause(cls[marked[i]].tolist(), weight[marked[i]].tolist())
        out[r, 0] += v
        out[r, 1] = max(out[r, 1], v)
        out[r, 2] += v > 0
    out[:, 3] = np.bincount(row[hostile], minlength=n)
    out[:, 4] = out[:, 3] / np.maximum(w.counts(), 1)
    return out


def features(e: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(e)), np.log1p(e[:, 0]), np.minimum(e[:, 1], 4.0), np.log1p(e[:, 2]), e[:, 3] > 0, e[:, 3] > 1, e[:, 3] > 2, np.sqrt(e[:, 4])], 1)


def _evidence(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    grammar = Grammar()
    for batch in batches:
        for rows, buf, off in text_chunks(batch):
            e = evidence(buf, off, model, grammar)
            yield pa.RecordBatch.from_arrays([batch.column("toxic")[rows], *(pa.array(e[:, k]) for k in range(EVIDENCE))], names=["toxic", *(f"e{k}" for k in range(EVIDENCE))])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method with a ridge on all but the constant."""
    beta = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_units: int = MAX_UNITS, min_gain: float = 18.0) -> Model:
    """Lexicon and curve from labelled rows that are not held out."""
    ship(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = max(1, known.count())
    scale = 1 << 20
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < int(scale * min(1.0, max_train / total)))
    # at most about max_train rows of an id and a flag: bounded by the parameter
    train = text_table(docs).join(F.broadcast(sample), "doc_id").select("text", "toxic")
    model = Model({}, _seed_table(), np.array([-3.0, 1.0, 0.5, 0.5, 0.5, 0.5, 0.5, 0.0]))
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sum(v for k, v in sizes.items() if k != 1)
    if not n1 or not n0:
        return model
    counts = train.mapInArrow(_unit_counts, "kind int, unit long, pos long, neg long, pos2 long, neg2 long")
    counts = counts.groupBy("kind", "unit").agg(*(F.sum(c).alias(c) for c in COUNTED))
    base = n1 / (n1 + n0)
    share = lambda p, n: F.when(p + n > 0, p / (p + n)).otherwise(0.0)

    def gain(p, n):
        """Log-likelihood over the base rate, in nats."""
        s = share(p, n)
        return F.when(p > 0, p * F.log(s / base)).otherwise(0.0) + F.when(n > 0, n * F.log((1 - s) / (1 - base))).otherwise(0.0)

    pos, neg, pos2, neg2 = (F.col(c) for c in COUNTED)
    odds = F.log((pos + 0.5) / (n1 + 1)) - F.log((neg + 0.5) / (n0 + 1))
    value = F.greatest(F.when(share(pos, neg) > 0.6, gain(pos, neg)).otherwise(0.0), F.when(share(pos2, neg2) > 0.8, gain(pos2, neg2)).otherwise(0.0))
    chosen = counts.where("pos >= 5").withColumn("odds", odds).withColumn("value", value).where(F.col("value") > min_gain).orderBy(F.desc("value"), "kind", "unit").limit(max_units)
    found: dict[int, dict[int, float]] = {}
    for r in chosen.collect():  # at most max_units rows
        found.setdefault(r["kind"], {})[r["unit"]] = min(max(r["odds"], 0.5) / 4.0, 2.0)
    for k, d in found.items():
        h = np.array(sorted(d), np.int64).view(np.uint64)
        order = np.argsort(h)
        h = h[order]
        model.insults[k] = (h, np.array([d[int(x)] for x in h.view(np.int64)]))
    rows = train.mapInArrow(lambda it: _evidence(it, model), "toxic int, " + ", ".join(f"e{k} double" for k in range(EVIDENCE))).collect()  # about max_train rows
    e = np.array([r[1:] for r in rows], float)
    model.beta = logistic(features(e), np.array([float(r[0] == 1) for r in rows]))
    return model


SCORED = "doc_id long, score double, clauses long"


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    grammar = Grammar()
    for batch in batches:
        for rows, buf, off in text_chunks(batch):
            e = evidence(buf, off, model, grammar)
            p = 1 / (1 + np.exp(-np.clip(features(e) @ model.beta, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")[rows], pa.array(p), pa.array(e[:, 2].astype(np.int64))], names=["doc_id", "score", "clauses"])


def _filter(batches: Iterator[pa.RecordBatch], model: Model, below: float) -> Iterator[pa.RecordBatch]:
    grammar = Grammar()
    for batch in batches:
        for rows, buf, off in text_chunks(batch):
            e = evidence(buf, off, model, grammar)
            p = 1 / (1 + np.exp(-np.clip(features(e) @ model.beta, -30, 30)))
            part = batch.slice(rows.start, rows.stop - rows.start)
            yield part.filter(pa.array(p < below))


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of matched clauses."""
    model = learn(docs, labels, max_train)
    out = text_table(docs).mapInArrow(lambda it: _score(it, model), SCORED)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "clauses")


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold."""
    model = learn(docs, labels, max_train)
    return docs.mapInArrow(lambda it: _filter(it, model, threshold), docs.schema)
