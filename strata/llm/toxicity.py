"""Toxicity (operator 3): weak supervision by many voters, a label model and a linear classifier.

Features of a text are its distinct words (runs of letters, A-Z lower-cased) and word stems (their
first 4, 5 and 6 bytes). Voters are lexicon and pattern rules: the ``voters`` features that the
labels tie most closely to either class, a small fixed lexicon, and patterns of spelling
and address. The given label is one more voter, so a wrong label can be outvoted. Features are counted
over all labelled documents that may be learnt from.

The label model is generative: a hidden class makes each voter fire with a probability of its own.
Expectation maximisation over labelled and unlabelled sample documents estimates these
(accuracies) together with the correlations of the voters within a class; a voter that fires along
with others counts for as much less, so many rules for one cue don't pass for many witnesses.
Its posterior labels train a sparse (L1) logistic regression over the features that sample
documents share. A text's score is that regression's probability, over the whole text.

Bounds (parameters of ``fit_toxicity``): the label model and the classifier learn from ``per_class``
labelled documents a class and as many unlabelled ones. Counts run in Spark; the driver gets the
``most`` features that tell the classes apart best, of those in ``least`` labelled documents or more.

Cases: a NULL or empty text has no features and gets the intercept's probability. Without labels
of both classes every text gets the share of toxic labels (0 without any). Rows that share a
doc_id are scored one by one; each counts as one for mining, and the smallest of their texts for the
sample. An empty table gives
an empty result. A column with the name of the score is replaced; no other name clashes. There are no
ties: a score depends on its text alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .common import hash_sample, held_out, labelled_sample, sigmoid, slices, stored, table
from .shingles import running, span_hash, spans

STEMS = (4, 5, 6)
FEATURES = 2000
VOTERS = 160                                                # mined ones, of either class together
SURE = 3.0                                                  # standard errors from no association
UNLABELLED = 0.3                                            # weight of a row without a label
SHARED = 0.3                                                # correlation from which voters repeat each other
APART = 4                                                   # times fewer rows than due, from so many due, for voters apart
LEAST = 4                                                   # labelled documents with a feature
PENALTY = 1e-5                                              # of the classifier's weights
ROUNDS = 12                                                 # of the label model
_LETTER_GAP = np.ones(256, bool)
_LETTER_GAP[65:91] = _LETTER_GAP[97:123] = _LETTER_GAP[128:] = False
#: A general English lexicon of insults and threats.
LEXICON = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting",
           "dumb", "imbecile", "coward", "filth", "vermin", "kill", "hate")
#: Patterns that vote.
PATTERNS = (r"(?i)\byou(?:'re| are)? (?:a|an|such|all|so)\b", r"(?i)\bshut up\b", r"(?i)\bgo (?:away|to hell)\b",
            r"\b\w\*+\w", r"!{3,}", r"(?:\b[A-Z]{4,}\b\W*){4,}")


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(text, feature) index and hash arrays (with repeats), and the number of texts, by slice."""
    for _, _, data, offs in slices(texts):
        s, e, first = spans(data, offs, _LETTER_GAP)
        doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
        sums = running(data)
        docs, found = [doc], [span_hash(sums, s, e)]
        for n in STEMS:
            long = e - s > n
            docs.append(doc[long])
            found.append(span_hash(sums, s[long], s[long] + n) ^ np.uint64(n))
        yield np.concatenate(docs), np.concatenate(found), len(offs) - 1


def word_feature(word: str) -> int:
    _, h, _ = next(features(pa.array([word])))
    return int(h[:1].view(np.int64)[0])


@dataclass
class Lookup:
    """Positions of known feature hashes; a small table rules most others out first."""
    known: np.ndarray                                       # sorted

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.known & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def pairs(self, doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, position) pairs of the known features."""
        near = self.maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)]
        doc, h = doc[near], h[near]
        at = np.minimum(np.searchsorted(self.known, h), max(len(self.known) - 1, 0))
        hit = self.known[at] == h if len(self.known) else np.zeros(len(h), bool)
        both = np.unique(doc[hit] * len(self.known) + at[hit])
        return both // max(len(self.known), 1), both % max(len(self.known), 1)


@dataclass
class ToxicModel:
    lookup: Lookup | None
    weights: np.ndarray
    intercept: float

    def score(self, texts: pa.Array) -> np.ndarray:
        out = []
        for doc, h, n in features(texts):
            z = np.full(n, self.intercept)
            if self.lookup is not None:
                d, at = self.lookup.pairs(doc, h)
                z += np.bincount(d, self.weights[at], minlength=n)
            out.append(sigmoid(z))
        return np.concatenate(out) if out else np.zeros(0)


def label_model(votes: np.ndarray, gold: np.ndarray, prior: float) -> np.ndarray:
    """Posterior probability of class 1 for each row.

    ``votes``: rows x voters, 1 where a voter fires. ``gold``: 1, 0 or -1 (no label) by row.
    That a voter does not fire speaks against its cue, except where one fires with which it hardly
    ever does in either class (a cue of another language): there it abstains.
    """
    known = gold >= 0
    if known.any():
        q = np.where(gold == 1, 0.95, np.where(gold == 0, 0.05, prior))
    else:
        fired = votes.mean(axis=1)
        q = np.clip(prior + fired - fired.mean(), 0.05, 0.95)
    trusted = np.array([0.95, 0.95])                        # P(label = class) for class 0, 1
    v = votes.astype(np.float64)
    weigh = np.where(known, 1.0, UNLABELLED)
    for _ in range(ROUNDS):
        rates, spread, met, due = [], *np.zeros((3, v.shape[1], v.shape[1]))
        for side in ((1 - q) * weigh, q * weigh):
            total = side.sum() + 1.0
            rate = (side @ v + 0.02) / (total + 0.04)
            centred = v - rate
            cov = (centred * side[:, None]).T @ centred / total
            sd = np.sqrt(rate * (1 - rate))
            spread += cov / np.outer(sd, sd) / 2
            met += (v * side[:, None]).T @ v
            due += total * np.outer(rate, rate)
            rates.append(rate)
        shared = np.maximum((spread - SHARED) / (1 - SHARED), 0.0)
        np.fill_diagonal(shared, 1.0)
        trust = 1.0 / shared.sum(axis=1)                    # a voter's own part of what it says
        p0, p1 = rates
        fire, rest = np.log(p1 / p0), np.log((1 - p1) / (1 - p0))
        apart = (due >= APART) & (met < due / APART)
        quiet = (1 - v) * (v @ apart == 0)
        z = np.log(prior / (1 - prior)) + v @ (trust * fire) + quiet @ (trust * rest)
        t0, t1 = trusted
        z = z + np.where(gold == 1, np.log(t1 / (1 - t0)), np.where(gold == 0, np.log((1 - t1) / t0), 0.0))
        q = sigmoid(z)
        if known.any():
            for side, c in ((q, 1), (1 - q, 0)):
                trusted[c] = np.clip((side[known] @ (gold[known] == c) + 9.5) / (side[known].sum() + 10), 0.6, 0.995)
    return q


def sparse_logistic(x: np.ndarray, q: np.ndarray, w: np.ndarray, penalty: float, steps: int = 500) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L1 logistic regression on soft labels (accelerated proximal steps)."""
    w = (w / w.sum()).astype(np.float32)
    q = q.astype(np.float32)
    z = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)  # the last weight is the intercept
    top = np.ones(z.shape[1], np.float32)
    for _ in range(30):                                     # largest curvature, by power iteration
        top = z.T @ (w * (z @ (top / np.linalg.norm(top))))
    size = 0.25 * 1.02 * float(np.linalg.norm(top))
    shrink = np.full(z.shape[1], penalty / size, np.float32)
    shrink[-1] = 0
    share = float(np.clip(w @ q, 1e-6, 1 - 1e-6))
    beta = np.zeros(z.shape[1], np.float32)
    beta[-1] = np.log(share / (1 - share))
    ahead, t = beta, 1.0
    for _ in range(steps):
        new = ahead - z.T @ (w * (sigmoid(z @ ahead) - q)) / np.float32(size)
        new = np.sign(new) * np.maximum(np.abs(new) - shrink, 0)
        if (ahead - new) @ (new - beta) > 0:                # the momentum points uphill: start it anew
            t = 1.0
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + np.float32((t - 1) / t_next) * (new - beta)
        done = np.abs(new - beta).max() < 1e-4
        beta, t = new, t_next
        if done:
            break
    return beta[:-1].astype(np.float64), float(beta[-1])


def _mine(texts: DataFrame, most: int, least: int, tested: Observation | None = None) -> list[tuple[int, float]]:
    """(feature, z) of the features that tell the classes of labelled (label, text) rows apart best:
    z is the signed root of the log-likelihood ratio of class and feature. ``tested`` gets their number ``n``."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label = np.array(b.column("label").to_pylist()) == "1"
            at = 0
            for doc, h, n in features(b.column("text")):
                both = np.unique(np.stack([h, doc.astype(np.uint64)]), axis=1) if len(h) else np.zeros((2, 0), np.uint64)
                feature, count = np.unique(both[0], return_counts=True)
                toxic = np.add.reduceat(label[at + both[1].astype(np.int64)].astype(np.int64),
                                        np.concatenate(([0], np.cumsum(count)[:-1]))) if len(count) else count
                yield pa.RecordBatch.from_pydict({"feature": feature.view(np.int64), "n": count, "toxic": toxic})
                at += n

    total = texts.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == "1").alias("t")).first()
    t, c = float(total["t"]), float(total["n"] - total["t"])
    n, a, b = F.col("n"), F.col("toxic"), F.col("n") - F.col("toxic")

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.ln(seen / expected)).otherwise(0.0)

    with_it, without = n / (t + c), (t + c - n) / (t + c)
    # the log-likelihood ratio: a standard error of the odds would rank words that one class never has low
    ratio = 2 * (part(a, with_it * t) + part(b, with_it * c) + part(t - a, without * t) + part(c - b, without * c))
    z = F.signum(a - with_it * t) * F.sqrt(F.greatest(ratio, F.lit(0.0)))
    rows = (texts.select("label", "text").mapInArrow(emit, "feature long, n long, toxic long")
            .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
            .filter(F.col("n") >= least).select("feature", z.alias("z")).observe(tested or Observation(), F.count(F.lit(1)).alias("n"))
            .orderBy(F.abs("z").desc(), "feature").limit(most).collect())
    return [(r["feature"], r["z"]) for r in rows]


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 2500, most: int = FEATURES,
                 voters: int = VOTERS, least: int = LEAST) -> ToxicModel:
    """Learn from (doc_id, text) and from ``labels``, which must hold no held-out rows."""
    spark = docs.sparkSession
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("t")).first()
    share = (n["t"] or 0) / n["n"] if n["n"] else 0.0
    if not 0 < share < 1:
        return ToxicModel(None, np.zeros(0), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    sample = labelled_sample(docs, rows, label, per_class)
    given = rows.select("doc_id", F.col(label).cast("string").alias("label")).distinct()
    # labels grow with the documents: one merge join at every size
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(given.hint("merge"), "doc_id")
    tested = Observation()
    mined = _mine(texts, most, least, tested)
    # of so many features some stand out by chance
    sure = math.sqrt(SURE**2 + 2 * math.log(max(tested.get["n"], 1) if mined else 1))
    known = np.unique(np.array([f for f, _ in mined] + [word_feature(w) for w in LEXICON], np.int64).view(np.uint64))
    lookup = Lookup(known)
    place = {int(f): i for i, f in enumerate(known.view(np.int64))}
    best = [m for m in sorted(mined, key=lambda m: (-abs(m[1]), m[0]))[:voters] if abs(m[1]) >= sure]
    voting = sorted({place[f] for f, _ in best} | {place[word_feature(w)] for w in LEXICON})
    sent = spark.sparkContext.broadcast(lookup)
    patterns = [re.compile(p) for p in PATTERNS]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got: list[list[int]] = []
            for doc, h, n in features(b.column("text")):
                own: list[list[int]] = [[] for _ in range(n)]
                for d, at in zip(*sent.value.pairs(doc, h)):
                    own[d].append(int(at))
                got += own
            hits = [[i for i, p in enumerate(patterns) if p.search(t or "")] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id").cast(pa.string()), "label": b.column("label"), "weight": b.column("weight"),
                "found": pa.array(got, pa.list_(pa.int32())), "hits": pa.array(hits, pa.list_(pa.int32()))})

    plain = hash_sample(docs.select("doc_id").filter(F.col("doc_id").isNotNull()), "doc_id", 2 * per_class).distinct()
    plain = plain.join(labels.select("doc_id").distinct(), "doc_id", "left_anti")
    unlabelled = stored(docs.select("doc_id", "text").join(F.broadcast(plain), "doc_id").select(
        "doc_id", F.lit(None).cast("string").alias("label"), "text", F.lit(0.0).alias("weight")))
    # at most 4 x per_class rows of at most ``most`` numbers
    found = (sample.select("doc_id", "label", "text", "weight").unionByName(unlabelled)
             .mapInArrow(measure, "doc_id string, label string, weight double, found array<int>, hits array<int>").collect())
    found.sort(key=lambda r: (r["label"] or "", r["doc_id"], r["found"], r["hits"]))
    x = np.zeros((len(found), len(known)), np.float32)
    hits = np.zeros((len(found), len(patterns)), np.float32)
    for i, r in enumerate(found):
        x[i, r["found"]] = 1
        hits[i, r["hits"]] = 1
    gold = np.array([-1 if r["label"] is None else int(r["label"]) for r in found])
    q = label_model(np.concatenate([x[:, voting], hits], axis=1), gold, float(np.clip(share, 0.01, 0.99)))
    # unlabelled rows teach with the weight of one row; labelled ones stand for the rows they were drawn from
    w = np.array([r["weight"] or 1.0 for r in found])
    beta, intercept = sparse_logistic(x, q, w, penalty=PENALTY)
    used = np.flatnonzero(beta)
    return ToxicModel(Lookup(known[used]), beta[used].astype(np.float64), intercept)


def score_toxicity(docs: DataFrame, model: ToxicModel, text: str = "text", out: str = "__toxicity") -> DataFrame:
    """``docs`` with the score of every whole text."""
    docs = docs.drop(out)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict(dict(zip(b.schema.names, b.columns))
                                             | {out: pa.array(sent.value.score(b.column(text)), pa.float64())})

    return docs.mapInArrow(run, docs.select("*").schema.add(out, "double"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 if the score is 0.5 or more)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = fit_toxicity(docs, labels.filter(F.col("doc_id").isNotNull() & ~held_out("doc_id", 5, 0)))
    out = score_toxicity(docs, model, out="score").drop("text")
    return out.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
