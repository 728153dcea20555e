"""Language ID (operator 8): nearest centroid of TF-IDF n-gram vectors, with rejection.

A text is lower-cased, everything in ASCII but letters becomes a space, and its byte trigrams are
counted in ``DIMS`` hashed dimensions. The vector is the square root of the counts times the
inverse document frequency, scaled to length 1. Document frequencies come from all documents that
may be learnt from, in one pass. Each language has up to ``CLUSTERS`` centroids, found by spherical
k-means (seeded by k-means++) over a bounded sample of its documents (``per_lang``, a parameter) in
one task a language. A cluster with less than ``LEAST_SHARE`` of the sample, or with one document, is
given up and the largest one split in its place, so an outlier never becomes a centroid.
A text gets the language of the centroid with the highest cosine; its score is the softmax share
of that language's best cosine among all languages' best ones.

Rejection: every fourth document of the sample builds no centroid. Each centroid's reach is the
distance (1 - cosine) that 99 % of these documents nearest to it stay under (of all of them in the
language, where fewer than ``LEAST_NEAR`` are its own). A text is marked ``rejected`` if it lies
farther from its nearest centroid than ``slack`` times the reach, or than halfway from the reach to
distance 1, at which nothing is shared; so every centroid can reject. The operator's ``lang`` is then "und" if ``reject`` is set; the query keeps the nearest language and
shows the mark, since its contract asks for a learnt language wherever there is a letter.

Cases: a NULL text and a text without a letter are "und" with score 0. Ties go to the language
first by code point. Without any learnt language, as from an empty table, every text is "und"; an
empty table to predict gives an empty result. Rows that share a doc_id are predicted one by one; for
learning, the smallest of their texts counts. Every text is read whole. Columns named __lang, __score
or __rejected are replaced; no other name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, slices, table

DIMS = 8192
CLUSTERS = 4
ROUNDS = 8                                                  # of k-means
ROWS = 256                                                  # rows counted at once
SHARP = 30.0                                                # of the softmax over cosines
SLACK = 1.5
LEAST_SHARE = 0.05                                          # of a language's sample in a cluster
LEAST_NEAR = 10                                             # documents that a reach of its own rests on
UND = "und"
_KEEP = np.full(256, 32, np.uint32)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def counts(texts: pa.Array) -> Iterator[np.ndarray]:
    """Trigram counts, one row per text, for runs of at most ROWS texts."""
    lower = pc.utf8_lower(texts.cast(pa.large_string()))
    for at in range(0, len(lower), ROWS):
        for _, _, data, offs in slices(lower.slice(at, ROWS)):
            n = len(offs) - 1
            # two spaces after each text, so no trigram joins two texts
            doc = np.repeat(np.arange(n), np.diff(offs) + 2)
            c = np.full(len(doc), 32, np.uint32)
            c[np.arange(len(data)) + 2 * np.repeat(np.arange(n), np.diff(offs))] = _KEEP[data]
            if len(c) < 3:
                yield np.zeros((n, DIMS))
                continue
            h = (c[:-2] * np.uint32(0x01000193) + c[1:-1]) * np.uint32(0x01000193) + c[2:]
            h = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - DIMS.bit_length() + 1)
            real = (c[:-2] != 32) | (c[1:-1] != 32)         # a run of spaces says nothing
            inside = doc[:-2] == doc[2:]
            keep = real & inside
            yield np.bincount(doc[:-2][keep] * DIMS + h[keep], minlength=n * DIMS).reshape(n, DIMS)


def vectors(texts: pa.Array, idf: np.ndarray) -> Iterator[np.ndarray]:
    for c in counts(texts):
        v = np.sqrt(c.astype(np.float32)) * idf
        yield v / np.maximum(np.sqrt(np.einsum("ij,ij->i", v, v)), 1e-12)[:, None]


@dataclass
class LangModel:
    langs: list[str]                                        # by code point
    centroids: np.ndarray                                   # one row each
    lang_of: np.ndarray                                     # index of each centroid's language, ascending
    reach: np.ndarray                                       # distance within which its sample lies
    idf: np.ndarray

    def predict(self, texts: pa.Array, slack: float) -> tuple[list[str | None], list[float], list[bool]]:
        names, scores, far = [], [], []
        starts = np.searchsorted(self.lang_of, np.arange(len(self.langs)))
        for v in vectors(texts, self.idf):
            cos = v @ self.centroids.T
            best = np.maximum.reduceat(cos, starts, axis=1)
            top, near = best.argmax(axis=1), cos.argmax(axis=1)
            e = np.exp(SHARP * (best - best.max(axis=1, keepdims=True)))
            names += [self.langs[i] for i in top]
            scores += (1 / e.sum(axis=1)).tolist()
            far += (1 - cos[np.arange(len(v)), near] > np.minimum(slack * self.reach, (1 + self.reach) / 2)[near]).tolist()
        return names, scores, far


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each dimension occurs, and how many documents there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMS + 1, np.int64)
        for b in batches:
            for c in counts(b.column("text")):
                total[:-1] += (c > 0).sum(axis=0)
                total[-1] += len(c)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"dim": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    rows = docs.select("text").mapInArrow(run, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(DIMS + 1, np.int64)
    for r in rows:                                          # DIMS + 1 numbers
        out[r["dim"]] = r["n"]
    return out[:-1], int(out[-1])


def _cluster(x: np.ndarray) -> np.ndarray:
    """Centroids (rows of length 1) of the rows of ``x`` by spherical k-means."""
    rng = np.random.default_rng(len(x))
    start = [int(rng.integers(len(x)))]
    while len(start) < min(CLUSTERS, max(1, len(x) // LEAST_NEAR)):
        far = np.maximum(1 - (x @ x[start].T).max(axis=1), 0) ** 2
        if far.sum() < 1e-9:                                # all rows are alike
            break
        start.append(int(rng.choice(len(x), p=far / far.sum())))
    centre, tries = x[start].copy(), 4 * CLUSTERS
    while True:
        for _ in range(ROUNDS):
            own = (x @ centre.T).argmax(axis=1)
            sums = np.stack([x[own == k].sum(axis=0) if (own == k).any() else centre[k] for k in range(len(centre))])
            centre = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        own = (x @ centre.T).argmax(axis=1)
        size = np.bincount(own, minlength=len(centre))
        if len(centre) == 1 or size.min() >= max(2, LEAST_SHARE * len(x)):
            return centre
        if tries:                                           # split the largest cluster instead of keeping an outlier
            most = np.flatnonzero(own == size.argmax())
            centre[size.argmin()] = x[rng.choice(most, max(1, len(most) // 2), replace=False)].mean(axis=0)
            tries -= 1
        else:
            centre = np.delete(centre, size.argmin(), axis=0)


def fit_langid(docs: DataFrame, per_lang: int = 400) -> LangModel | None:
    """Learn from (doc_id, text, lang) rows, which must hold no held-out ones; None without any."""
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    df, n = document_frequencies(rows)
    if not n:
        return None
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(0.01)
    sample = labelled_sample(rows, rows, "lang", per_lang)

    def centre(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().sort_by("doc_id")
        x = np.concatenate(list(vectors(group.column("text").combine_chunks(), idf)))
        spare = np.arange(len(x)) % 4 == 3 if len(x) >= 8 else np.ones(len(x), bool)  # too few to set some aside
        centres = _cluster(x[~spare] if len(x) >= 8 else x)
        cos = x[spare] @ centres.T
        near, far = cos.argmax(axis=1), 1 - cos.max(axis=1)
        reach = [float(np.quantile(far[near == k] if (near == k).sum() >= LEAST_NEAR else far, 0.99)) for k in range(len(centres))]
        return pa.table({"lang": pa.array([group.column("label")[0].as_py()] * len(centres), pa.string()),
                         "centroid": pa.array(centres.tolist(), pa.list_(pa.float32())),
                         "reach": pa.array(reach, pa.float64())})

    rows = sample.groupBy("label").applyInArrow(centre, "lang string, centroid array<float>, reach double").collect()
    if not rows:                                            # CLUSTERS rows for each language
        return None
    langs = sorted({r["lang"] for r in rows})
    rows.sort(key=lambda r: (r["lang"], r["centroid"]))
    return LangModel(langs, np.array([r["centroid"] for r in rows], np.float32),
                     np.array([langs.index(r["lang"]) for r in rows]), np.array([r["reach"] for r in rows]), idf)


def predict_langs(docs: DataFrame, model: LangModel | None, text: str = "text", slack: float = SLACK,
                  reject: bool = True) -> DataFrame:
    """``docs`` with __lang, __score and __rejected of every whole text."""
    docs = docs.drop("__lang", "__score", "__rejected")
    if model is None:
        return (docs.withColumn("__lang", F.lit(UND)).withColumn("__score", F.lit(0.0))
                .withColumn("__rejected", F.lit(False)))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, far = sent.value.predict(b.column(text), slack)
            yield pa.RecordBatch.from_pydict(dict(zip(b.schema.names, b.columns)) | {
                "__lang": pa.array(lang, pa.string()), "__score": pa.array(score, pa.float64()),
                "__rejected": pa.array(far, pa.bool_())})

    schema = docs.select("*").schema.add("__lang", "string").add("__score", "double").add("__rejected", "boolean")
    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    known = letter & ~F.col("__rejected") if reject else letter
    return (docs.mapInArrow(run, schema).withColumn("__rejected", letter & F.col("__rejected"))
            .withColumn("__lang", F.when(known, F.col("__lang")).otherwise(F.lit(UND)))
            .withColumn("__score", F.when(letter, F.col("__score")).otherwise(F.lit(0.0))))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, rejected."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_langid(docs.filter(F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2)))
    out = predict_langs(docs.select("doc_id", "text"), model, reject=False)
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), F.col("__lang").alias("lang_pred"),
                      F.col("__score").alias("score"), F.col("__rejected").alias("rejected"))
