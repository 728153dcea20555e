"""Quality classifier (operator 9): which of two zstandard dictionaries makes a text smaller.

One dictionary is built from good and one from bad labelled text. A text is cut into windows and
each is compressed with either; the difference of the two total sizes over the larger one says
which kind the text resembles. A logistic regression on labelled documents that built no dictionary
turns it into a probability. It also sees the compressed share of the text, the difference over
only the windows that look bad, and the share of windows that are almost pure repetition, so a
text of one repeated word and a good text with a bad part are told apart.

Bounds (parameters): ``per_class`` labelled documents a class are used, two thirds for the
dictionaries (at most ``WINDOWS`` windows of each, spread evenly over the text) and one third, with
whole texts, for the calibration. Every text is scored whole.

Cases: a NULL or empty text gets the share of good labels. Without labels of both classes every
text gets that share, or 0.5 without any. Rows that share a doc_id are scored one by one;
for learning, the smallest of their texts counts. An empty table gives an empty result. A column with
the name of the score is replaced; no other name clashes. There are no ties: a score depends on its
text alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fit_logistic, held_out, labelled_sample, sigmoid, table

WINDOW = 1024                                               # bytes
WINDOWS = 32                                                # of one document in a dictionary
DICT_BYTES = 112 << 10
LEVEL = 3
ROWS = 256                                                  # texts scored at once
FEATURES = 4


def _dictionary(texts: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICT_BYTES, texts).as_bytes()
    except zstandard.ZstdError:                             # too little text to train on
        return b"".join(texts)[-DICT_BYTES:]


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(data)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    beta: np.ndarray | None
    prior: float

    def features(self, texts: list[bytes]) -> np.ndarray:
        """One row per non-empty text: difference, log share, bad windows, repetition."""
        a, b = _compressor(self.good), _compressor(self.bad)
        out = np.zeros((len(texts), FEATURES))
        for i, t in enumerate(texts):
            cuts = [t[j:j + WINDOW] for j in range(0, len(t), WINDOW)]
            n = np.array([len(c) for c in cuts], float)
            x = np.array([len(a.compress(c)) for c in cuts], float)
            y = np.array([len(b.compress(c)) for c in cuts], float)
            d = (x - y) / np.maximum(x, y)
            total = n.sum()
            out[i] = ((x.sum() - y.sum()) / max(x.sum(), y.sum()), np.log(y.sum() / total),
                      (np.maximum(d, 0) * n).sum() / total,
                      (np.maximum(0.25 - y / n, 0) * n).sum() / total)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        full = [i for i, t in enumerate(texts) if t]
        if self.beta is not None and full:
            x = self.features([texts[i] for i in full])
            out[full] = sigmoid(self.beta[0] + x @ self.beta[1:])
        return out


def _windows(t: bytes) -> list[bytes]:
    n = -(-len(t) // WINDOW)
    at = range(n) if n <= WINDOWS else np.linspace(0, n - 1, WINDOWS).astype(int)
    return [t[i * WINDOW:(i + 1) * WINDOW] for i in at]


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality",
                per_class: int = 1500) -> QualityModel:
    """Learn from ``labels`` (doc_id, 0/1 label), which must hold no held-out rows."""
    spark = docs.sparkSession
    rows = labels.filter(F.col(label).isin(0, 1))
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label)).alias("good")).first()
    prior = (n["good"] or 0) / n["n"] if n["n"] else 0.5
    sample = labelled_sample(docs, rows, label, per_class).filter(F.octet_length("text") > 0)
    part = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(3))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(k, w) for k, t in zip(b.column("label").to_pylist(), b.column("text").cast(pa.binary()).to_pylist())
                   for w in _windows(t)]
            yield pa.RecordBatch.from_pydict({"label": pa.array([k for k, _ in got], pa.string()),
                                              "cut": pa.array([w for _, w in got], pa.binary())})

    # at most 2 x per_class x WINDOWS x WINDOW bytes
    cuts = sample.filter(part != 0).select("label", "text").mapInArrow(cut, "label string, cut binary").collect()
    cuts = sorted((r["label"], bytes(r["cut"])) for r in cuts)
    good, bad = [c for k, c in cuts if k == "1"], [c for k, c in cuts if k == "0"]
    if not good or not bad:
        return QualityModel(b"", b"", None, prior)
    model = QualityModel(_dictionary(good), _dictionary(bad), None, prior)
    sent = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = sent.value.features(b.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_pydict({"label": b.column("label"), "weight": b.column("weight"),
                                              "x": pa.array(x.tolist(), pa.list_(pa.float64()))})

    rows = sample.filter(part == 0).select("label", "text", "weight").mapInArrow(
        measure, "label string, weight double, x array<double>").collect()  # numbers of at most per_class rows a class
    if len({r["label"] for r in rows}) < 2:
        return model
    rows = sorted((r["label"], r["weight"], tuple(r["x"])) for r in rows)
    x = np.array([r[2] for r in rows])
    mean, sd = x.mean(axis=0), x.std(axis=0) + 1e-9
    beta = fit_logistic((x - mean) / sd, np.array([r[0] == "1" for r in rows], float), np.array([r[1] for r in rows]))
    slope = beta[1:] / sd
    model.beta = np.concatenate(([beta[0] - (slope * mean).sum()], slope))
    return model


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", out: str = "__quality") -> DataFrame:
    """``docs`` with the score of every whole text."""
    docs = docs.drop(out)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                b = whole.slice(lo, ROWS)
                s = sent.value.score(b.column(text).cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_pydict(dict(zip(b.schema.names, b.columns)) | {out: pa.array(s, pa.float64())})

    return docs.mapInArrow(run, docs.select("*").schema.add(out, "double"))


def learnable(labels: DataFrame) -> DataFrame:
    """Labelled rows outside the held-out fold of operator 9 (crc32 of the id mod 4 is 2)."""
    return labels.filter(F.col("doc_id").isNotNull() & ~held_out("doc_id", 4, 2))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 if the score is 0.7 or more)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, learnable(table(spark, sf_dir, "labels").select("doc_id", "quality")))
    out = score_quality(docs, model, out="score").drop("text")
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))
