"""Embedding near-dedup (operator 10): cross-polytope hashing with verified candidate pairs.

A hash function turns a vector by three rounds of random signs and a fast Hadamard transform and
takes the axis (with its sign) nearest to the result. ``functions`` such axes name a bucket of one
of ``tables`` hash tables. A vector also enters the buckets that differ from its own by the
second-nearest axis of one function (multiprobe). The number of functions follows the number of
vectors, so that unrelated ones rarely meet; the number of tables follows from the chance, measured
once on random pairs exactly at the threshold, that a pair meets in one table, so that the chance
to meet in some table is at least ``recall``.

Equal vectors are one row from the start, known by a hash. Only those hashes enter the hash tables; the vectors are fetched
for the buckets with two rows or more. A bucket of more than ``BLOCK`` rows is dealt into blocks and
each pair of blocks is a group of its own, so no task holds a large bucket. In a group all cosines
are computed in double precision; a pair counts in the first bucket that both rows share and
nowhere else, so counts are exact without listing pairs, and links leave a group only as a forest
that joins the same rows. Components follow from the forests.

Cases: vectors that are NULL, empty or zero, or hold NULL or non-finite components, link with
nothing, as do vectors of different lengths. Rows that share a vec_id are vectors of their own. A
NULL vec_id links with nothing. Equal cosines need no order: every pair at the threshold or above is a
link. An empty table gives an empty result. Only vec_id and the vector are read, so other columns clash
with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import grouped, stored, table
from .graph import components
from .shingles import mix

COSINE = 0.95
RECALL = 0.9995
BLOCK = 1024                                                # rows of a group's side
ROWS = 1024                                                 # vectors hashed at once
CROWD = 0.2                                                 # unrelated rows in a bucket, about
TRIALS = 2000                                               # random pairs for the chance to meet


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of each row (length a power of two), scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


class CrossPolytope:
    """The hash tables for vectors of ``dim`` components."""

    def __init__(self, dim: int, functions: int, tables: int, seed: int = 7):
        self.width = max(2, 1 << (dim - 1).bit_length())
        self.functions, self.tables = functions, tables
        rng = np.random.default_rng([seed, dim])
        self.signs = rng.choice([-1.0, 1.0], (tables, functions, 3, self.width))

    def axes(self, x: np.ndarray, t: int, f: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest and second-nearest signed axis of every row."""
        wide = np.zeros((len(x), self.width))
        wide[:, :x.shape[1]] = x
        for s in self.signs[t, f]:
            wide = hadamard(wide * s)
        size = np.abs(wide)
        rows = np.arange(len(x))
        best = size.argmax(axis=1)
        size[rows, best] = -1
        second = size.argmax(axis=1)
        return tuple(2 * i + (wide[rows, i] < 0) for i in (best, second))

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Bucket ids, rows x tables x (1 + functions); the first of a table is the vector's own."""
        out = np.empty((len(x), self.tables, 1 + self.functions), np.uint64)
        for t in range(self.tables):
            near = [self.axes(x, t, f) for f in range(self.functions)]
            for p in range(1 + self.functions):
                key = np.full(len(x), (x.shape[1] << 20) + t, np.uint64)
                for f, (best, second) in enumerate(near):
                    key = mix(key ^ (second if p == f + 1 else best).astype(np.uint64))
                out[:, t, p] = key
        return out


def meeting_chance(dim: int, functions: int, cosine: float) -> float:
    """Share of random pairs at exactly ``cosine`` that meet in a hash table."""
    rng = np.random.default_rng(11)
    a, b = rng.standard_normal((2, TRIALS, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
    b = cosine * a + math.sqrt(1 - cosine * cosine) * b
    met = 0.0
    for seed in range(4):
        one = CrossPolytope(dim, functions, 1, seed)
        x, y = one.buckets(a)[:, 0], one.buckets(b)[:, 0]
        met += (x[:, :, None] == y[:, None, :]).any(axis=(1, 2)).mean() / 4
    return float(met)


def plan(rows: int, dim: int, cosine: float, recall: float) -> tuple[int, int]:
    """(functions, tables) for so many vectors of so many components."""
    if dim < 2:
        return 1, 1                                         # two unit vectors: the sign decides
    axes = 2 * max(2, 1 << (dim - 1).bit_length())
    functions = max(1, math.ceil(math.log(max(rows, 2) / CROWD) / math.log(axes)))
    chance = meeting_chance(dim, functions, cosine)
    return functions, max(1, math.ceil(math.log(1 - recall) / math.log(max(1 - chance, 1e-9))))


def _unit(rows: list) -> tuple[np.ndarray, list[bytes | None]]:
    """Which vectors may link, and the bytes of each as doubles of length 1."""
    ok, out = np.zeros(len(rows), bool), []
    for i, r in enumerate(rows):
        v = None
        if r and None not in r:
            x = np.array(r, np.float64)
            top = np.abs(x).max()
            if np.isfinite(top) and top > 0:
                x = x / top                                 # so that squares neither vanish nor overflow
                v = (x / np.sqrt((x * x).sum())).tobytes()
        ok[i] = v is not None
        out.append(v)
    return ok, out


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, vec_id: str = "vec_id",
                 embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, found = _unit(b.column("embedding").to_pylist())
            yield pa.RecordBatch.from_pydict({"vec_id": b.column("vec_id"), "unit": pa.array(found, pa.binary())})

    units = stored(rows.mapInArrow(unit, "vec_id long, unit binary")
                   .withColumn("node", F.when(F.col("vec_id").isNotNull(), F.unhex(F.substring(F.sha2("unit", 256), 1, 32)))))
    classes = stored(units.filter(F.col("node").isNotNull()).groupBy("node")
                     .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit")))
    dims = {r["d"]: r["n"] for r in classes.groupBy((F.octet_length("unit") / 8).cast("int").alias("d"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}   # lengths of vectors: a few numbers
    plans = {d: plan(n, d, cosine, recall) for d, n in dims.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                b = whole.slice(lo, ROWS)
                raw = b.column("unit").to_pylist()
                found: list = [None] * len(raw)
                for d in {len(r) // 8 for r in raw}:
                    at = [i for i, r in enumerate(raw) if len(r) // 8 == d]
                    x = np.frombuffer(b"".join(raw[i] for i in at)).reshape(len(at), d)
                    for i, s in zip(at, CrossPolytope(d, *plans[d]).buckets(x)):
                        found[i] = s.astype(np.uint64).view(np.int64).ravel()
                yield pa.RecordBatch.from_pydict({"node": b.column("node"), "copies": b.column("copies"),
                                                  "unit": b.column("unit"),
                                                  "buckets": pa.array(found, pa.list_(pa.int64()))})

    placed = stored(classes.select("node", "copies", "unit").mapInArrow(
        place, "node binary, copies long, unit binary, buckets array<long>"))
    entries = placed.select("node", F.explode("buckets").alias("bucket")).distinct()
    full = stored(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = (entries.join(full, "bucket").withColumn("blocks", blocks).withColumn("own", own)
           .withColumn("other", other)
           .select("node", "bucket", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    met = met.withColumn("group", F.xxhash64("bucket", "i", "j"))
    held = (met.join(placed, "node").repartition("group").sortWithinPartitions("group", "node")
            .select("group", "bucket", "i", "j", "own", "node", "copies", "unit", "buckets"))
    probes = {d: 1 + f for d, (f, _) in plans.items()}
    found = stored(held.mapInArrow(lambda it: _verify(it, cosine, probes), "a binary, b binary, n long"))
    counts = found.filter(F.col("n") > 0).groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    comps = components(found.filter(F.col("n") == 0), "a", "b")
    linked = stored(classes.select("node", "rep", "copies").join(counts, "node", "left").join(comps, "node", "left")
                    .select("node", "rep", F.coalesce("component", "node").alias("root"),
                            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")))
    heads = stored(linked.groupBy("root").agg(F.min("rep").alias("head")))
    info = stored(linked.join(heads, "root").select("node", "head", "links"))
    out = units.select("vec_id", "node").join(info, "node", "left")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("head", "vec_id").alias("component_id"),
                      F.col("vec_id").eqNullSafe(F.coalesce("head", "vec_id")).alias("kept"))


def _verify(batches: Iterator[pa.RecordBatch], cosine: float, probes: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """For each group: (a, b, 0) links of a forest, and (a, a, n) with n vectors newly linked to a."""
    for g in grouped(batches, "group"):
        g = g.combine_chunks()
        if len(g) < 2:
            continue
        d = len(g.column("unit")[0].as_py()) // 8
        x = np.frombuffer(b"".join(g.column("unit").to_pylist())).reshape(len(g), d)
        s = np.array(g.column("buckets").to_pylist(), np.int64).reshape(len(g), -1, probes[d])
        node, copies, own = g.column("node"), g.column("copies").to_numpy(), g.column("own").to_numpy()
        here, i, j = g.column("bucket")[0].as_py(), g.column("i")[0].as_py(), g.column("j")[0].as_py()
        left, right = (np.flatnonzero(own == k) for k in (i, j))
        a, b = np.nonzero(x[left] @ x[right].T >= cosine)
        a, b = left[a], right[b]
        once = a < b if i == j else np.ones(len(a), bool)
        a, b = a[once], b[once]
        a, b = _first_meeting(a, b, s, here)
        if not len(a):
            continue
        n = np.bincount(a, copies[b], len(g)) + np.bincount(b, copies[a], len(g))
        root = _forest(a, b, len(g))
        some, joined = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(g)))
        yield pa.RecordBatch.from_arrays([
            node.take(pa.array(np.concatenate([some, joined]))).combine_chunks(),
            node.take(pa.array(np.concatenate([some, root[joined]]))).combine_chunks(),
            pa.array(np.concatenate([n[some].astype(np.int64), np.zeros(len(joined), np.int64)]))], ["a", "b", "n"])


def _first_meeting(a: np.ndarray, b: np.ndarray, s: np.ndarray, here: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of rows, those whose first shared bucket (by table, then id) is ``here``."""
    kept_a, kept_b = [], []
    for t in range(s.shape[1]):
        if not len(a):
            break
        same = s[a, t][:, :, None] == s[b, t][:, None, :]
        any_of = same.any(axis=2)
        met = any_of.any(axis=1)
        first = np.where(any_of, s[a, t], np.iinfo(np.int64).max).min(axis=1)
        good = met & (first == here)
        kept_a.append(a[good])
        kept_b.append(b[good])
        a, b = a[~met], b[~met]
    return np.concatenate([*kept_a, a[:0]]), np.concatenate([*kept_b, b[:0]])


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each row the first row that pairs connect it with."""
    root = np.arange(n)
    while True:
        new = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
