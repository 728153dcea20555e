"""Helpers shared by the operators: table access, hash folds, bounded samples, Arrow slices."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import materialize

#: The bytes that count as white space in every operator ([\x20\x09-\x0D]).
SPACE_BYTES = b" \t\n\x0b\x0c\r"
#: Text handled at once by the vectorised byte code; a longer document is handled alone.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back (lineage cut there)."""
    return materialize(df, "table")


def fold(doc_id: str | Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (NULL for a NULL id)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string")) % F.lit(mod)


def held_out(doc_id: str | Column, mod: int, rest: int) -> Column:
    """True where the id falls into the held-out fold; a NULL id is not held out."""
    return F.coalesce(fold(doc_id, mod) == F.lit(rest), F.lit(False))


def bounded_sample(ids: DataFrame, stratum: str, key: str, per_stratum: int) -> DataFrame:
    """At most ``per_stratum`` rows of each stratum, the smallest by a hash of ``key``.

    A count per stratum first gives a hash threshold that lets about twice the wanted rows
    through, so the window that trims to the exact number never sees a whole stratum.
    """
    h = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 40))
    counts = ids.groupBy(F.col(stratum).alias("__stratum")).agg(F.count(F.lit(1)).alias("__n"))
    cut = F.lit(float(1 << 40)) * F.least(F.lit(1.0), (F.lit(2.0 * per_stratum) + 64) / F.col("__n"))
    near = (ids.join(counts, ids[stratum].eqNullSafe(counts["__stratum"]), "left")
            .withColumn("__h", h).filter(F.col("__h") <= cut))
    w = Window.partitionBy(stratum).orderBy("__h", key)
    return (near.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= per_stratum)
            .drop("__stratum", "__n", "__h", "__rn"))


def hash_sample(ids: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, the smallest by a hash of ``key``: a count gives a threshold that
    lets about twice as many through, and those are cut to the exact number."""
    n = ids.count()
    cut = min(1.0, (2.0 * most + 64) / max(n, 1)) * (1 << 40)
    near = ids.withColumn("__h", F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 40))).filter(F.col("__h") <= cut)
    return near.orderBy("__h", key).limit(most).drop("__h")


FILTER_HASHES = 3
FILTER_SLICES = 16


def filter_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The FILTER_HASHES positions of each 64-bit hash in a Bloom filter of ``bits`` (a power of two)."""
    h = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    step = (h ^ (h >> np.uint64(32))) | np.uint64(1)
    i = np.arange(FILTER_HASHES, dtype=np.uint64)
    return ((h[:, None] + i * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def id_filter(ids: DataFrame, key: str, n: int, max_bits: int = 1 << 31) -> tuple[np.ndarray, int]:
    """(packed bits, number of bits) of a Bloom filter over ``n`` long ids.

    Its size is bounded by ``max_bits`` whatever the number of ids, so it may be sent to every
    task; beyond that it only lets more rows through. Tasks fill their own bits, and the bits are
    merged slice by slice.
    """
    bits = min(max_bits, max(1 << 16, 1 << (16 * max(n, 1) - 1).bit_length()))
    part = bits // 8 // FILTER_SLICES

    def rows(found: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i, x in found.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()),
                                              "bits": pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())})

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, seen = np.zeros(bits // 8, np.uint8), False
        for b in batches:
            at = filter_places(b.column(key).to_numpy(zero_copy_only=False).view(np.uint64), bits).ravel()
            np.bitwise_or.at(out, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
            seen = True
        if seen:
            yield from rows({i: out[i * part:(i + 1) * part] for i in range(FILTER_SLICES)})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, z in zip(b.column("slice").to_pylist(), b.column("bits").to_pylist()):
                x = np.frombuffer(zlib.decompress(z), np.uint8)
                held[i] = held[i] | x if i in held else x
        yield from rows(held)

    schema = "slice int, bits binary"
    some = (ids.select(key).mapInArrow(fill, schema)
            .repartition(FILTER_SLICES * 4, F.col("slice"), F.pmod(F.xxhash64("bits"), F.lit(8))).mapInArrow(merge, schema))
    out = np.zeros(bits // 8, np.uint8)
    for r in some.repartition(FILTER_SLICES, "slice").mapInArrow(merge, schema).collect():  # bits / 8 bytes in all
        out[r["slice"] * part:(r["slice"] + 1) * part] = np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return out, bits


def filter_has(packed: np.ndarray, bits: int, ids: np.ndarray) -> np.ndarray:
    at = filter_places(ids.view(np.uint64), bits)
    return ((packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string or binary column; NULL is empty."""
    col = col.cast(pa.large_binary())
    _, offs, data = col.buffers()
    n = len(col)
    o = np.frombuffer(offs, np.int64, n + 1, col.offset * 8) if n else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if col.null_count:                                     # a NULL slot may still span bytes
        return column_bytes(pa.array([x or b"" for x in col.to_pylist()], pa.large_binary()))
    return whole[o[0]:o[-1]], o - o[0]


def slices(col: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``most`` bytes each."""
    data, offs = column_bytes(col)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows with an equal ``key`` from batches sorted by it, across batch borders.

    Only one group is held at a time, so callers bound the size of a group, not of a partition.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(k)]):
            if held and k[lo] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
            last = k[lo]
    if held:
        yield pa.Table.from_batches(held)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label, text, weight) of a bounded, repeatable sample, written to the shared folder.

    ``labels`` holds only rows that may be learnt from. ``weight`` is the number of labelled rows
    that one sampled row stands for, so shares of the whole can be restored.
    """
    ids = labels.select(F.col("doc_id"), F.col(label).cast("string").alias("label")).na.drop().distinct()
    counts = ids.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    chosen = bounded_sample(ids, "label", "doc_id", per_class).join(counts, "label")
    chosen = chosen.withColumn("weight", F.col("n") / F.least(F.col("n"), F.lit(per_class))).drop("n")
    # at most per_class rows for each label, so this side is bounded
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return stored(found.groupBy("doc_id", "label").agg(F.min("text").alias("text"), F.first("weight").alias("weight")))


def fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (intercept first) of a weighted logistic regression, by Newton steps."""
    z = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(z.shape[1])
    loss = np.inf
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -35, 35)))
        h = (z * (w * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(beta))
        step = np.linalg.solve(h, z.T @ (w * (p - y)) + ridge * beta)
        beta = beta - step * min(1.0, 5.0 / (1e-12 + np.abs(step).max()))
        now = np.abs(step).max()
        if now < 1e-8 or (now >= loss and now < 1e-6):
            break
        loss = now
    return beta


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
