"""Document fingerprints (operator 6): SimHash, and a search within a Hamming radius.

Every shingle of five words (``shingles``) is hashed to 128 bits, and each occurrence of it votes
+1 or -1 on every bit, so a term weighs as often as it occurs. The signs of the sums are the
fingerprint, written as 32 hex digits. The share of differing bits of two fingerprints estimates
the angle between the term vectors; ``likeness`` is its cosine, not below 0.

``near_classes`` lists all pairs within a few bits: the bits are cut into radius + 1 blocks, of
which at least one is equal in such a pair. There is one table for each block, with that block
moved to the front as its key; fingerprints that meet in a table are compared. Equal fingerprints
are first made one row, so a group of copies stays one row.

``count_near`` counts within any radius and lists no pairs; every pair within it is found. Its
radius comes from a likeness (``radius_for``): a pair of texts with Jaccard similarity J differs in
a bit with chance acos(2J / (1 + J)) / pi. Fingerprints are dealt into blocks, and each pair of
blocks is a group that one task compares. Inside a group the bits are cut into runs, each with an
allowance of differing bits (``allowances``); a pair within the radius keeps at least one of them.
So for each run only the rows whose bits differ there by no more than its allowance are compared by
all their bits, and a pair counts in the first run that it keeps. The work grows with the square of
the different fingerprints; longer runs in larger blocks leave a smaller share of the pairs to compare.

``edited_fingerprints`` pairs each document with the next by descending doc_id without a global
sort: ids are cut into blocks of rows that follow one another, each block is sorted by itself, and
the first document of every block is also sent to the block before it (that of the first to the
last). Blocks are read as streams, so only one pair of texts is held beside the current batch.

Cases: a NULL or empty text has no terms and the fingerprint of 32 zeros. NULL ids come after all
others. Rows that share an id follow one another by their text. A single row is its own next.
A tied vote is a 0, so fingerprints of very short texts hold few ones and may lie near that of no terms.
An empty table gives an empty result. ``fingerprints`` replaces a column with the name of its result;
no other name clashes.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import grouped, slices, stored, table
from .shingles import mix, shingle_hashes

BITS = 128
WORDS = 5
ROWS = 2000                                                 # rows in a block of following ids, about
BLOCKS = 20_000                                             # blocks at most (larger ones beyond)
STEP = 256                                                  # rows handled at once
JACCARD = 0.8                                               # similarity of the pairs that n_near is to reach
WITHIN = 0.95                                               # share of those pairs within the radius
CROWD = 8192                                                # fingerprints of a pair of blocks at least, about
SPREAD = 8                                                  # blocks that more fingerprints are dealt into, so that tasks share the work
HELD = 1 << 19                                              # fingerprints in a block at most, about
WHOLE = 1 << 15                                             # a block of so many is compared without runs
FILL = 64                                                   # rows that agree in a run of bits, about
CHUNK = 1 << 13                                             # fingerprints compared with 64 at once
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def simhash(texts: pa.Array) -> np.ndarray:
    """One row of BITS / 8 bytes for each text."""
    out = [np.zeros((0, BITS // 8), np.uint8)]
    for _, _, data, offs in slices(texts):
        h, at = shingle_hashes(data, offs, WORDS)
        n = np.diff(at)
        doc = np.repeat(np.arange(len(n)), n) * 256
        both = np.stack([mix(h), mix(h ^ np.uint64(0x5851F42D4C957F2D))], axis=1)
        octets = both.view(np.uint8).reshape(len(h), BITS // 8)
        ones = np.empty((len(n), BITS))
        for i in range(BITS // 8):
            seen = np.bincount(doc + octets[:, i], minlength=256 * len(n)).reshape(len(n), 256)
            ones[:, 8 * i:8 * i + 8] = seen @ _BYTE_BITS
        out.append(np.packbits(2 * ones > n[:, None], axis=1))
    return np.concatenate(out)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated cosine of the term vectors behind two rows of fingerprints, 0 to 1."""
    differ = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return np.maximum(np.cos(np.pi * differ / BITS), 0.0)


def fingerprints(docs: DataFrame, text: str = "text", out: str = "__fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of every whole text as hex digits."""
    docs = docs.drop(out)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([r.tobytes().hex() for r in simhash(b.column(text))], pa.string())
            yield pa.RecordBatch.from_pydict(dict(zip(b.schema.names, b.columns)) | {out: found})

    return docs.mapInArrow(run, docs.select("*").schema.add(out, "string"))


def _differ(a: str, b: str) -> Column:
    """Number of differing bits of two columns of hex digits, 60 bits (one long) at a time."""
    def part(c: str, i: int) -> Column:
        return F.conv(F.substring(F.col(c), 15 * i + 1, 15), 16, 10).cast("long")

    parts = range(-(-(BITS // 4) // 15))
    return sum((F.bit_count(part(a, i).bitwiseXOR(part(b, i))) for i in parts), F.lit(0))


def near_classes(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b, distance), a < b: all pairs of different values of ``fp`` within ``radius`` bits.

    ``prints`` holds each fingerprint once, in ``fp``.
    """
    digits = BITS // 4
    cuts = [round(i * digits / (radius + 1)) for i in range(radius + 2)]
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.substring("fp", lo + 1, hi - lo).alias("key"))
                     for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))])
    tables = prints.select("fp", F.inline(keys))
    a, b = tables.alias("a"), tables.alias("b")
    met = a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key"))
                 & (F.col("a.fp") < F.col("b.fp")) & (_differ("a.fp", "b.fp") <= radius))
    return met.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct().withColumn("distance", _differ("a", "b"))


def near_fingerprints(prints: DataFrame, radius: int = 3, doc_id: str = "doc_id",
                      fingerprint: str = "fingerprint") -> tuple[DataFrame, DataFrame]:
    """(pairs, members): ``near_classes`` of the fingerprints, and (doc_id, fp) of every document."""
    own = prints.select(F.col(doc_id).alias("doc_id"), F.col(fingerprint).alias("fp"))
    return near_classes(own.select("fp").distinct(), radius), own


def radius_for(jaccard: float, within: float) -> int:
    """Fewest bits that hold the distance of texts so alike with probability ``within``."""
    p, held = math.acos(2 * jaccard / (1 + jaccard)) / math.pi, 0.0
    for r in range(BITS):
        held += math.comb(BITS, r) * p**r * (1 - p)**(BITS - r)
        if held >= within:
            return r
    return BITS


def allowances(rows: int, radius: int) -> list[tuple[int, int, int]]:
    """(first bit, end, allowance) of runs of bits: a pair that differs in at most ``radius`` bits
    differs within the allowance in at least one of them. Runs are as long as ``rows`` rows fill."""
    bits = max(1, math.floor(math.log2(max(rows, 1) / FILL)))
    count = min(-(-BITS // bits), radius + 1)               # of radius + 1 runs one is equal
    cuts = [round(i * BITS / count) for i in range(count + 1)]
    spare = radius - count + 1                              # a pair beyond every allowance differs in their sum + count bits
    runs = [(lo, min(hi, lo + bits)) for lo, hi in zip(cuts, cuts[1:])]
    longest = sorted(range(count), key=lambda i: (runs[i][0] - runs[i][1], i))
    more = set(longest[:spare % count])
    return [(lo, hi, spare // count + (i in more)) for i, (lo, hi) in enumerate(runs)]


def _run_mask(lo: int, hi: int) -> np.ndarray:
    ones = np.zeros(BITS, np.uint8)
    ones[lo:hi] = 1
    return np.packbits(ones).view(np.uint64)


def _within(x: np.ndarray, radius: int) -> np.ndarray:
    """Where rows of two words hold at most ``radius`` ones."""
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64) <= radius


def _keys(x: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The bits from ``lo`` to ``hi`` of each row as a number."""
    first, last = lo // 8, -(-hi // 8)
    octets = np.ascontiguousarray(x).view(np.uint8).reshape(-1, BITS // 8)[:, first:last].astype(np.int64)
    whole = octets @ (np.int64(1) << np.arange(8 * (last - first - 1), -1, -8))
    return (whole >> (8 * last - hi)) & ((1 << (hi - lo)) - 1)


def _count_group(left: np.ndarray, right: np.ndarray, same: bool, radius: int,
                 copies_left: np.ndarray, copies_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the copies of rows on the other side within ``radius``. Where both sides are the
    ``same``, each pair is taken once and a row is not its own."""
    n_left, n_right = np.zeros(len(left)), np.zeros(len(right))
    (x0, x1), (y0, y1) = (np.ascontiguousarray(side.T) for side in (left, right))

    def compare(own: np.ndarray, others: np.ndarray, kept: list[tuple[np.ndarray, int]]) -> None:
        d = np.bitwise_count(x0[own][:, None] ^ y0[others])
        d += np.bitwise_count(x1[own][:, None] ^ y1[others])
        a, b = np.divmod(np.flatnonzero(d <= radius), len(others))
        if same:
            once = own[a] < others[b]
            a, b = a[once], b[once]
        for mask, allowed in kept:
            new = ~_within((left[own[a]] ^ right[others[b]]) & mask, allowed)
            a, b = a[new], b[new]
        if len(a):
            n_left[own] += np.bincount(a, copies_right[others[b]], len(own))
            n_right[others] += np.bincount(b, copies_left[own[a]], len(others))

    # a run of no bits compares all
    runs = allowances(len(right), radius) if len(right) > WHOLE else [(0, 0, 0)]
    kept: list[tuple[np.ndarray, int]] = []
    for lo, hi, allowed in runs:
        flips = np.array([sum(1 << i for i in some) for k in range(allowed + 1)
                          for some in itertools.combinations(range(hi - lo), k)], np.int64)
        sides = []
        for x in (left, right):
            key = _keys(x, lo, hi) if hi else np.zeros(len(x), np.int64)
            sides.append((np.argsort(key, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(key, minlength=1 << (hi - lo)))))))
        (order_left, at_left), (order_right, at_right) = sides
        for key in np.flatnonzero(np.diff(at_left)):
            met = key ^ flips
            start, n = at_right[met], at_right[met + 1] - at_right[met]
            others = order_right[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            own = order_left[at_left[key]:at_left[key + 1]]
            for i in range(0, len(own), 64):
                for j in range(0, len(others), CHUNK):
                    compare(own[i:i + 64], others[j:j + CHUNK], kept)
        kept.append((_run_mask(lo, hi), allowed))
    return n_left, n_right


def near_counts(classes: DataFrame, radius: int) -> DataFrame:
    """(fp, more): rows with another fingerprint within ``radius`` bits, for those that have any.

    ``classes`` holds each fingerprint once, in ``fp``, with its number of ``copies``.
    """
    n = classes.count()
    blocks = max(-(-n // HELD), min(SPREAD, -(-n // (CROWD // 2))), 1)

    def binary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = np.frombuffer(bytes.fromhex("".join(b.column("fp").to_pylist())), np.uint8).reshape(-1, BITS // 8)
            yield pa.RecordBatch.from_pydict({"print": pa.array([r.tobytes() for r in raw], pa.binary()), "copies": b.column("copies")})

    held = (classes.select("fp", "copies").mapInArrow(binary, "print binary, copies long")
            .withColumn("own", F.pmod(F.xxhash64("print"), F.lit(blocks)).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
            .select((F.least("own", "other") * blocks + F.greatest("own", "other")).alias("group"), "own", "print", "copies")
            .repartition(blocks * (blocks + 1) // 2, "group").sortWithinPartitions("group"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in grouped(batches, "group"):
            x = np.frombuffer(b"".join(g.column("print").to_pylist()), np.uint64).reshape(-1, 2)
            own, copies = g.column("own").to_numpy(), g.column("copies").to_numpy()
            i, j = divmod(g.column("group")[0].as_py(), blocks)
            left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
            more = np.zeros(len(g))
            n_left, n_right = _count_group(x[left], x[right], i == j, radius, copies[left], copies[right])
            more[left] += n_left
            more[right] += n_right
            some = np.flatnonzero(more)
            yield pa.RecordBatch.from_pydict({"fp": pa.array([x[k].tobytes().hex() for k in some], pa.string()),
                                              "more": pa.array(more[some].astype(np.int64))})

    return held.mapInArrow(compare, "fp string, more long").groupBy("fp").agg(F.sum("more").alias("more"))


def count_near(prints: DataFrame, radius: int = 3, fingerprint: str = "fingerprint", out: str = "n_near") -> DataFrame:
    """``prints`` with the number of other rows within ``radius`` bits, copies included."""
    held = stored(prints)
    classes = stored(held.groupBy(F.col(fingerprint).alias("fp")).agg(F.count(F.lit(1)).alias("copies")))
    more = near_counts(classes, radius)
    near = stored(classes.join(more, "fp", "left").select(
        F.col("fp").alias("__fp"), (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias(out)))
    return held.join(near, F.col(fingerprint) == F.col("__fp")).drop("__fp")


def _block_of(ids: pa.Array, cuts: np.ndarray) -> np.ndarray:
    """Block 0 holds the largest ids; NULL ids have the last one. ``cuts`` ascend."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    return np.where(null, len(cuts) + 1, len(cuts) - np.searchsorted(cuts, values, "left")).astype(np.int32)


def _heads(ids: DataFrame, cuts: np.ndarray) -> dict[int, int | None]:
    """The first (largest) id of every block that has rows; one entry for each block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            block = _block_of(b.column("doc_id"), cuts)
            t = pa.table({"block": block, "doc_id": b.column("doc_id")})
            yield from t.group_by("block").aggregate([("doc_id", "max")]).rename_columns(
                ["block", "doc_id"]).to_batches()

    rows = (ids.mapInArrow(run, "block int, doc_id long").groupBy("block")
            .agg(F.max("doc_id").alias("head")).collect())
    return {r["block"]: r["head"] for r in rows}


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next; the rule is that of operator 6's query."""
    ids = docs.select("doc_id")
    n = ids.count()
    wanted = min(BLOCKS, -(-n // ROWS))
    cuts = np.zeros(0, np.int64)
    if wanted > 1:
        share = F.array(*[F.lit(i / wanted) for i in range(1, wanted)])
        found = ids.agg(F.percentile_approx("doc_id", share, F.lit(4 * wanted)).alias("q")).first()["q"]
        cuts = np.unique(np.array(found or [], np.int64))
    heads = _heads(ids, cuts)
    order = sorted(heads)
    before: dict[int | None, list[int]] = {}                # id of a head: blocks that need it as a guest
    for i, block in enumerate(order):
        before.setdefault(heads[block], []).append(order[i - 1])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            id_list = b.column("doc_id").to_pylist()
            rows = [(int(k), 0, i) for i, k in enumerate(_block_of(b.column("doc_id"), cuts))]
            rows += [(k, 1, i) for i, d in enumerate(id_list) for k in before.get(d, ())]
            texts = [pack.compress(t or b"") for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([r[0] for r in rows], pa.int32()), "guest": pa.array([r[1] for r in rows], pa.int32()),
                "doc_id": pa.array([id_list[r[2]] for r in rows], pa.int64()),
                "packed": pa.array([texts[r[2]] for r in rows], pa.binary())})

    dealt = (docs.select("doc_id", "text").mapInArrow(deal, "block int, guest int, doc_id long, packed binary")
             .repartition("block").sortWithinPartitions("block", "guest", F.col("doc_id").desc_nulls_last(), "packed"))
    return dealt.mapInArrow(_follow, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                     "edited_fingerprint string, near_edited double, near_next double")


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs every own row with the row after it in its block."""
    unpack = zstandard.ZstdDecompressor()
    waiting: tuple | None = None                            # the last own row: block, id, text, fingerprint
    for whole in batches:
        for lo in range(0, whole.num_rows, STEP):
            b = whole.slice(lo, STEP)
            texts = [unpack.decompress(x).decode() for x in b.column("packed").to_pylist()]
            prints = simhash(pa.array(texts, pa.string()))
            pairs = []
            for block, guest, doc_id, t, p in zip(*(b.column(c).to_pylist() for c in ("block", "guest", "doc_id")),
                                                  texts, prints):
                if waiting is not None and waiting[0] == block:
                    pairs.append((waiting, t, p))
                waiting = None if guest else (block, doc_id, t, p)
            if pairs:
                yield _compare(pairs)


def _compare(pairs: list[tuple]) -> pa.RecordBatch:
    edited = []
    for (_, _, t, _), after, _ in pairs:
        half = len(t) // 2
        edited.append(t[:len(t) - half] + after[:half])
    own, nxt = np.array([w[3] for w, _, _ in pairs]), np.array([p for _, _, p in pairs])
    prints = simhash(pa.array(edited, pa.string()))
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array([w[1] for w, _, _ in pairs], pa.int64()),
        "n_chars": pa.array([len(w[2]) for w, _, _ in pairs], pa.int64()),
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": [r.tobytes().hex() for r in own], "edited_fingerprint": [r.tobytes().hex() for r in prints],
        "near_edited": likeness(own, prints), "near_next": likeness(own, nxt)})


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: n_chars, edited_sha256, both fingerprints, near_edited, near_next, and
    n_near, the number of other documents whose fingerprint lies within the bits (26) that hold
    the distance of WITHIN of the pairs at Jaccard similarity JACCARD."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return count_near(edited_fingerprints(docs), radius_for(JACCARD, WITHIN))
