"""Hard-negative mining (operator 11): Hilbert-ordered blocks with zone maps and interval bounds.

Rows are ordered along a Hilbert curve through the ``KEY_DIMS`` dimensions that vary most and written
as blocks of ``block_rows`` rows; one Parquet row is one block. Beside its packed vectors a block
keeps its zone map: the smallest and largest value of every dimension and of the label. Bounding
looks at the zone maps alone (Parquet reads only those columns): with an anchor's vector they give
an interval that holds the scores of all rows of the block.

A query is one anchor with a window of scores and a rank to reach. Its blocks are chosen twice. First
each region (a run of neighbouring blocks) names the one block whose interval reaches highest into
the window; the best rows of these blocks give a score that the wanted rows must reach. Then every
block is chosen whose interval touches the window above that score, and only those are read and
multiplied out. So results are exact: a block is left out only if none of its rows can be wanted.
The first pair of passes finds each anchor's positives (rows of its label, any score), the second
its negatives (other labels), with one window for each positive.

Each region meets each anchor once in the bounding passes, in tiles of at most ``LANE`` queries, so a
task holds one region and a few hundred queries at a time. The work of the bounds grows with anchors
times blocks, as the contract's query set asks.

Cases: rows with a NULL vec_id, label or vector, or with a NULL or non-finite component take no
part. Shorter vectors count as zero in the dimensions that they lack; an empty vector scores 0. Of
rows that share a vec_id the smallest by label and components stays. Equal scores go by smaller
vec_id; positives of an anchor with equal scores have windows of their own. Anchors without
positives, and windows without rows, give no rows, as does an empty table. A positive with a
negative score has an empty window. Only vec_id, embedding and label are read, so other columns
clash with nothing. Scores that might not fit a long raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

KEY_DIMS, KEY_BITS = 15, 4                                 # a curve of 60 bits
BLOCK_ROWS = 256
LEAST_REGION, MOST_REGION = 16, 1024                        # blocks of a region
LANE = 1 << 16                                             # queries that one task sees
BATCH = 512                                                # queries handled at once
POSITIVES, NEGATIVES = 5, 10
FAR = (1 << 62) - 1                                        # beyond every score


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of coordinates below 2**bits (rows x dims)."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:                                            # undo the turns of the sub-cubes
        for i in range(n):
            high = (x[:, i] & q) > 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] ^= np.where(high, q - 1, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, n):                                   # Gray code
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[:, n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def intervals(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest possible inner product of each anchor with rows of each block."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T


def leading(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k rows of each query, by score from the highest, then by id."""
    order = np.lexsort((ids, -score, query))
    q = query[order]
    first = np.concatenate(([True], q[1:] != q[:-1])) if len(q) else np.zeros(0, bool)
    start = np.flatnonzero(first)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[rank < k]


def integer_rows(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part, with the contract's labels and integers."""
    ok = F.forall("embedding", lambda x: F.coalesce(
        x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    label = F.col("label").cast("long")
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), "embedding")
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ok)
            .select("vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
                    F.transform("embedding", lambda x: F.floor(x.cast("double") * 256.0).cast("long")).alias("vec")))


def _one_of_each_id(rows: DataFrame) -> DataFrame:
    again = stored(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("vec_id"))
    if not again.limit(1).count():                          # ids are unique, the usual case
        return rows
    one = (rows.join(again, "vec_id", "left_semi").groupBy("vec_id")
           .agg(F.min(F.struct("label", "vec")).alias("m")).select("vec_id", "m.label", "m.vec"))
    return rows.join(again, "vec_id", "left_anti").unionByName(one)


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    """List column -> rows x dims, short rows filled up with zeros."""
    offs = np.asarray(col.offsets)
    flat = col.values.to_numpy(zero_copy_only=False)
    n = np.diff(offs)
    if len(n) and (n == dims).all():
        return flat[offs[0]:offs[-1]].reshape(len(n), dims)
    out = np.zeros((len(n), dims), np.int64)
    for r in range(len(n)):
        out[r, :n[r]] = flat[offs[r]:offs[r + 1]]
    return out


@dataclass
class Index:
    """The blocks (stored), how many there are in a region, and the numbers' shape."""
    blocks: DataFrame                                       # block, region, n, lo, hi, label_lo, label_hi, ids, labels, vecs
    regions: int
    dims: int
    exact: type                                             # in which products are exact


def build_index(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> Index | None:
    """Blocks of (vec_id, label, vec) rows along the curve; None without any row."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dims"),
                    F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x.cast("double"))))).alias("most")).first()
    n, dims = size["n"], max(size["dims"] or 0, 1)
    if not n:
        return None
    top = dims * max(size["most"], 1.0) ** 2
    if top >= FAR:
        raise ValueError("scores of these vectors may not fit a long")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros(dims), np.zeros(dims)
        for batch in batches:
            x = _matrix(batch.column("vec"), dims).astype(float)
            a, b = a + x.sum(axis=0), b + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"dim": np.arange(dims), "a": a, "b": b})

    found = rows.select("vec").mapInArrow(sums, "dim long, a double, b double").groupBy("dim").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    mean, sd = np.zeros(dims), np.ones(dims)
    for r in found.collect():                               # two numbers a dimension
        mean[r["dim"]] = r["a"] / n
        sd[r["dim"]] = np.sqrt(max(r["b"] / n - (r["a"] / n) ** 2, 0.0))
    use = np.sort(np.argsort(-np.round(sd, 6), kind="stable")[:KEY_DIMS])
    mean, width = mean[use], np.maximum(sd[use], 1e-9) * 4 / (1 << KEY_BITS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("vec"), dims)[:, use]
            cells = np.clip(np.floor((x - mean) / width) + (1 << KEY_BITS - 1), 0, (1 << KEY_BITS) - 1)
            yield pa.RecordBatch.from_pydict(dict(zip(b.schema.names, b.columns)) | {
                "key": pa.array(hilbert_keys(cells.astype(np.int64), KEY_BITS), pa.int64())})

    keyed = rows.mapInArrow(place, "vec_id long, label long, vec array<long>, key long")
    region = int(np.clip(-(-n // block_rows) // 32, LEAST_REGION, MOST_REGION))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, have, number = [], 0, 0
        for b in batches:
            held.append(b)
            have += b.num_rows
            while have >= block_rows:
                whole = pa.Table.from_batches(held)
                yield block(whole.slice(0, block_rows), number)
                number += 1
                rest = whole.slice(block_rows)
                held, have = rest.to_batches(), rest.num_rows
        if have:
            yield block(pa.Table.from_batches(held), number)

    def block(rows: pa.Table, number: int) -> pa.RecordBatch:
        rows = rows.combine_chunks().sort_by("vec_id")
        x = _matrix(rows.column("vec").combine_chunks(), dims)
        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        home = rows.column("home")[0].as_py()
        one = lambda v, kind: pa.array([v], kind)
        return pa.RecordBatch.from_pydict({
            "block": one((home << 32) + number, pa.int64()), "n": one(len(ids), pa.int32()),
            "lo": one(x.min(axis=0).tolist(), pa.list_(pa.int64())), "hi": one(x.max(axis=0).tolist(), pa.list_(pa.int64())),
            "label_lo": one(int(labels.min()), pa.int64()), "label_hi": one(int(labels.max()), pa.int64()),
            "ids": one(ids.astype(np.int64).tobytes(), pa.binary()), "labels": one(labels.astype(np.int64).tobytes(), pa.binary()),
            "vecs": one(np.ascontiguousarray(x, np.int64).tobytes(), pa.binary())})

    ordered = (keyed.repartitionByRange("key", "vec_id").sortWithinPartitions("key", "vec_id")
               .select(F.spark_partition_id().alias("home"), "vec_id", "label", "vec"))
    blocks = stored(ordered.mapInArrow(pack, "block long, n int, lo array<long>, hi array<long>, label_lo long, label_hi long, "
                                             "ids binary, labels binary, vecs binary"))
    # neighbouring blocks get one region: a running count over the tasks that wrote them
    homes = blocks.groupBy(F.shiftright("block", 32).alias("home")).agg(F.count(F.lit(1)).alias("n"))
    before = homes.select("home", (F.sum("n").over(Window.orderBy("home").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    at = F.coalesce("before", F.lit(0)) + F.col("block").bitwiseAND((1 << 32) - 1)  # one row a task that wrote blocks
    blocks = blocks.join(before, F.shiftright("block", 32) == F.col("home")).withColumn("region", F.floor(at / region).cast("int"))
    count = -(-blocks.count() // region)
    return Index(blocks.drop("home", "before"), count, dims, np.float64 if top < 1 << 53 else np.int64)


QUERY = "anchor long, rank int, label long, same boolean, low long, high long, floor long, vec array<long>"


def scan(index: Index, queries: DataFrame, k: int, seed: bool) -> DataFrame:
    """(anchor, rank, vec_id, score, k rows at most a query and region) from the chosen blocks.

    ``queries``: QUERY columns. ``seed`` reads one block of a region for each query, the one that
    reaches highest into its window; else every block that may hold a row in [low, high] of at least
    ``floor``. ``same`` asks for rows of the anchor's label, else for rows of other labels.
    """
    dims, exact = index.dims, index.exact
    queries = stored(queries)
    lanes = max(1, -(-queries.count() // LANE))
    lane = F.pmod(F.xxhash64("anchor"), F.lit(lanes)).cast("int")
    names = [c.strip().split(" ")[0] for c in QUERY.split(",")]
    zones = index.blocks.select("region", "block", "lo", "hi", "label_lo", "label_hi").withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    grid = queries.withColumn("lane", lane).withColumn("region", F.explode(F.sequence(F.lit(0), F.lit(index.regions - 1))))

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        """Blocks (first) and queries of each (region, lane), side by side in one partition."""
        both = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)), allowMissingColumns=True)
        return both.repartition("region", "lane").sortWithinPartitions("region", "lane", "side", F.coalesce("block", "anchor"), "rank")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for zone, asked in _tiles(batches, ("block", "lo", "hi", "label_lo", "label_hi")):
            lo, hi = (_matrix(zone[c], dims).astype(exact) for c in ("lo", "hi"))
            small, large = zone["label_lo"].to_numpy(), zone["label_hi"].to_numpy()
            a = _matrix(asked.column("vec"), dims).astype(exact)
            least, most = intervals(a, lo, hi)
            label, same, low, high, floor = (asked.column(c).to_numpy(zero_copy_only=False) for c in ("label", "same", "low", "high", "floor"))
            has = (small <= label[:, None]) & (label[:, None] <= large)
            only = (small == label[:, None]) & (large == label[:, None])
            fits = np.where(same[:, None], has, ~only) & (least <= high[:, None]) & (most >= np.maximum(low, floor)[:, None])
            if seed:
                reach = np.where(fits, np.minimum(most, high[:, None]), -np.inf)
                best = reach.argmax(axis=1)
                keep = np.zeros_like(fits)
                keep[np.arange(len(a)), best] = fits[np.arange(len(a)), best]
                fits = keep
            some = np.flatnonzero(fits.any(axis=1))
            ids = zone["block"].to_numpy()
            found = [ids[fits[i]] for i in some]
            if len(some):
                yield pa.RecordBatch.from_pydict({c: asked.column(c).take(pa.array(some)) for c in [*names, "region", "lane"]}
                                                 | {"blocks": pa.array(found, pa.list_(pa.int64()))})

    chosen = stored(met(zones, grid).mapInArrow(choose, QUERY + ", region int, lane int, blocks array<long>"))
    wanted = chosen.select("lane", F.explode("blocks").alias("block")).distinct()
    read = index.blocks.select("region", "block", "ids", "labels", "vecs").join(wanted, "block")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, asked in _tiles(batches, ("block", "ids", "labels", "vecs")):
            place = {b: i for i, b in enumerate(held["block"].to_pylist())}
            anchor = asked.column("anchor").to_numpy()
            own, first, row = np.unique(anchor, return_index=True, return_inverse=True)
            a = _matrix(asked.column("vec"), dims)[first].astype(exact)
            label, same, low, high = (asked.column(c).to_numpy(zero_copy_only=False) for c in ("label", "same", "low", "high"))
            least = np.maximum(low, asked.column("floor").to_numpy()).astype(np.int64)
            picked = [[place[b] for b in bs] for bs in asked.column("blocks").to_pylist()]
            use = np.zeros((len(anchor), len(place)), bool)
            for i, p in enumerate(picked):
                use[i, p] = True
            q, s, ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            for j in np.flatnonzero(use.any(axis=0)):
                v = np.frombuffer(held["vecs"][int(j)].as_py(), np.int64).reshape(-1, dims).astype(exact)
                vec_id = np.frombuffer(held["ids"][int(j)].as_py(), np.int64)
                lab = np.frombuffer(held["labels"][int(j)].as_py(), np.int64)
                at = np.flatnonzero(use[:, j])
                got = (a @ v.T)[row[at]]
                fits = (got >= least[at][:, None]) & (got <= high[at][:, None]) & (vec_id != anchor[at][:, None])
                fits &= (lab == label[at][:, None]) == same[at][:, None]
                r, c = np.nonzero(fits)
                q, s, ids = np.append(q, at[r]), np.append(s, got[r, c].astype(np.int64)), np.append(ids, vec_id[c])
                keep = leading(q, s, ids, k)
                q, s, ids = q[keep], s[keep], ids[keep]
                full = np.flatnonzero(np.bincount(q, minlength=len(anchor)) == k)
                last = np.searchsorted(q, full, "right") - 1
                least[full] = np.maximum(least[full], s[last])  # an equal score may still win by its id
            if len(q):
                yield pa.RecordBatch.from_pydict({"anchor": pa.array(anchor[q]), "rank": asked.column("rank").take(pa.array(q)),
                                                  "vec_id": pa.array(ids), "score": pa.array(s)})

    found = met(read, chosen).mapInArrow(multiply, "anchor long, rank int, vec_id long, score long")
    w = Window.partitionBy("anchor", "rank").orderBy(F.desc("score"), "vec_id")
    return stored(found.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k))


def _tiles(batches: Iterator[pa.RecordBatch], kept: tuple[str, ...]) -> Iterator[tuple[dict, pa.RecordBatch]]:
    """({column: blocks of a region}, at most BATCH of its queries) from rows sorted by region and
    lane, blocks first. A region's blocks are held while its queries pass by."""
    held: dict[str, list] = {}
    now, packed = None, None
    for b in batches:
        keys = np.stack([b.column(c).to_numpy() for c in ("region", "lane", "side")])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
            if lo == hi:
                continue
            part, key, side = b.slice(lo, hi - lo), tuple(keys[:2, lo]), keys[2, lo]
            if key != now:
                held, now, packed = {c: [] for c in kept}, key, None
            if side == 0:
                for c in kept:
                    held[c].append(part.column(c))
                continue
            if not held[kept[0]]:
                continue
            if packed is None:
                packed = {c: pa.concat_arrays(held[c]) for c in kept}
            for at in range(0, part.num_rows, BATCH):
                yield packed, part.slice(at, BATCH)


def _best(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """The first k rows of each query: one seeding pass, then all blocks that may hold better ones."""
    queries = stored(queries)
    seeds = scan(index, queries, k, seed=True)
    reached = seeds.filter(F.col("place") == k).select("anchor", "rank", F.col("score").alias("reached"))
    again = queries.join(reached, ["anchor", "rank"], "left").withColumn("floor", F.coalesce("reached", "floor")).drop("reached")
    return scan(index, again, k, seed=False)


def mine(rows: DataFrame, anchors_every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES,
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows
    (vec_id, embedding, label) whose vec_id is divisible by ``anchors_every``."""
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    own = stored(_one_of_each_id(integer_rows(rows)))
    index = build_index(own, block_rows)
    if index is None:
        return rows.sparkSession.createDataFrame([], schema)
    anchors = own.filter(F.col("vec_id") % anchors_every == 0)
    wide = [F.lit(False).alias("same"), F.lit(-FAR).alias("low"), F.lit(FAR).alias("high"), F.lit(-FAR).alias("floor")]
    asked = anchors.select(F.col("vec_id").alias("anchor"), F.lit(0).alias("rank"), "label", F.lit(True).alias("same"), *wide[1:], "vec")
    near = _best(index, asked, positives).select("anchor", F.col("place").cast("int").alias("rank"),
                                                 F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    p = F.col("positive_score")
    windows = (near.filter(p >= 0).join(anchors.select(F.col("vec_id").alias("anchor"), "label", "vec"), "anchor")
               .select("anchor", "rank", "label", F.lit(False).alias("same"), F.expr("(3 * positive_score + 9) div 10").alias("low"),
                       F.expr("(9 * positive_score) div 10").alias("high"), F.lit(-FAR).alias("floor"), "vec"))
    hard = _best(index, windows, negatives).select("anchor", "rank", F.col("place").cast("int").alias("place"),
                                                   F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return near.join(hard, ["anchor", "rank"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", F.col("place").alias("rank"), "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    return mine(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


OP11_SQL = """
WITH ok AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM ok a JOIN ok b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other))::INTEGER AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) <= 10
"""
