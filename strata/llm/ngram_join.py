"""N-gram Jaccard join (operator 1): a chosen-path join over shingle sets.

A document's set is its distinct shingles of five words (``shingles``). Documents with equal sets
are one row, a class of copies, from the start. Each set gets a signature of ``COORDS`` minhash
values; two sets agree in about as many as their Jaccard similarity says. (coordinate, value)
pairs are the tokens. At the root of a run every set samples its tokens, each with probability
1 / (threshold * COORDS) by a hash that all sets share, and falls into the bucket of each token
sampled. A bucket of at most ``LEAF`` sets is compared by brute force. The sets of a larger one
sample again, with new hashes, and split further; below ``DEPTH`` levels a bucket that is still
large (many sets that are alike) is dealt into blocks and all pairs of blocks are compared. The
runs repeat with other hashes until a pair exactly at the threshold is met with probability
``recall`` at least (``enough_runs``). All runs share one signature, so the chance is taken for each
number m of agreeing values, weighted by the binomial law: from a level to the next the chance to
stay together is that of a branching process, q -> 1 - (1 - q / (threshold * COORDS))**m.

Buckets compare signatures loosely (five standard deviations below the threshold) and only hand on
a forest of what is alike. Components of these forests are families; inside a family all pairs are
compared exactly on their whole sets, block by block, each pair once. So links are counted exactly
without listing pairs. Only documents of families have their sets built a second time and shuffled:
a Bloom filter of bounded size over the ids of families rules most others out where they are read,
and the rest travel as packed texts, which are smaller than their sets.

Cases: a text without words (NULL, empty, only white space) and a NULL doc_id link with nothing. A
text with fewer than five words has one shingle of all of them. Rows that share a doc_id are
documents of their own. Words are compared with A-Z lower-cased and white space of any length
between them. An empty table gives an empty result. Equal similarities need no order: every pair at the
threshold or above is a link. Only doc_id and text are read, so other columns clash with nothing;
``keep_one`` hands them on, and only names beginning with __ are its own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filter_has, grouped, id_filter, slices, stored, table
from .graph import components
from .shingles import mix, shingle_hashes

WORDS = 5
JACCARD = 0.8
RECALL = 0.9999
COORDS = 64
LEAF = 256                                                  # sets compared without a further split
DEPTH = 3
SLICE = 256 << 10                                           # bytes of text hashed at once
BLOCK = 4096                                                # sets of a side where buckets are dealt into blocks
EXACT = 128                                                 # sets of a side in the exact comparison
COLUMNS = 8192                                              # shingles multiplied at once
_rng = np.random.default_rng(20)
_MUL = _rng.integers(0, 1 << 63, COORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, COORDS, np.uint64)
_TAG = mix(np.arange(1, COORDS + 1, dtype=np.uint64))


def runs(recall: float, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold was met with at least this probability."""
    stays = 1.0
    for _ in range(depth):
        stays = 1 - math.exp(-stays)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - stays)))


def met_chance(n_runs: int, likeness: float, threshold: float, depth: int = DEPTH) -> float:
    """Chance that a pair of this similarity shares a bucket of the last level in one of the runs
    and passes there."""
    total = 0.0
    for m in range(math.ceil(loose(threshold) * COORDS - 1e-9), COORDS + 1):
        stays = 1.0
        for _ in range(depth):
            stays = 1 - (1 - stays / max(1.0, threshold * COORDS))**m
        total += math.comb(COORDS, m) * likeness**m * (1 - likeness)**(COORDS - m) * (1 - (1 - stays)**n_runs)
    return total


def enough_runs(recall: float, threshold: float, depth: int = DEPTH) -> int:
    """Fewest runs that meet a pair exactly at the threshold with this probability."""
    if met_chance(10**6, threshold, threshold, depth) < recall:
        raise ValueError(f"signatures of {COORDS} values do not reach a recall of {recall} at {threshold}")
    n = 1
    while met_chance(n, threshold, threshold, depth) < recall:
        n += 1
    return n


def loose(threshold: float) -> float:
    return max(0.0, threshold - 5 * math.sqrt(threshold * (1 - threshold) / COORDS))


def _limit(threshold: float) -> np.uint64:
    return np.uint64(min((1 << 64) - 1, int((1 << 64) / (threshold * COORDS))))


def signatures(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Minhash values (rows x COORDS) of the texts that have shingles."""
    starts = at[:-1][np.diff(at) > 0]
    out = np.empty((len(starts), COORDS), np.uint64)
    for i in range(COORDS if len(starts) else 0):
        out[:, i] = np.minimum.reduceat(flat * _MUL[i] + _ADD[i], starts)
    return out


def root_buckets(sig: np.ndarray, n_runs: int, threshold: float) -> list[np.ndarray]:
    """The root buckets of each row, of all runs."""
    token = mix(sig ^ _TAG)
    found: list[list[np.ndarray]] = [[] for _ in range(len(sig))]
    for run in range(n_runs):
        u = mix(token ^ mix(np.full(1, 1000 + run, np.uint64)))
        for row, b in zip(*_sampled(u, threshold)):
            found[row].append(b)
    return [np.array(f, np.uint64).view(np.int64) for f in found]


def _sampled(u: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    row, col = np.nonzero(u < _limit(threshold))
    return row, mix(u[row, col] ^ np.uint64(0xA0761D6478BD642F))


def split(bucket: np.ndarray, octets: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child bucket) of the tokens that rows of a bucket sample; tokens by their low byte."""
    token = mix(octets.astype(np.uint64) ^ (_TAG << np.uint64(8)))
    return _sampled(mix(token ^ mix(bucket.view(np.uint64))[:, None]), threshold)


def _set_id(h: np.ndarray) -> bytes:
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def _sets(col: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(first row, flat shingles, offsets, sorted distinct shingles of each text) by slice."""
    for lo, _, data, offs in slices(col, SLICE):
        flat, at = shingle_hashes(data, offs, WORDS)
        yield lo, flat, at, [np.unique(flat[i:j]) for i, j in zip(at, at[1:])]


def describe_sets(docs: DataFrame, threshold: float, n_runs: int) -> DataFrame:
    """(doc_id, node, size, octets, buckets): node identifies the set, NULL where nothing links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            for lo, flat, at, sets in _sets(b.column("text")):
                sig = signatures(flat, at)
                full = np.array([len(s) > 0 for s in sets], bool)
                place = np.cumsum(full) - 1
                buckets = root_buckets(sig, n_runs, threshold)
                octets = (sig & np.uint64(255)).astype(np.uint8)
                own = ids.slice(lo, len(sets))
                links = full & own.is_valid().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": own,
                    "node": pa.array([_set_id(s) if k else None for s, k in zip(sets, links)], pa.binary()),
                    "size": pa.array([len(s) for s in sets], pa.int32()),
                    "octets": pa.array([octets[p].tobytes() if k else None for p, k in zip(place, links)], pa.binary()),
                    "buckets": pa.array([buckets[p] if k else None for p, k in zip(place, links)], pa.list_(pa.int64()))})

    return docs.mapInArrow(run, "doc_id long, node binary, size int, octets binary, buckets array<long>")


def _paths(sets: DataFrame, threshold: float) -> DataFrame:
    """(node, bucket, n): the members of every bucket that is compared."""
    slim = sets.select("node", "octets")
    entries = sets.select("node", F.explode("buckets").alias("bucket"))
    leaves = None
    for level in range(1, DEPTH + 1):
        counts = stored(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
        met = entries.join(counts, "bucket")
        done = met if level == DEPTH else met.filter(F.col("n") <= LEAF)
        done = done.select("node", "bucket", "n")
        leaves = done if leaves is None else leaves.unionByName(done)
        if level == DEPTH or not counts.filter(F.col("n") > LEAF).limit(1).count():
            break

        def deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for lo in range(0, whole.num_rows, 4096):
                    b = whole.slice(lo, 4096)
                    octets = np.frombuffer(b"".join(b.column("octets").to_pylist()), np.uint8).reshape(-1, COORDS)
                    row, child = split(b.column("bucket").to_numpy(), octets, threshold)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("node").take(pa.array(row)), pa.array(child.view(np.int64))], ["node", "bucket"])

        large = met.filter(F.col("n") > LEAF).select("node", "bucket").join(slim, "node")
        entries = stored(large.mapInArrow(deeper, "node binary, bucket long").distinct())
    return leaves


def _dealt(members: DataFrame, key: str, n: str, block: int) -> DataFrame:
    """``members`` with group, own, i, j: each pair of blocks of a key's rows is a group."""
    own = F.pmod(F.xxhash64("node"), F.col("__blocks")).cast("int")
    rows = (members.withColumn("__blocks", F.ceil(F.col(n) / block).cast("int")).withColumn("own", own)
            .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
            .withColumn("i", F.least("own", "__other")).withColumn("j", F.greatest("own", "__other")))
    return rows.withColumn("group", F.xxhash64(key, "i", "j")).drop("__blocks", "__other")


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


def _compare_signatures(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    least, need = threshold, math.ceil(loose(threshold) * COORDS - 1e-9)
    for g in grouped(batches, "group"):
        if len(g) < 2:
            continue
        g = g.combine_chunks()
        octets = np.frombuffer(b"".join(g.column("octets").to_pylist()), np.uint8).reshape(-1, COORDS)
        size, own = g.column("size").to_numpy(), g.column("own").to_numpy()
        i, j = g.column("i")[0].as_py(), g.column("j")[0].as_py()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        found = []
        for lo in range(0, len(left), 64):
            rows = left[lo:lo + 64]
            alike = (octets[rows][:, None, :] == octets[right][None, :, :]).sum(axis=2, dtype=np.int32) >= need
            small, large = np.minimum(size[rows][:, None], size[right]), np.maximum(size[rows][:, None], size[right])
            a, b = np.nonzero(alike & (small >= least * large - 1e-9))
            found.append((rows[a], right[b]))
        a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 2
        keep = a != b
        root = _forest(a[keep], b[keep], len(g))
        joined = np.flatnonzero(root != np.arange(len(g)))
        if len(joined):
            node = g.column("node")
            yield pa.RecordBatch.from_arrays([node.take(pa.array(joined)).combine_chunks(),
                                              node.take(pa.array(root[joined])).combine_chunks()], ["a", "b"])


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the left sets (rows) with the right ones (columns)."""
    used = np.unique(np.concatenate([left, right]))
    flat = np.concatenate([sets[r] for r in used])
    row = np.repeat(used, [len(sets[r]) for r in used])
    _, col, times = np.unique(flat, return_inverse=True, return_counts=True)
    often = times > 1                                       # a shingle of one set is in no intersection
    place = np.cumsum(often) - 1
    keep = often[col]
    row, col = row[keep], place[col[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(left), len(right)), np.float32)
    at = np.full(max(used) + 1, -1)
    at[left] = np.arange(len(left))
    at_right = np.full(max(used) + 1, -1)
    at_right[right] = np.arange(len(right))
    for lo in range(0, int(often.sum()), COLUMNS):
        s = slice(*np.searchsorted(col, (lo, lo + COLUMNS)))
        x, y = np.zeros((len(left), COLUMNS), np.float32), np.zeros((len(right), COLUMNS), np.float32)
        for m, to in ((x, at), (y, at_right)):
            here = to[row[s]] >= 0
            m[to[row[s]][here], col[s][here] - lo] = 1
        out += x @ y.T
    return out


def _compare_sets(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """(a, b, 0) links of a forest, and (a, a, n) with n documents linked to those of a."""
    unpack = zstandard.ZstdDecompressor()
    for g in grouped(batches, "group"):
        if len(g) < 2:
            continue
        g = g.combine_chunks()
        node = g.column("node").to_pylist()
        keep = [k for k in range(len(node)) if not k or node[k] != node[k - 1]]  # rows that share id and text
        if len(keep) < len(node):
            g = g.take(pa.array(keep)).combine_chunks()
        texts = pa.array([unpack.decompress(x) for x in g.column("packed").to_pylist()], pa.binary())
        sets = [x for _, _, _, found in _sets(texts) for x in found]
        size, copies, own = np.array([len(s) for s in sets]), g.column("copies").to_numpy(), g.column("own").to_numpy()
        i, j = g.column("i")[0].as_py(), g.column("j")[0].as_py()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        if not len(left) or not len(right):
            continue
        both = shared_counts(sets, left, right)
        a, b = np.nonzero(both >= threshold * (size[left][:, None] + size[right] - both) - 1e-6)
        a, b = left[a], right[b]
        once = a < b if i == j else np.ones(len(a), bool)
        a, b = a[once], b[once]
        if not len(a):
            continue
        n = np.bincount(a, copies[b], len(g)) + np.bincount(b, copies[a], len(g))
        root = _forest(a, b, len(g))
        some, joined = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(g)))
        node = g.column("node")
        yield pa.RecordBatch.from_arrays([
            node.take(pa.array(np.concatenate([some, joined]))).combine_chunks(),
            node.take(pa.array(np.concatenate([some, root[joined]]))).combine_chunks(),
            pa.array(np.concatenate([n[some].astype(np.int64), np.zeros(len(joined), np.int64)]))], ["a", "b", "n"])


def jaccard_join(docs: DataFrame, threshold: float = JACCARD, recall: float = RECALL, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links, n_shingles) of every document.

    class_id is the smallest doc_id that links lead to; n_links counts the other documents whose
    Jaccard similarity with this one is ``threshold`` or more, copies included.
    """
    return _joined(docs, threshold, recall, doc_id, text).drop("node")


def _joined(docs: DataFrame, threshold: float, recall: float, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``jaccard_join`` with node, the id of each document's set."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    described = stored(describe_sets(own, threshold, enough_runs(recall, threshold)))
    sets = stored(described.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"),
        F.first("octets").alias("octets"), F.first("buckets").alias("buckets")))
    paths = _dealt(_paths(sets, threshold), "bucket", "n", BLOCK)
    held = (paths.select("group", "own", "i", "j", "node").join(sets.select("node", "size", "octets"), "node")
            .repartition("group").sortWithinPartitions("group", "node"))
    near = held.mapInArrow(lambda it: _compare_signatures(it, threshold), "a binary, b binary")
    families = stored(components(near, "a", "b"))
    members = stored(families.select("node", F.col("component").alias("family"))
                     .unionByName(families.select(F.col("component").alias("node"), F.col("component").alias("family")).distinct()))
    counts = stored(members.groupBy("family").agg(F.count(F.lit(1)).alias("n")))
    wanted = stored(members.join(counts, "family").join(sets.select("node", "rep", "copies"), "node"))

    packed, bits = id_filter(wanted, "rep", wanted.count())
    sent = own.sparkSession.sparkContext.broadcast(packed)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(b.column("doc_id").is_valid())
            b = b.filter(pa.array(filter_has(sent.value, bits, b.column("doc_id").to_numpy())))
            pack = zstandard.ZstdCompressor(level=3)
            for lo, _, _, found in _sets(b.column("text")):
                texts = b.column("text").slice(lo, len(found)).cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_pydict({"node": pa.array([_set_id(s) for s in found], pa.binary()),
                                                  "packed": pa.array([pack.compress(t or b"") for t in texts], pa.binary())})

    built = own.mapInArrow(build, "node binary, packed binary").join(wanted.drop("rep"), "node")
    exact = (_dealt(built, "family", "n", EXACT).select("group", "own", "i", "j", "node", "copies", "packed")
             .repartition("group").sortWithinPartitions("group", "node"))
    found = stored(exact.mapInArrow(lambda it: _compare_sets(it, threshold), "a binary, b binary, n long"))
    counts = found.filter(F.col("n") > 0).groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    comps = components(found.filter(F.col("n") == 0), "a", "b")
    placed = stored(sets.select("node", "rep", "copies").join(counts, "node", "left").join(comps, "node", "left")
                    .select("node", "rep", F.coalesce("component", "node").alias("root"),
                            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")))
    heads = stored(placed.groupBy("root").agg(F.min("rep").alias("class_id")))
    info = stored(placed.join(heads, "root").select("node", "class_id", "links"))
    out = described.select("doc_id", "node", "size").join(info, "node", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                      F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      F.col("size").cast("long").alias("n_shingles"), "node")


def _with_node(docs: DataFrame) -> DataFrame:
    """``docs`` with __node, the id of the set of each text (also where nothing links)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_set_id(x) for _, _, _, sets in _sets(b.column("text")) for x in sets]
            yield pa.RecordBatch.from_pydict(dict(zip(b.schema.names, b.columns)) | {"__node": pa.array(found, pa.binary())})

    return docs.mapInArrow(run, docs.select("*").schema.add("__node", "binary"))


def keep_one(docs: DataFrame, threshold: float = JACCARD, recall: float = RECALL) -> DataFrame:
    """``docs`` without the rows whose class has a smaller doc_id; of rows that share the smallest
    doc_id and a text the smallest by their other columns stays. Columns are unchanged."""
    found = _joined(docs, threshold, recall)
    gone = stored(found.filter(F.col("doc_id") != F.col("class_id"))
                  .select(F.col("doc_id").alias("__gone"), F.col("node").alias("__gone_node")).distinct())
    again = stored(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n")).filter((F.col("__n") > 1) & F.col("doc_id").isNotNull())
                   .select(F.col("doc_id").alias("__again")))
    same_id = F.col("doc_id") == F.col("__gone")
    if not again.limit(1).count():                          # ids are unique, the usual case
        return docs.join(gone, same_id, "left_anti")
    single = docs.join(again, F.col("doc_id") == F.col("__again"), "left_anti").join(gone, same_id, "left_anti")
    shared = _with_node(docs.join(again, F.col("doc_id") == F.col("__again"), "left_semi"))
    shared = shared.join(gone, same_id & (F.col("__node") == F.col("__gone_node")), "left_anti")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    least = shared.groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("__first"), *others)).alias("__least"))
    return single.unionByName(least.select(*[c if c in ("doc_id", "text") else F.col(f"__least.{c}").alias(c) for c in docs.columns]))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, class_id, n_links, n_shingles."""
    return jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))
