"""Conversation prefix trie (operator 12): padded turn-id matrices, sorted and aggregated by depth.

A turn's id is the MD5 of its role and text. A conversation is cut into bands of ``BAND`` turns, so
that no row grows with it. Conversations with equal turns are one class with a count. The rows of a
band are those classes whose turns before the band are shared with another class; they are sorted
by range over (turns before the band, turn ids), and each run of at most ``ROWS`` sorted rows becomes
a matrix of turn ids, zero where a conversation has ended. numpy lexsorts it; where a column differs
from the row above, a change mask is set, and OR-accumulated along the row it marks where a node of
each depth starts. ``reduceat`` between the marks gives counts and smallest ids at every depth;
sums over subtrees are running sums from the deepest column, reduced in the same way.

A node on the path of a run's first or last row may go on in the next run. Such boundary nodes are
handed on with what hangs below them and recombined by path: equal paths are added up, and what each
owns is added to all boundary nodes above it. Bands are worked off from the deepest, since a band's
totals belong to the node above it. A class that shares its turns with no other one has a chain of
nodes below, whose figures are sums over its later bands, so bands without sharing need no matrix.
Rounds grow with the longest prefix that two different conversations share, divided by BAND.

Positions of turns come from a range sort: each task counts from its own start, and a small table of
counts by task is added, so one conversation may be spread over many tasks. The ids of
conversations that end at a node are packed into sorted texts of at most ``IDS`` ids before they are
shuffled and stream through SHA-256, which takes them one after another by its nature.

Cases: a NULL role or text is empty; a NULL turn comes first; turns of one conversation with equal
numbers are ordered by role, then text, and equal rows all count. Rows with a NULL conv_id take no
part. A conversation may be without turns once rebuilt; it is then a member of the root alone. An
empty table has no nodes. Only conv_id, turn, role and text are read, so other columns clash with
nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

BAND = 32                                                  # turns of a matrix row
ROWS = 1 << 14                                             # matrix rows handled at once
IDS = 4096                                                 # conversation ids of one packed text
FAMILY = 20                                                # conversations that share a base
TURN = "conv_id long, home int, at long, tid binary, words long"
NODE = ("key binary, above binary, path array<binary>, pre binary, depth int, conv_id long, parent_conv_id long, n_convs long, "
        "n_children long, n_leaves long, saved_tokens long, words long, end_rep long, edge boolean")


def placed_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, tid, words): every turn with its position in its conversation, from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    tid = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    sorted_turns = (turns.repartitionByRange(*order).sortWithinPartitions(*order)
                    .select("conv_id", F.spark_partition_id().alias("home"), tid.alias("tid"),
                            F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            c = b.column("conv_id").to_numpy()
            new = np.concatenate(([c[0] != last], c[1:] != c[:-1]))
            start = np.maximum.accumulate(np.where(new, np.arange(len(c)), -1))
            at = np.where(start < 0, seen + np.arange(len(c)), np.arange(len(c)) - start)
            last, seen = c[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_pydict({"conv_id": b.column("conv_id"), "home": b.column("home"), "at": pa.array(at),
                                              "tid": b.column("tid"), "words": b.column("words")})

    local = stored(sorted_turns.mapInArrow(count, TURN))
    pieces = local.groupBy("conv_id", "home").agg(F.count(F.lit(1)).alias("n"))
    # only a conversation that lies in several tasks needs an offset: two rows a task at most
    spread = pieces.withColumn("homes", F.count(F.lit(1)).over(Window.partitionBy("conv_id"))).filter("homes > 1")
    w = Window.partitionBy("conv_id").orderBy("home").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(spread.select("conv_id", "home", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before")))
    return (local.join(before, ["conv_id", "home"], "left")
            .select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "tid", "words"))


def rebuilt_turns(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, pos, tid, words) of the rebuilt conversations, (conv_id, len) of all of them)."""
    convs = stored(placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
                   .withColumn("h", F.crc32(F.col("conv_id").cast("string")) % 4)
                   .withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY))
    bases = convs.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = stored(convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("head"), "n")
        .withColumn("len", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    own = (placed.join(convs.select("conv_id", "h", "head"), "conv_id").filter(F.col("pos") >= F.col("h"))
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "tid", "words"))
    opening = placed.filter((F.col("pos") < 3) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    head = (opening.join(convs.select("conv_id", "base", "h"), "base").filter(F.col("pos") < F.col("h"))
            .select("conv_id", "pos", "tid", "words"))
    return own.unionByName(head), convs.select("conv_id", "len")


def classes_of(turns: DataFrame, convs: DataFrame, width: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bands of each class, (conv_id, len, s1, s2) of all conversations, (s1, s2, rep, n, len) of classes).

    s1 and s2 identify a whole sequence, p1 and p2 all turns before a band: XORs of two hashes of
    each band's ids and place, which need no order.
    """
    bands = turns.groupBy("conv_id", F.floor(F.col("pos") / width).cast("int").alias("band")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "tid", "words"))).alias("t"))        # at most width turns
    bands = stored(bands.select("conv_id", "band", F.col("t.tid").alias("ids"), F.col("t.words").alias("words"))
                   .withColumn("d", F.md5(F.concat(F.col("band").cast("string"), F.lit(":"), F.hex(F.array_join(F.transform("ids", F.hex), ""))))))
    h1, h2 = F.xxhash64("d"), F.xxhash64(F.concat(F.lit("2"), F.col("d")))
    whole = bands.groupBy("conv_id").agg(F.bit_xor(h1).alias("s1"), F.bit_xor(h2).alias("s2"))
    members = stored(convs.join(whole, "conv_id", "left").select(
        "conv_id", "len", F.coalesce("s1", F.lit(0)).cast("long").alias("s1"), F.coalesce("s2", F.lit(0)).cast("long").alias("s2")))
    classes = stored(members.groupBy("s1", "s2", "len").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    before = Window.partitionBy("rep").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("rep").orderBy("band").rowsBetween(1, Window.unboundedFollowing)
    own = bands.join(classes.select(F.col("rep").alias("conv_id"), "n", "len"), "conv_id").withColumnRenamed("conv_id", "rep")
    own = own.select("rep", "n", "len", "band", "ids", "words",
                     F.coalesce(F.bit_xor(h1).over(before), F.lit(0)).alias("p1"),
                     F.coalesce(F.bit_xor(h2).over(before), F.lit(0)).alias("p2"),
                     F.coalesce(F.sum(F.aggregate("words", F.lit(0).cast("long"), lambda a, x: a + x)).over(after), F.lit(0)).alias("rest"))
    # a class that ends with a full band is a member of the node that later bands hang below
    ended = classes.filter((F.col("len") % width == 0) & (F.col("len") > 0)).select(
        (F.col("len") / width).cast("int").alias("band"), F.col("s1").alias("p1"), F.col("s2").alias("p2"), "rep")
    sharing = (own.select("band", "p1", "p2", "rep").unionByName(ended).groupBy("band", "p1", "p2")
               .agg(F.count(F.lit(1)).alias("sharing"), F.min("rep").alias("top")))
    root = classes.agg(F.min("rep").alias("root"))              # one row
    own = (own.join(sharing, ["band", "p1", "p2"]).join(F.broadcast(root), F.lit(True))
           .withColumn("top", F.when(F.col("band") == 0, F.col("root")).otherwise(F.col("top"))).drop("root"))
    # classes of the first band all share the root
    return stored(own.withColumn("matrix", (F.col("band") == 0) | (F.col("sharing") > 1))), members, classes


# ------------------------------------------------------------------ one run of sorted rows

def _common(mat: np.ndarray, pre: np.ndarray, row: int) -> np.ndarray:
    """How many leading turns each row shares with ``row`` of its own prefix (0 for other prefixes)."""
    same = (mat == mat[row]) & (mat[row] > 0) & (pre == pre[row])[:, None]
    return np.logical_and.accumulate(same, axis=1).sum(axis=1)


def run_nodes(t: pa.Table, band_width: int) -> dict[str, list]:
    """Nodes of a run of sorted rows (pre, ids, words, rep, n, top and what hangs below the band)."""
    pre_of, ids_of = t.column("pre").to_pylist(), t.column("ids").to_pylist()
    rep, n, top = (t.column(c).to_numpy() for c in ("rep", "n", "top"))
    size = np.array([len(x) for x in ids_of])
    rows, width = len(size), max(int(size.max()), 1)
    flat = np.array([x for ids in ids_of for x in ids], dtype="S16")
    inside = np.arange(width) < size[:, None]
    mat = np.zeros((rows, width), np.int64)
    mat[inside] = np.unique(flat, return_inverse=True)[1] + 1    # turn ids by the order of their bytes
    words = np.zeros((rows, width), np.int64)
    words[inside] = [w for ws in t.column("words").to_pylist() for w in ws]
    pre = np.unique(np.array([x.hex() for x in pre_of]), return_inverse=True)[1]
    ends = t.column("ends").to_numpy(zero_copy_only=False)
    order = np.lexsort((~ends, *mat.T[::-1], pre))                # of equal rows the one that ends in this band comes first
    mat, words, pre, rep, n, top, size, inside = (x[order] for x in (mat, words, pre, rep, n, top, size, inside))
    below = {c: t.column(c).to_numpy()[order] for c in ("t_children", "t_leaves", "t_saved")}
    ends = ends[order]

    change = np.ones((rows, width), bool)
    change[1:] = (mat[1:] != mat[:-1]) | (pre[1:] != pre[:-1])[:, None]
    mark = np.logical_or.accumulate(change, axis=1)               # a node, or padding, of each depth starts here
    real = mark & inside
    starts = [np.flatnonzero(mark[:, d]) for d in range(width)]
    count, least, kids = (np.zeros((rows, width), np.int64) for _ in range(3))
    for d, at in enumerate(starts):
        count[at, d] = np.add.reduceat(n, at)
        least[at, d] = np.minimum.reduceat(rep, at)
        if d + 1 < width:
            kids[at, d] = np.add.reduceat(real[:, d + 1].astype(np.int64), at)
    last = size == band_width                                           # the next band hangs below the last column
    if last.any():
        at = starts[width - 1]
        kids[at, width - 1] = np.where(inside[at, width - 1], np.add.reduceat(np.where(last, below["t_children"], 0), at), 0)
    edge = np.arange(width) < np.maximum(_common(mat, pre, 0), _common(mat, pre, rows - 1))[:, None]
    inner, border = real & ~edge, real & edge
    # what nodes own, at their start; a border node counts later, when its parts are together
    leaf = np.where(inner & (kids == 0), 1, 0)
    saved = np.where(inner, (count - 1) * words, 0)
    more_leaf, more_saved = (np.where(last, below[c], 0) for c in ("t_leaves", "t_saved"))
    sums = {}
    for name, own, more in (("leaves", leaf, more_leaf), ("saved", saved, more_saved)):
        deep = np.cumsum(own[:, ::-1], axis=1)[:, ::-1] + more[:, None]
        total = np.zeros((rows, width), np.int64)
        for d, at in enumerate(starts):
            total[at, d] = np.add.reduceat(np.where(inside[:, d], deep[:, d], 0), at)
        sums[name] = total
    # a border node keeps only what hangs below it and below no deeper border node
    reach = edge.sum(axis=1)                                      # depth of the border path that a row shares
    path_last = _common(mat, pre, rows - 1) >= _common(mat, pre, 0)
    raw = t.column("pre").to_pylist()
    out: dict[str, list] = {c.strip().split(" ")[0]: [] for c in NODE.split(",")}
    ids_sorted = [ids_of[i] for i in order]
    pre_sorted = [raw[i] for i in order]

    def keys(row: int, depth: int) -> list[bytes]:
        """Keys of the nodes on a row's path down to ``depth``."""
        made, state = [], hashlib.blake2b(pre_sorted[row], digest_size=16)
        for x in ids_sorted[row][:depth]:
            state.update(x)
            made.append(state.copy().digest())
        return made

    paths = {0: keys(0, int(size[0])), rows - 1: keys(rows - 1, int(size[-1]))}
    held: dict[bytes, np.ndarray] = {}
    for end, mine in ((0, ~path_last), (rows - 1, path_last)):
        for d in range(len(paths[end])):
            # rows whose nearest border node is this one: they share the path down to here, no deeper border
            rest = mine & (reach == d + 1) & inside[:, d] & (pre == pre[end])
            kids_here = inner[rest, d + 1].sum() if d + 1 < width else below["t_children"][rest & last].sum()
            own = np.array([kids_here, leaf[rest].sum() + more_leaf[rest].sum(), saved[rest].sum() + more_saved[rest].sum()])
            held[paths[end][d]] = held.get(paths[end][d], 0) + own  # both paths may run through it
    row_at, depth_at = np.nonzero(real)
    parent = _parents(mark, least, top)
    for r, d in zip(row_at.tolist(), depth_at.tolist()):
        is_edge = bool(border[r, d])
        key = above = None
        path: list[bytes] = []
        children, leaves, spared = int(kids[r, d]), int(sums["leaves"][r, d]), int(sums["saved"][r, d])
        over = d and edge[r, d - 1]                               # its parent is a border node
        if is_edge or over:
            end = rows - 1 if path_last[r] else 0
            path = paths[end][:d]
            above = path[-1] if path else None
            if is_edge:
                key = paths[end][d]
                children, leaves, spared = map(int, held[key])
        out["key"].append(key)
        out["above"].append(above)
        out["path"].append(path if is_edge else None)
        out["pre"].append(pre_sorted[r])
        out["depth"].append(d + 1)
        out["conv_id"].append(int(least[r, d]))
        out["parent_conv_id"].append(None if over else int(parent[r, d]))
        out["n_convs"].append(int(count[r, d]))
        out["n_children"].append(children)
        out["n_leaves"].append(leaves)
        out["saved_tokens"].append(spared)
        out["words"].append(int(words[r, d]))
        out["end_rep"].append(int(rep[r]) if size[r] == d + 1 and ends[r] else None)
        out["edge"].append(is_edge)
    return out


def _parents(mark: np.ndarray, least: np.ndarray, top: np.ndarray) -> np.ndarray:
    """At each node's start the smallest member of the node above it."""
    out = np.empty(mark.shape, np.int64)
    out[:, 0] = top
    for d in range(1, mark.shape[1]):
        start = np.maximum.accumulate(np.where(mark[:, d - 1], np.arange(len(mark)), 0))
        out[:, d] = least[start, d - 1]
    return out


_KINDS = {"key": pa.binary(), "above": pa.binary(), "path": pa.list_(pa.binary()), "pre": pa.binary(), "depth": pa.int32(), "edge": pa.bool_()}


def _runs(batches: Iterator[pa.RecordBatch], width: int, rows: int) -> Iterator[pa.RecordBatch]:
    held, have, step = [], 0, -(-rows // 4)
    for b in batches:
        for lo in range(0, b.num_rows, step):
            part = b.slice(lo, step)
            held.append(part)
            have += part.num_rows
            if have >= rows:
                yield _nodes(held, width)
                held, have = [], 0
    if have:
        yield _nodes(held, width)


def _nodes(held: list[pa.RecordBatch], width: int) -> pa.RecordBatch:
    found = run_nodes(pa.Table.from_batches(held).combine_chunks(), width)
    return pa.RecordBatch.from_pydict({c: pa.array(v, _KINDS.get(c, pa.int64())) for c, v in found.items()})


# ------------------------------------------------------------------ recombination

def recombine(parts: DataFrame) -> DataFrame:
    """Whole nodes of a band from the parts that its runs gave."""
    edges = parts.filter("edge").groupBy("key").agg(
        F.first("above").alias("above"), F.first("path").alias("path"), F.first("pre").alias("pre"), F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.min("parent_conv_id").alias("parent_conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
        F.first("words").alias("words"), F.max("end_rep").alias("end_rep"))
    edges = stored(edges)
    kids = edges.filter(F.col("above").isNotNull()).groupBy(F.col("above").alias("key")).agg(F.count(F.lit(1)).alias("edge_kids"))
    edges = stored(edges.join(kids, "key", "left").withColumn("n_children", F.col("kids") + F.coalesce("edge_kids", F.lit(0)))
                   .withColumn("own_leaves", F.col("leaves") + (F.col("n_children") == 0).cast("long"))
                   .withColumn("own_saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("words")))
    sums = (edges.select(F.explode(F.concat(F.array("key"), "path")).alias("key"), "own_leaves", "own_saved")
            .groupBy("key").agg(F.sum("own_leaves").alias("n_leaves"), F.sum("own_saved").alias("saved_tokens")))
    tops = edges.select(F.col("key").alias("above"), F.col("conv_id").alias("above_conv"))
    out = ["pre", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_rep"]
    whole = edges.select("key", "above", "pre", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "end_rep").join(sums, "key")
    both = parts.filter("not edge").select("above", *out).unionByName(whole.select("above", *out))
    return (both.join(tops, "above", "left").withColumn("parent_conv_id", F.coalesce("above_conv", "parent_conv_id")).select(*out))


def band_nodes(rows: DataFrame, below: DataFrame | None, band: int, width: int, run_rows: int) -> tuple[DataFrame, DataFrame]:
    """(nodes of a band, totals of the nodes right below each shared prefix: top, children, leaves, saved)."""
    chain = F.col("len") > (band + 1) * width
    rows = rows.withColumn("ends", F.col("len") <= (band + 1) * width)
    alone = {"t_children": chain.cast("long"), "t_leaves": chain.cast("long"),
             "t_saved": F.when(chain, (F.col("n") - 1) * F.col("rest")).otherwise(F.lit(0)).cast("long")}
    if below is None:
        rows = rows.withColumns(alone)
    else:
        # what a shared prefix goes on with hangs below its smallest class alone
        rows = rows.join(below, "rep", "left").withColumns({c: F.coalesce("b" + c[1:], F.when(F.col("deeper"), F.lit(0)).otherwise(x)).cast("long")
                                                            for c, x in alone.items()})
    key = F.concat(F.unhex(F.lpad(F.hex("p1"), 16, "0")), F.unhex(F.lpad(F.hex("p2"), 16, "0")))
    rows = rows.select(key.alias("pre"), "ids", "words", "rep", "n", "top", "ends", "t_children", "t_leaves", "t_saved")
    line = F.unhex(F.array_join(F.transform("ids", F.hex), ""))
    ordered = rows.withColumn("line", line).repartitionByRange("pre", "line").sortWithinPartitions("pre", "line").drop("line")
    parts = stored(ordered.mapInArrow(lambda it: _runs(it, width, run_rows), NODE))
    nodes = stored(recombine(parts).withColumn("depth", F.col("depth") + band * width))
    first = nodes.filter(F.col("depth") == band * width + 1).groupBy(F.col("parent_conv_id").alias("rep")).agg(
        F.count(F.lit(1)).alias("b_children"), F.sum("n_leaves").alias("b_leaves"), F.sum("saved_tokens").alias("b_saved"))
    return nodes, stored(first)


def chain_nodes(rows: DataFrame, width: int) -> DataFrame:
    """Nodes of classes below the last turn that they share with another one."""
    i = F.col("i") + 1                                        # from 1 in the band
    depth = F.col("band") * width + i
    later = F.aggregate(F.slice("words", i, width), F.lit(0).cast("long"), lambda a, x: a + x) + F.col("rest")
    one = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("ids") - 1)))
    return one.select(depth.cast("int").alias("depth"), F.col("rep").alias("conv_id"), F.col("rep").alias("parent_conv_id"),
                      F.col("n").alias("n_convs"), (depth < F.col("len")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                      ((F.col("n") - 1) * later).alias("saved_tokens"), F.when(depth == F.col("len"), F.col("rep")).alias("end_rep"))


def end_hashes(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(end_rep, ends_sha256): the hash of the ids of each class in ascending order, joined by commas."""
    key = ["s1", "s2", "len"]
    packed = (members.groupBy(*key, F.floor(F.col("conv_id") / IDS).alias("shelf"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            found = []
            for *k, ids in zip(*(b.column(c).to_pylist() for c in (*key, "ids"))):
                if k != now:
                    if now is not None:
                        found.append((*now, state.hexdigest()))
                    now, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield rows(found)
        if now is not None:
            yield rows([(*now, state.hexdigest())])

    def rows(found: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*found)) if found else [[]] * 4
        return pa.RecordBatch.from_pydict(dict(zip((*key, "ends_sha256"), (
            *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())))))

    hashed = (packed.repartition(*key).sortWithinPartitions(*key, "shelf")
              .mapInArrow(digest, "s1 long, s2 long, len long, ends_sha256 string"))
    return hashed.join(classes, key).select(F.col("rep").alias("end_rep"), "ends_sha256")


def prefix_trie(rows: DataFrame, width: int = BAND, run_rows: int = ROWS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (conv_id, turn, role, text).

    ``width`` turns make a band, at least 2; ``run_rows`` sorted rows make a matrix.
    """
    turns, convs = rebuilt_turns(stored(placed_turns(rows)))
    bands, members, classes = classes_of(turns, convs, width)
    shared = bands.filter("matrix")
    deepest = shared.agg(F.max("band")).first()[0]
    cols = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_rep"]
    out, below = chain_nodes(bands.filter("not matrix"), width), None
    for band in range(deepest if deepest is not None else -1, -1, -1):
        own = shared.filter(F.col("band") == band)
        if below is not None:
            goes_on = shared.filter(F.col("band") == band + 1).select("rep", F.lit(True).alias("deeper"))
            own = own.join(goes_on, "rep", "left").withColumn("deeper", F.coalesce("deeper", F.lit(False)))
        nodes, below = band_nodes(own, below, band, width, run_rows)
        out = out.unionByName(nodes.select(*cols))
    total = classes.agg(F.min("rep").alias("conv_id"), F.sum("n").alias("n_convs"), F.min(F.when(F.col("len") == 0, F.col("rep"))).alias("end_rep"))
    tops = (below.agg(F.sum("b_children").alias("c"), F.sum("b_leaves").alias("l"), F.sum("b_saved").alias("s")) if below is not None
            else total.select(*(F.lit(None).cast("long").alias(x) for x in "cls")))
    root = total.filter("n_convs > 0").join(F.broadcast(tops), F.lit(True)).select(   # one row with one row
        F.lit(0).alias("depth"), "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        F.coalesce("c", F.lit(0)).alias("n_children"), F.coalesce("l", F.lit(1)).alias("n_leaves"),
        F.coalesce("s", F.lit(0)).alias("saved_tokens"), "end_rep")
    hashes = end_hashes(members, classes)
    return (out.unionByName(root).join(hashes, "end_rep", "left")
            .select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    return prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


OP12_SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, n,
         xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(s) + 1), lambda i:
               list_transform(range(0, 8), lambda j: ((ascii(s[i]) >> j::INTEGER) & 1)::BIGINT)))),
             lambda a, b: xor(a >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 4 AS h
  FROM (SELECT conv_id, count(*) AS n, conv_id::VARCHAR AS s FROM t GROUP BY conv_id)),
r AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
q AS (
  SELECT c.conv_id, coalesce(list(struct_pack(role := r.role, text := r.text) ORDER BY r.part, r.pos) FILTER (r.pos IS NOT NULL), []) AS turns
  FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
p AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM q),
m AS (SELECT conv_id, depth, turns[1:depth] AS pre, turns[1:depth - 1] AS up, len(turns) = depth AS ends FROM p),
n AS (
  SELECT pre, any_value(up) AS up, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY pre, depth),
k AS (SELECT up AS pre, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
o AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children,
         CASE WHEN depth > 0 THEN (n_convs - 1) * len(regexp_extract_all(n.pre[-1].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
  FROM n LEFT JOIN k USING (pre, depth)),
s AS (
  SELECT pre[1:d] AS pre, d AS depth, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM o) GROUP BY pre[1:d], d)
SELECT o.conv_id, o.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens, o.ends_sha256
FROM o JOIN s ON s.pre = o.pre AND s.depth = o.depth LEFT JOIN n u ON o.depth > 0 AND u.pre = o.up AND u.depth = o.depth - 1
"""
