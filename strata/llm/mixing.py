"""Mixing sources to target weights (operator 2): entropy balancing of document rates.

Every document gets a rate, the expected number of copies in the mix. Of all rates that give each
source its target number of words, the ones nearest to the base rates in entropy are exponential tilts
by the document's size, ``min(cap, base * exp(lam * size / mean size of the source))``, with one dual
variable for each source's word constraint. The convex dual is solved by Newton steps from lam = 0: one
aggregate gives every source's gradient and curvature, and all sources step at once. Documents of one
source with one base rate and size share their rate, so the steps run over counts by (source, base, size).
The cap bends the dual, so each source also keeps the bounds that its steps have shown; a step that
leaves them is halved into them. Sums are exact decimals: a rerun finds the same rates to the last bit.

Rates become whole copies by diffusing the rounding error over blocks of a source's documents, from
the longest to the shortest. A document gets its rate rounded down or up, so copies stay within
the cap, and a block misses its words by about its shortest document at most. Blocks hold about
``BLOCK`` documents whatever the size of the source, so a hot source is spread over many tasks.

Targets: the sources by code point, NULL last, weigh 1, 2, 3, 1, 2, 3, ... and share all words.
No target passes ``cap`` times its source's words; the excess goes to the others by weight.

Cases: NULL text has no words. A NULL source is a source of its own. A document without words
keeps its base rate (one copy, which takes no words). A source without words has target 0. Rows that share a doc_id are mixed one by one in
``mix`` and as one document in ``apply_mix``. An empty table gives an empty result.
Only the named columns are read, so others clash with nothing; ``apply_mix`` hands them on. Rounding
carries the remainder from row to row of a block in a fixed order, so of equal rows one may be taken
more often than another, but a rerun takes the same number in all.
"""

from __future__ import annotations

import math

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

CAP = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
BLOCK = 2000                                                # documents rounded together, about
STEPS = 60                                                  # Newton steps at most
CLOSE = 1e-9                                                # relative error that ends them
EXACT = "decimal(38,10)"                                    # sums of it don't depend on the order of rows


def words(text: str) -> Column:
    """Number of runs of bytes outside [\\x20\\x09-\\x0D]."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def indexed(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` with its 0-based position in ``order``, without gathering the rows in one task."""
    spark = df.sparkSession
    held = stored(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    counts = sorted((r["__part"], r["n"]) for r in held.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, at = [], 0
    for part, n in counts:                                  # one number for each partition
        offsets.append((part, at))
        at += n
    starts = spark.createDataFrame(offsets, "__part int, __start long")
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return (held.join(F.broadcast(starts), "__part").withColumn(out, F.col("__start") + rank - 1)
            .drop("__part", "__start"))


def targets(sources: DataFrame, cap: float = CAP, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(source, words, docs) with ``target``: shares by weight, at most ``cap`` times the words."""
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("__at") % len(weights) + 1).cast("int"))
    ranked = stored(indexed(sources, [F.col("source").asc_nulls_last()], "__at").withColumn("__w", w))
    most = F.col("words") * F.lit(cap)
    total = ranked.agg(F.sum("words")).first()[0] or 0
    level, capped = 0.0, -1
    while True:                                             # each round caps at least one source more
        above = F.col("__w") * F.lit(level) > most
        r = ranked.agg(F.sum(F.when(above, most).otherwise(0.0)).alias("full"), F.count_if(above).alias("n"),
                       F.sum(F.when(~above, F.col("__w")).otherwise(0.0)).alias("open")).first()
        if r["n"] == capped or not r["open"]:
            break
        capped, level = r["n"], (total - r["full"]) / r["open"]
    share = F.col("__w") * F.lit(level)
    return ranked.withColumn("target", F.least(share, most)).drop("__at", "__w")


def solve(cells: DataFrame, wanted: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, words, docs, target, lam, steps): dual variables whose tilted rates meet the targets.

    ``cells``: (source, base, size, n), base > 0, one row for the n documents of a source that share
    both. ``steps`` counts the Newton steps a source took. Raises ValueError when one is still off.
    """
    full = F.col("target") >= F.col("words") * F.lit(cap) * (1 - 1e-12)
    lam = F.when(F.col("target") <= 0, F.lit(-math.inf)).when(full, F.lit(math.inf)).otherwise(F.lit(0.0))
    state = stored(wanted.withColumns({"lam": lam, "__low": F.lit(-math.inf), "__high": F.lit(math.inf),
                                       "steps": F.lit(0).cast("long"), "__moved": F.abs(lam) != math.inf}))
    cells = cells.filter("size > 0").select(F.col("source").alias("__s"), "base", "size", "n")
    for _ in range(STEPS):
        open_ = state.filter("__moved").select("source", "lam", (F.col("words") / F.col("docs")).alias("__mean"))
        rate = tilted(F.col("base"), F.col("lam"), F.col("size") / F.col("__mean"), cap)
        got = rate * F.col("size") * F.col("n")
        curve = F.when(rate < cap, got * F.col("size") / F.col("__mean")).otherwise(0.0)
        now = (cells.join(open_, F.col("__s").eqNullSafe(F.col("source"))).groupBy("__s")
               .agg(F.sum(got.cast(EXACT)).cast("double").alias("__got"), F.sum(curve.cast(EXACT)).cast("double").alias("__curve")))
        state = stored(_step(state.join(now, F.col("source").eqNullSafe(F.col("__s")), "left")))
        if not state.filter("__moved").limit(1).count():
            return state.drop("__low", "__high", "__moved")
    raise ValueError(f"a source is still off its target after {STEPS} steps")


def _step(state: DataFrame) -> DataFrame:
    """Each open source one Newton step on ln(words taken / target), kept within its known bounds."""
    off, at = F.col("__got") - F.col("target"), F.col("lam")
    moved = F.col("__moved") & (F.abs(off) > F.col("target") * CLOSE)
    low = F.when(moved & (off < 0), at).otherwise(F.col("__low"))
    high = F.when(moved & (off > 0), at).otherwise(F.col("__high"))
    newton = at - F.try_divide(F.col("__got"), F.col("__curve")) * F.ln(F.col("__got") / F.col("target"))
    inside = F.coalesce((newton > low) & (newton < high), F.lit(False))
    beyond = (F.when(high == math.inf, 2 * at + 1).when(low == -math.inf, 2 * at - 1).otherwise((low + high) / 2))
    return (state.withColumns({"__low": low, "__high": high, "__to": F.when(inside, newton).otherwise(beyond), "__moved": moved})
            .withColumns({"lam": F.when(F.col("__moved"), F.col("__to")).otherwise(at),
                          "steps": F.col("steps") + F.col("__moved").cast("long")})
            .drop("__s", "__got", "__curve", "__to"))


def tilted(base: Column, lam: Column, size: Column, cap: float) -> Column:
    """Rate of a document whose size is ``size`` times the mean of its source; base where it has none."""
    return F.when(size > 0, F.least(F.lit(float(cap)), base * F.exp(lam * size))).otherwise(F.least(F.lit(float(cap)), base))


def _diffuse(group: pa.Table) -> pa.Table:
    """Whole copies near the rates, with the error carried from document to document."""
    group = group.take(pc.sort_indices(group, sort_keys=[("size", "descending"), ("doc_id", "ascending")]))
    err, copies = 0.0, []
    for n, rate, cap in zip(*(group.column(c).to_pylist() for c in ("size", "rate", "cap"))):
        low = math.floor(rate + 1e-9)
        high = min(math.ceil(rate - 1e-9), int(cap))
        k = min(max(round((err + rate * n) / n), low), max(high, low)) if n else low
        err += (rate - k) * n
        copies.append(k)
    return group.append_column("copies", pa.array(copies, pa.int64())).select(
        ["doc_id", "size", "source_size", "target", "rate", "copies"])


def mix(sized: DataFrame, cap: float = CAP, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """(doc_id, source, size[, base]) -> doc_id, size, source_size, target, rate, copies."""
    sized = sized if "base" in sized.columns else sized.withColumn("base", F.lit(1.0))
    sized = stored(sized.select("doc_id", "source", "size", "base"))
    cells = stored(sized.groupBy("source", "base", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("docs"))
    rates = solve(cells, targets(sources, cap, weights), cap).select(
        F.col("source").alias("__s"), F.col("words").alias("source_size"), "docs", "target", "lam")
    share = F.try_divide(F.col("size") * F.col("docs"), F.col("source_size"))
    rate = tilted(F.col("base"), F.col("lam"), F.coalesce(share, F.lit(0.0)), cap)
    rows = (sized.join(rates, F.col("source").eqNullSafe(F.col("__s")))
            .withColumn("rate", rate).withColumn("cap", F.lit(float(cap)))
            .withColumn("__block", F.pmod(F.xxhash64("doc_id", "size"), F.ceil(F.col("docs") / BLOCK))))
    kind = sized.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("source", "__block").applyInArrow(
        _diffuse, f"doc_id {kind}, size long, source_size long, target double, rate double, copies long")


def apply_mix(docs: DataFrame, cap: float = CAP, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The mixed ``docs``: every row as often as the mix takes it, columns unchanged."""
    one = docs.groupBy("doc_id").agg(F.sum(words("text")).alias("size"), F.min("source").alias("source"))
    taken = mix(one, cap, weights).filter(F.col("copies") > 0).select(
        F.col("doc_id").alias("__mix_id"), F.col("copies").alias("__copies"))
    held = docs.join(taken, F.col("doc_id").eqNullSafe(F.col("__mix_id")))
    return (held.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
            .select(*[held[c] for c in docs.columns]))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, and its rate and copies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words("text").alias("size"))
    return mix(docs).select("doc_id", "size", "source_size", "target",
                            (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies")
