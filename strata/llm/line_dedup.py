"""Line dedup (operator 4): repeated lines go, except in the largest document that holds them.

Two Bloom filters over the hashes of the line keys: one of keys seen once, one of keys seen twice.
Every task fills a pair for its own documents, the pairs are merged slice by slice, and the merged
"twice" filter (a fixed number of bits, chosen from the line count and bounded by ``max_bits``) is
the only thing sent to all tasks. Lines whose key is not in it are unique and never move. The
suspected rest is shuffled by key for the exact count and the choice of the surviving document,
so false positives of the filter cost a little shuffle and never change the result.

Cases: a NULL or empty text is one empty line. Lines whose key is shorter than ``min_chars`` code
points always stay. A key counts once per document, however often it stands in it, and all its
lines in a document share one fate. Rows that share a doc_id are one document for the choice, and
each row is rebuilt by itself. A NULL doc_id counts as one document that is never the largest.
There are no ties: the largest doc_id is one document. An empty table gives an empty result. Other
columns stay; only names beginning with __ (the two counts, and helpers) are the operator's own.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_BYTES, stored, table
from .shingles import mix

HASHES = 3                                                  # bits per key in a filter
BITS_PER_LINE = 24                                          # about 1 unique key in 600 is suspected
SLICES = 16                                                 # parts in which filters are merged
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE_BYTES).translate(_LOWER)


def long_keys(text: bytes | None, min_chars: int) -> set[bytes]:
    """The distinct keys of a text that have at least ``min_chars`` code points."""
    keys = (line.strip(SPACE_BYTES) for line in (text or b"").translate(_LOWER).split(b"\n"))
    return {k for k in keys if len(k) >= min_chars
            and (len(k) >= 4 * min_chars or k.isascii() or len(k.decode("utf-8", "replace")) >= min_chars)}


def positions(keys: list[bytes], bits: int) -> np.ndarray:
    """The HASHES filter positions of each key, one row per key."""
    h = np.frombuffer(b"".join(hashlib.blake2b(k, digest_size=8).digest() for k in keys), np.uint64)
    step = mix(h) | np.uint64(1)
    i = np.arange(HASHES, dtype=np.uint64)
    return ((h[:, None] + i * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def filter_bits(docs: DataFrame, text: str, max_bits: int) -> int:
    """A power of two of about BITS_PER_LINE bits for each line that can count."""
    n = docs.agg(F.sum(F.octet_length(text)).alias("b"), F.sum(
        F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit("")))).alias("n"),
        F.count(F.lit(1)).alias("d")).first()
    lines = min((n["n"] or 0) + n["d"], (n["b"] or 0) // 40) + 1
    return min(max_bits, max(1 << 16, 1 << (BITS_PER_LINE * lines - 1).bit_length()))


def twice_filter(docs: DataFrame, bits: int, min_chars: int) -> np.ndarray:
    """The merged filter of keys seen in two documents or more, packed eight bits a byte."""
    part = bits // 8 // SLICES

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        seen = False
        for b in batches:
            keys = [k for t in _texts(b) for k in long_keys(t, min_chars)]
            if not keys:
                continue
            seen = True
            counts: dict[bytes, int] = {}
            for k in keys:
                counts[k] = counts.get(k, 0) + 1
            pos = positions(list(counts), bits)
            again = np.fromiter(counts.values(), np.int64, len(counts)) > 1
            byte, bit = pos >> 3, (np.uint8(1) << (pos & 7).astype(np.uint8))
            again |= ((once[byte] & bit) != 0).all(axis=1)
            np.bitwise_or.at(once, byte.ravel(), bit.ravel())
            np.bitwise_or.at(twice, byte[again].ravel(), bit[again].ravel())
        for i in range(SLICES if seen else 0):
            cut = slice(i * part, (i + 1) * part)
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array([i], pa.int32()),
                "once": pa.array([zlib.compress(once[cut].tobytes(), 1)], pa.binary()),
                "twice": pa.array([zlib.compress(twice[cut].tobytes(), 1)], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for i, x, y in zip(*(b.column(c).to_pylist() for c in ("slice", "once", "twice"))):
                o, t = (np.frombuffer(zlib.decompress(z), np.uint8) for z in (x, y))
                if i not in held:
                    held[i] = [o.copy(), t.copy()]
                    continue
                held[i][1] |= t | (held[i][0] & o)
                held[i][0] |= o
        for i, (o, t) in held.items():
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array([i], pa.int32()),
                "once": pa.array([zlib.compress(o.tobytes(), 1)], pa.binary()),
                "twice": pa.array([zlib.compress(t.tobytes(), 1)], pa.binary())})

    schema = "slice int, once binary, twice binary"
    # Two rounds: some tasks merge the pairs of many, then one task per slice the few that are left.
    some = (docs.mapInArrow(fill, schema)
            .repartition(SLICES * 4, F.col("slice"), F.pmod(F.xxhash64("once"), F.lit(8)))
            .mapInArrow(merge, schema))
    rows = some.repartition(SLICES, "slice").mapInArrow(merge, schema).select("slice", "twice").collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:                                          # SLICES rows, bits / 8 bytes in all
        out[r["slice"] * part:(r["slice"] + 1) * part] = np.frombuffer(zlib.decompress(r["twice"]), np.uint8)
    return out


def suspects(docs: DataFrame, twice, bits: int, min_chars: int) -> DataFrame:
    """(key, doc_id) of every line key that the filter can't rule out, once per row."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [(k, i) for i, t in enumerate(_texts(b)) for k in long_keys(t, min_chars)]
            if not own:
                continue
            pos = positions([k for k, _ in own], bits)
            hit = ((twice.value[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1).all(axis=1)
            keep = np.flatnonzero(hit)
            yield pa.RecordBatch.from_arrays([
                pa.array([own[j][0] for j in keep], pa.binary()),
                b.column("doc_id").take(pa.array([own[j][1] for j in keep], pa.int64()))],
                ["key", "doc_id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(probe, f"key binary, doc_id {kind}")


def repeated_keys(found: DataFrame, min_docs: int) -> DataFrame:
    """Exact confirmation: keys held by at least ``min_docs`` documents, and their survivor."""
    per_doc = found.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
    return (per_doc.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("survivor"))
            .filter(F.col("n") >= min_docs).drop("n"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 40,
                min_docs: int = 5, max_bits: int = 1 << 31) -> DataFrame:
    """``docs`` (all columns, ``text`` rewritten) with ``__n_lines`` and ``__n_dropped``.

    ``max_bits`` bounds the filter that every task holds (2**31 bits are 256 MB); a corpus beyond
    it only makes more lines suspects.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    bits = filter_bits(slim, "text", max_bits)
    twice = spark.sparkContext.broadcast(twice_filter(slim, bits, min_chars))
    found = stored(suspects(slim, twice, bits, min_chars))
    gone = stored(repeated_keys(found, min_docs))
    drops = (found.join(gone, "key").filter(~F.col("doc_id").eqNullSafe(F.col("survivor"))
                                            & F.col("survivor").isNotNull())
             .groupBy(F.col("doc_id").alias("__drop_id")).agg(F.collect_set("key").alias("__drop_keys")))
    held = docs.join(drops, F.col(doc_id).eqNullSafe(F.col("__drop_id")), "left").drop("__drop_id")
    return _rewrite(held, text)


def _rewrite(held: DataFrame, text: str) -> DataFrame:
    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text)
            kept, n, gone = [], [], []
            texts = b.column(at).cast(pa.binary()).to_pylist()
            for t, drop in zip(texts, b.column("__drop_keys").to_pylist()):
                lines = (t or b"").split(b"\n")
                n.append(len(lines))
                if drop:
                    bad = set(drop)
                    lines = [x for x in lines if line_key(x) not in bad]
                gone.append(n[-1] - len(lines))
                kept.append(t if not gone[-1] else b"\n".join(lines))
            cols = {f.name: c for f, c in zip(b.schema, b.columns) if f.name != "__drop_keys"}
            cols[text] = pa.array(kept, pa.binary()).cast(pa.string())
            cols |= {"__n_lines": pa.array(n, pa.int64()), "__n_dropped": pa.array(gone, pa.int64())}
            yield pa.RecordBatch.from_pydict(cols)

    plain = held.drop("__drop_keys").schema
    schema = plain.add("__n_lines", "long").add("__n_dropped", "long")
    return held.mapInArrow(rebuild, schema)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256 (rule: see the module's docstring)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                      F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


#: DuckDB twin of op4_line_dedup.
OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), gone AS (
  SELECT k, max(doc_id) AS survivor FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.pos, l.line, (g.k IS NOT NULL AND l.doc_id <> g.survivor) AS bad
  FROM lines l LEFT JOIN gone g ON l.k = g.k AND length(l.k) >= 40
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE bad) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT bad), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
