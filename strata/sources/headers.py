"""CSV landing bound by header name: each file's own header says which column is which.

A first pass takes one line of each file (a task stops after the first lines of its split). Files are
then grouped by header, each distinct header is one scan over its files, and the scans meet by name.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from strata.sources.files import CORRUPT, all_string_schema, scan_csv

HEADER = "_header"
_OPEN_COST = "spark.sql.files.openCostInBytes"
_SPLIT = "spark.sql.files.maxPartitionBytes"


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that is not blank of each file begun in this task; stops once a split has one."""
    for batch in batches:
        lines, paths, starts = (c.to_pylist() for c in batch.columns)
        for line, path, start in zip(lines, paths, starts):
            if start:                                       # a later part of a file: no header in it
                return
            if line.strip():
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([line])], names=["path", "line"])
                return


def file_headers(spark: SparkSession, path: str, sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """{header: its files} below ``path`` (folders included). One entry a file: as large as its listing.

    Every split is a task of its own here and reads one batch of lines at most, so big files aren't
    read through. A header is one line. A byte order mark and blanks around names are left out, and a
    name that is blank becomes ``_c<position>``. Files without a line of text have no header.
    """
    own = spark.conf.get(_OPEN_COST)
    spark.conf.set(_OPEN_COST, spark.conf.get(_SPLIT))      # splits are never packed into one task
    try:
        text = spark.read.option("recursiveFileLookup", "true").text(path)
        found = (text.select("value", "_metadata.file_path", "_metadata.file_block_start")
                 .mapInArrow(_first_lines, "path string, line string").collect())
    finally:
        spark.conf.set(_OPEN_COST, own)
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in found:
        cells = next(csv.reader([r["line"].lstrip("\ufeff")], delimiter=sep))
        groups.setdefault(tuple(c.strip() or f"_c{i}" for i, c in enumerate(cells)), []).append(r["path"])
    return {h: sorted(files) for h, files in sorted(groups.items())}


def _by_name(header: Sequence[str]) -> dict[str, str]:
    """Lower-case name -> name as written; a name that is there twice can't be bound."""
    names = {h.lower(): h for h in header}
    if len(names) < len(header):
        raise ValueError(f"header names a column twice: {','.join(header)}")
    return names


def scan_csv_by_name(spark: SparkSession, path: str, columns: Iterable[str], sep: str = ",") -> DataFrame:
    """Every line of every CSV file below ``path`` as text columns, each bound by its file's header.

    Names match whatever their case. A wanted column that a file lacks is NULL; columns beyond the
    wanted ones are left out (:func:`header_report` lists both). Lines that don't fit the header of
    their file keep their raw text in ``_corrupt_record``; ``_header`` is that header's names. Files
    without any line give no rows, and so does a folder without files that have one. A header that
    names a column twice raises ValueError.
    """
    wanted = list(columns)
    groups = file_headers(spark, path, sep)
    out = spark.createDataFrame([], all_string_schema([*wanted, CORRUPT]).add(HEADER, ArrayType(StringType())))
    for header, files in groups.items():
        names = _by_name(header)
        part = scan_csv(spark, path, all_string_schema(header), sep=sep, recursive=True, check_header=False)
        if len(groups) > 1:                                 # taken at file listing: other files aren't opened
            part = part.filter(F.col("_metadata.file_path").isin(files))
        cols = [F.col(f"`{names[c.lower()]}`") if c.lower() in names else F.lit(None).cast("string") for c in wanted]
        # reads a named column too: Spark refuses a scan of the raw text alone
        broken = F.when(F.length(F.concat_ws("", f"`{header[0]}`", CORRUPT)) >= 0, F.col(CORRUPT))
        out = out.unionByName(part.select(*[c.alias(n) for c, n in zip(cols, wanted)], broken.alias(CORRUPT),
                                          F.array(*[F.lit(h) for h in header]).alias(HEADER)))
    return out


def header_report(scanned: DataFrame, columns: Iterable[str], sep: str = ",") -> DataFrame:
    """One row a header met with rows: header, missing, extra (names joined by ``sep``, NULL for none),
    n_rows, n_broken. ``scanned`` comes from :func:`scan_csv_by_name` with the same columns."""
    wanted = list(columns)
    have, want = F.transform(HEADER, F.lower), F.array(*[F.lit(c) for c in wanted])

    def text(names):
        return F.nullif(F.array_join(names, sep), F.lit(""))

    missing = F.filter(want, lambda c: ~F.array_contains(have, F.lower(c)))
    extra = F.filter(HEADER, lambda c: ~F.array_contains(F.transform(want, F.lower), F.lower(c)))
    return (scanned.groupBy(HEADER)
            .agg(F.count("*").alias("n_rows"), F.count(CORRUPT).alias("n_broken"))
            .select(F.array_join(HEADER, sep).alias("header"), text(missing).alias("missing"),
                    text(extra).alias("extra"), "n_rows", "n_broken"))
