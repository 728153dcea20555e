"""Landing scans, audit columns, table sinks and read-back checks.

Paths are directories of files, never one file: every scan is parallel over the
files Spark finds, and each row carries the real name of the file it came from
(``_metadata.file_name``), which also makes a directory of many sources one scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def all_string_schema(columns: Iterable[str]) -> StructType:
    """Raw landing schema: every column text, nothing lost at read time."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def scan_csv(spark: SparkSession, path: str, schema: StructType,
             keep_corrupt: bool = True, sep: str = ",", recursive: bool = False,
             check_header: bool = True) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass); malformed lines are
    kept with their raw text in ``_corrupt_record`` instead of being dropped. A header
    whose names or order differ from the schema fails the read: columns are never bound
    by position alone. ``check_header=False`` is for a caller that has read the headers
    itself (:mod:`strata.sources.headers` binds each file by its own)."""
    full = schema
    if keep_corrupt and CORRUPT not in schema.fieldNames():
        full = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    reader = (spark.read.option("header", "true").option("mode", "PERMISSIVE")
              .option("enforceSchema", not check_header)
              .option("columnPruning", not keep_corrupt)     # fields left out would hide that a line is broken
              .option("sep", sep).option("recursiveFileLookup", recursive)
              .option("columnNameOfCorruptRecord", CORRUPT).schema(full))
    return reader.csv(path)


def scan_json(spark: SparkSession, path: str, schema: StructType | str,
              multiline: bool = False, keep_corrupt: bool = True) -> DataFrame:
    """JSON with an explicit (possibly nested) schema (StructType or DDL text); what does
    not parse is kept as text in ``_corrupt_record``.

    ``multiline=True`` reads pretty-printed arrays, as landed by an API export; such
    a file is one task, so parallelism is the number of files. Line-delimited JSON
    splits like CSV.
    """
    full = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if keep_corrupt and CORRUPT not in full.fieldNames():
        full = StructType([*full.fields, StructField(CORRUPT, StringType(), True)])
    return (spark.read.schema(full).option("multiLine", multiline).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def with_audit(df: DataFrame) -> DataFrame:
    """Bronze audit columns: the source file of each row and the ingestion time
    (one value per query)."""
    return df.withColumns({
        "_source_file": F.col("_metadata.file_name"),
        "_ingested_at": F.current_timestamp(),
    })


def landed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(name, empty) of the files in a landing directory; file content is never read.

    A zero-byte file is listed with ``empty`` true, so an empty export is not taken for
    a missing one.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    present = files.select(F.element_at(F.split("path", "/"), -1).alias("name"),
                           (F.col("length") == 0).alias("empty"))
    # the binary source yields no record for a zero-byte file; the text source lists it
    listed = [f.rsplit("/", 1)[-1] for f in
              spark.read.option("pathGlobFilter", glob).text(path).inputFiles()]
    if not listed:
        return present
    names = spark.createDataFrame([(unquote(n),) for n in listed], "name string")
    return names.join(present, "name", "left").select(
        "name", F.coalesce("empty", F.lit(True)).alias("empty"))


def landing_missing(spark: SparkSession, path: str, required: Iterable[str],
                    glob: str = "*") -> DataFrame:
    """Required names absent from the landing directory (``left_anti``)."""
    req = spark.createDataFrame([(n,) for n in required], "name string")
    return req.join(landed_files(spark, path, glob), "name", "left_anti")


def require_landing(spark: SparkSession, path: str, required: Iterable[str]) -> None:
    """Raise ``FileNotFoundError`` naming every missing file, or ``ValueError`` naming
    every empty one (reads only names and lengths)."""
    req = spark.createDataFrame([(n,) for n in required], "name string")
    found = req.join(landed_files(spark, path), "name", "left").collect()
    missing = sorted(r["name"] for r in found if r["empty"] is None)
    if missing:
        raise FileNotFoundError(f"missing in {path}: {missing}")
    empty = sorted(r["name"] for r in found if r["empty"])
    if empty:
        raise ValueError(f"empty in {path}: {empty}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Iterable[str] = (), **options: str) -> str:
    """Whole-table overwrite; re-running it leaves exactly one copy.

    Never call it with a plan that reads the same ``path`` (Parquet overwrite is
    not transactional): write to a new location and switch readers instead.
    """
    w = df.write.mode("overwrite").format(fmt).options(**options)
    parts = list(partition_by)
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)
    return path


def publish(spark: SparkSession, warehouse: str, run_id: str, paths: Mapping[str, str]) -> None:
    """Make all tables of a run visible at once.

    Tables are written to folders of their own run and never move. Publishing appends one
    small file to ``<warehouse>/_published`` that lists them; a file appears whole or not
    at all, so readers (:func:`published`) see the tables of one run or of the one before,
    and a run that fails at any step changes nothing for them.
    """
    import datetime as dt
    now = dt.datetime.now(dt.timezone.utc).isoformat()
    rows = [(run_id, now, t, p) for t, p in sorted(paths.items())]
    (spark.createDataFrame(rows, "run_id string, published_at string, table_name string, path string")
     .coalesce(1).write.mode("append").json(f"{warehouse.rstrip('/')}/_published"))


def published(spark: SparkSession, warehouse: str) -> dict[str, str]:
    """{table: path} as last published, table by table (a later run that published fewer
    layers leaves the others as they were). Reads a few rows per run."""
    log = (spark.read.schema("run_id string, published_at string, table_name string, path string")
           .json(f"{warehouse.rstrip('/')}/_published"))
    last = log.groupBy("table_name").agg(
        F.max_by("path", F.struct("published_at", "run_id")).alias("path"))
    return {r["table_name"]: r["path"] for r in last.collect()}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def missing_sources(df: DataFrame, expected: Iterable[str],
                    source_col: str = "_source") -> DataFrame:
    """Expected sources that delivered no rows (reported, not silently dropped)."""
    spark = df.sparkSession
    exp = spark.createDataFrame([(e,) for e in expected], f"{source_col} string")
    return exp.join(df.select(source_col).distinct(), source_col, "left_anti")


def table_counts(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """One row per table: name, row count, status ``OK`` (non-empty), ``EMPTY``, or
    ``MISSING`` with a NULL count for a required table given as None.

    All counts run as one job (a union of global aggregates).
    """
    spark = next(df.sparkSession for df in tables.values() if df is not None)
    out = None
    for name, df in tables.items():
        if df is None:
            part = spark.range(1).select(F.lit(name).alias("table_name"), F.lit(None).cast("bigint").alias("n"))
        else:
            part = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("status", F.when(F.col("n").isNull(), "MISSING")
                          .when(F.col("n") > 0, "OK").otherwise("EMPTY"))


def verify_tables(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet",
                  require: bool = False) -> DataFrame:
    """Read back each written table: (table_name, n, status) with status ``OK``,
    ``EMPTY`` or ``FAILED`` (unreadable path). With ``require`` any non-OK raises.

    Opening a table only touches its metadata on the driver; all counts then run
    as one Spark job.
    """
    readable: dict[str, DataFrame] = {}
    failed: list[str] = []
    for name, path in paths.items():
        try:
            readable[name] = spark.read.format(fmt).load(path)
        except Exception:  # noqa: BLE001 - any unreadable table is a FAILED row
            failed.append(name)
    parts = []
    if readable:
        parts.append(table_counts(readable))
    if failed:
        parts.append(spark.createDataFrame([(n, None, "FAILED") for n in failed],
                                           "table_name string, n bigint, status string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if require:
        bad = [r["table_name"] for r in out.filter(F.col("status") != "OK").collect()]
        if bad:
            raise RuntimeError(f"tables not OK: {sorted(bad)}")
    return out


def union_sources(spark: SparkSession, path: str, schema: StructType | None = None,
                  fmt: str = "parquet", source_from: str = "folder",
                  source_column: str | None = None) -> DataFrame:
    """Read every source landed under ``path`` as one scan and tag each row with its
    source in ``_source``: the value of the partition folder (``source_column=value``) or
    the file name.

    Folders are read by partition discovery with the source typed as text, so escaped
    characters and NULL come back as they were written, and a filter on ``_source`` reads
    only the folders it names.
    """
    reader = spark.read.format(fmt)
    if source_from != "folder":
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.option("recursiveFileLookup", "true").load(path)
        return df.withColumn("_source", F.col("_metadata.file_name"))
    if source_column is None:
        raise ValueError("source_column names the partition folders")
    fields = schema.fields if schema is not None else reader.load(path).schema.fields
    typed = StructType([*[f for f in fields if f.name != source_column],
                        StructField(source_column, StringType(), True)])
    return (spark.read.format(fmt).schema(typed).load(path)
            .withColumnRenamed(source_column, "_source"))
