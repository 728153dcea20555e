"""JSON landed as VARIANT: nothing is lost at read time, and what the schema doesn't know is reported.

Records are parsed without a schema (``try_parse_json``), typed columns are taken out of them by
path, and one aggregate over all fields says which ones are unknown or have another type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, NumericType, StructType

VARIANT = "_variant"
RAW = "_raw"
BROKEN = "_corrupt_record"
ITEM = "[]"


def scan_variant(spark: SparkSession, path: str, arrays: bool = False) -> DataFrame:
    """One row a JSON line: ``_variant``, and ``_corrupt_record`` (the raw line) where it doesn't parse.

    With ``arrays`` a line that holds an array gives one row an element (``variant_explode``), so a
    large array in one line is spread over rows; an empty one gives none. Blank lines give no row.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.try_parse_json("value").alias(VARIANT), F.col("value").alias(RAW))
    broken = F.when(F.col(VARIANT).isNull(), F.col(RAW)).alias(BROKEN)
    rows = parsed.select(VARIANT, broken)
    if not arrays:
        return rows
    many = F.coalesce(F.schema_of_variant(VARIANT).startswith("ARRAY"), F.lit(False))
    items = rows.withColumn("__items", F.when(many, F.col(VARIANT)))
    one = _exploded(items, "__items", [VARIANT, BROKEN, "__items"]).filter("__items IS NULL OR __value IS NOT NULL")
    return one.select(F.when(F.col("__items").isNull(), F.col(VARIANT)).otherwise(F.col("__value")).alias(VARIANT), BROKEN)


def _exploded(df: DataFrame, variant: str, keep: list[str]) -> DataFrame:
    """(keep..., __key, __value): each field or element of a variant; one row of NULLs for none."""
    cols = "".join(f"`{c}`, " for c in keep)
    return df.sparkSession.sql(f"SELECT {cols}t.key AS __key, t.value AS __value "
                               f"FROM {{df}}, LATERAL variant_explode_outer(`{variant}`) AS t", df=df)


def _path(*keys: str) -> str:
    return "$" + "".join("['" + k.replace("\\", "\\\\").replace("'", "\\'") + "']" for k in keys)


def read_fields(rows: DataFrame, schema: StructType | str, variant: str = VARIANT) -> DataFrame:
    """``rows`` with one typed column a top-level field of ``schema`` (nested types included).

    An absent field is NULL, as in a schema read of the same JSON. A value of another kind is converted
    where it can be (the text ``"1"`` to the number 1) and NULL where not; :func:`drift_report` counts both.
    """
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return rows.withColumns({f.name: F.try_variant_get(F.col(variant), _path(f.name), f.dataType.simpleString())
                             for f in kinds.fields})


def _kind(kind: DataType) -> str:
    if isinstance(kind, StructType):
        return "object"
    if isinstance(kind, ArrayType):
        return "array"
    if isinstance(kind, BooleanType):
        return "boolean"
    return "number" if isinstance(kind, NumericType) else "string"


def _declared(kind: DataType, at: tuple[str, ...] = ()) -> dict[tuple[str, ...], str]:
    """{path: expected kind} of every field and element below ``kind``."""
    below = ([((*at, f.name), f.dataType) for f in kind.fields] if isinstance(kind, StructType)
             else [((*at, ITEM), kind.elementType)] if isinstance(kind, ArrayType) else [])
    out: dict[tuple[str, ...], str] = {}
    for path, inner in below:
        out[path] = _kind(inner)
        out |= _declared(inner, path)
    return out


def _found(value: Column) -> Column:
    """Kind of a JSON value: object, array, number, string, boolean or null."""
    text = F.schema_of_variant(value)
    return (F.when(text.startswith("OBJECT"), "object").when(text.startswith("ARRAY"), "array")
            .when(text == "STRING", "string").when(text == "BOOLEAN", "boolean").when(text == "VOID", "null")
            .otherwise("number"))


def drift_report(rows: DataFrame, schema: StructType | str, variant: str = VARIANT) -> DataFrame:
    """path, drift, expected, found, n: every kind of value that ``schema`` doesn't foresee, counted.

    ``unknown``: a field that it doesn't name (its own fields aren't followed further); ``retyped``:
    a value of another JSON kind; ``broken``: a record that isn't JSON, or no object (path ``$``). A
    JSON null fits every type and an absent field is no drift. Fields of one name in one object:
    JSON parsing refuses them, so the record counts as broken. Paths join names by dots, array
    elements are ``[]``.

    One pass: level by level of ``schema`` a container that fits gives way to its fields, so records
    are parsed once, and only (path, kind) pairs, summed before the shuffle, meet.
    """
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    declared = _declared(kinds)
    inner = ["", *sorted(".".join(p) for p, k in declared.items() if k in ("object", "array"))]
    known = F.create_map(*[F.lit(x) for p, k in declared.items() for x in (".".join(p), k)])
    at = rows.select(F.lit("").alias("path"), F.lit("object").alias("expected"), F.col(variant).alias("__v"),
                     F.when(F.col(variant).isNull(), "broken").otherwise(_found(F.col(variant))).alias("found"))
    for _ in range(max(len(p) for p in declared)):
        fits = F.col("path").isin(inner) & (F.col("found") == F.col("expected"))
        fields = _exploded(at.withColumn("__in", F.when(fits, F.col("__v"))), "__in", [*at.columns, "__in"])
        below = F.col("__in").isNotNull() & F.col("__value").isNotNull()
        name = F.concat_ws(".", F.nullif("path", F.lit("")), F.coalesce("__key", F.lit(ITEM)))
        at = fields.select(F.when(below, name).otherwise(F.col("path")).alias("path"),
                           F.when(below, F.try_element_at(known, name)).otherwise(F.col("expected")).alias("expected"),
                           F.when(below, F.col("__value")).alias("__v"),
                           F.when(below, _found(F.col("__value"))).otherwise(F.col("found")).alias("found"))
    top = F.col("path") == ""
    drift = F.when(top, "broken").when(F.col("expected").isNull(), "unknown").otherwise("retyped")
    odd = F.col("expected").isNull() | ((F.col("found") != F.col("expected")) & (top | (F.col("found") != "null")))
    return (at.filter(odd).groupBy(F.when(top, "$").otherwise(F.col("path")).alias("path"), drift.alias("drift"),
                                   "expected", "found").agg(F.count("*").alias("n")))


def variant_schema(rows: DataFrame, variant: str = VARIANT) -> DataFrame:
    """One row, ``schema``: the schema that all records together have (no sampling)."""
    return rows.agg(F.schema_of_variant_agg(variant).alias("schema"))
