"""Nested records -> one flat row per entity.

Every function here is a projection: the row count is unchanged by construction
(no ``explode`` except in :func:`explode_pairs`, which is the row-per-pair form).
Nested column pruning lets the Parquet scan read only the leaves a path map uses.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import first_element as _first
from strata.functions import keyed_value


def flatten(df: DataFrame, paths: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Select dotted paths as flat columns: ``{"contact.phone.mobile": "mobile_phone"}``.

    A NULL struct anywhere on the path gives NULL leaves (no error).
    """
    return df.select(*keep, *[F.col(p).alias(n) for p, n in paths.items()])


def lookup(df: DataFrame, array_col: str, keys: Mapping[str, str],
           key_field: str = "key", value_field: str = "value",
           drop_array: bool = True) -> DataFrame:
    """``array<struct<key,value>>`` -> one column per wanted key ({key: column}).

    First match wins on duplicate keys; a missing key, an empty or NULL array give
    NULL. The array is dropped afterwards unless ``drop_array`` is False.
    """
    out = df.withColumns({name: keyed_value(array_col, k, key_field, value_field)
                          for k, name in keys.items()})
    return out.drop(array_col) if drop_array else out


def pivot_pairs(df: DataFrame, entity: str | Sequence[str], key_col: str, value_col: str,
                order: str, keys: Mapping[str, str]) -> DataFrame:
    """Key/value pairs stored as rows -> one row per entity, one column per key.

    The row-form twin of :func:`lookup`: per entity and wanted key, the value of
    the first pair by ``order`` (NULL if the key never occurs). One aggregate with a
    map-side partial step: pairs are never collected into an array, so an entity
    with very many pairs is not gathered in one task.
    """
    ents = [entity] if isinstance(entity, str) else list(entity)
    return df.groupBy(*ents).agg(*[
        F.min_by(F.col(value_col), F.when(F.col(key_col) == F.lit(k), F.col(order))).alias(name)
        for k, name in keys.items()])


def flag_null(df: DataFrame, column: str, invalid: Column | str, flag: str) -> DataFrame:
    """Flag a present-but-malformed value, then NULL it, keeping the reason.

    ``invalid`` is a predicate Column, or a regex a *valid* value must contain.
    ``flag`` is False for a NULL input (missing is not malformed).
    """
    if isinstance(invalid, str):
        invalid = ~F.col(column).rlike(invalid)
    bad = F.coalesce(F.col(column).isNotNull() & invalid, F.lit(False))
    return (df.withColumn(flag, bad)
            .withColumn(column, F.when(~F.col(flag), F.col(column))))


def first_element(df: DataFrame, array_col: str, name: str) -> DataFrame:
    return df.withColumn(name, _first(array_col))


def explode_pairs(df: DataFrame, array_col: str, keep: Sequence[str],
                  key_field: str = "key", value_field: str = "value") -> DataFrame:
    """One row per pair; an entity with an empty or NULL array keeps one row of
    NULLs (``explode_outer``)."""
    return (df.select(*keep, F.explode_outer(array_col).alias("_p"))
            .select(*keep, F.col(f"_p.{key_field}").alias(key_field),
                    F.col(f"_p.{value_field}").alias(value_field)))


def nested_profile(df: DataFrame, null_paths: Sequence[str] = (),
                   empty_arrays: Sequence[str] = ()) -> DataFrame:
    """One row: ``n_rows``, NULL count per path, empty-array count per array."""
    aggs = [F.count("*").alias("n_rows")]
    aggs += [F.count_if(F.col(p).isNull()).alias("null_" + p.replace(".", "_"))
             for p in null_paths]
    aggs += [F.count_if(F.size(F.col(a)) == 0).alias("empty_" + a.replace(".", "_"))
             for a in empty_arrays]
    return df.agg(*aggs)
