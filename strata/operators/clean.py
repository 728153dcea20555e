"""Schema-driven cleaning: one projection per table.

All conversions are built into a single ``select`` so Catalyst sees one Project
(no long ``withColumn`` chains) and the whole step stays in one codegen stage.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import (DEFAULT_DATE_FORMATS, blank_to_null, parse_date, safe_int,
                              text_to_bool)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]


def trim_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Trim (spaces only) every string column, or the given ones; order kept."""
    targets = set(columns) if columns is not None else set(string_columns(df))
    return df.select(*[F.trim(F.col(c)).alias(c) if c in targets else F.col(c)
                       for c in df.columns])


def clean(df: DataFrame, dates: Mapping[str, str] | None = None,
          ints: Sequence[str] = (), bools: Sequence[str] = (),
          upper: Sequence[str] = (), blanks: Sequence[str] = (),
          rename: Mapping[str, str] | None = None, drop: Sequence[str] = (),
          date_formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> DataFrame:
    """Trim every string column, then type it.

    dates  -- {source text column: output name} parsed with ``date_formats``
    ints   -- text to int through decimal (``'12.0'`` -> 12, junk -> NULL)
    bools  -- ``TRUE`` (any case/padding) -> True, everything else -> False
    upper  -- upper-cased after trimming
    blanks -- empty after trimming -> NULL
    rename -- final names for columns that are kept as they are
    drop   -- audit / helper columns to leave out
    """
    dates, rename = dict(dates or {}), dict(rename or {})
    strings = set(string_columns(df))
    out = []
    for c in df.columns:
        if c in drop:
            continue
        e = F.trim(F.col(c)) if c in strings else F.col(c)
        if c in blanks:
            e = blank_to_null(c)
        if c in upper:
            e = F.upper(e)
        if c in dates:
            out.append(parse_date(c, date_formats).alias(dates[c]))
            continue
        if c in ints:
            e = safe_int(c)
        if c in bools:
            e = text_to_bool(c)
        out.append(e.alias(rename.get(c, c)))
    return df.select(*out)
