"""Column-level building blocks (all JVM-side, codegen-friendly; no UDFs).

Inbound conversions use the ``try_`` family so bad input becomes NULL instead of
an ANSI error; the data-quality gates then count those NULLs.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date formats, tried in order (ISO first, then day-first).
DEFAULT_DATE_FORMATS = ("yyyy-MM-dd", "dd-MM-yyyy")
# Token standing for NULL inside hashed strings, the separator, and the
# character put before either where a value holds it itself.
NULL_TOKEN = "NULL"
HASH_SEPARATOR = "||"
HASH_ESCAPE = "\\"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: str | Column) -> Column:
    """Trim spaces (not tabs) from both ends; Spark ``trim`` semantics."""
    return F.trim(col(c))


def upper_text(c: str | Column) -> Column:
    return F.upper(F.trim(col(c)))


def blank_to_null(c: str | Column) -> Column:
    """Empty (after trimming spaces) becomes NULL."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def parse_date(c: str | Column, formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """First format that parses wins; NULL when none does (never raises)."""
    text = F.trim(col(c))
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def parse_timestamp(c: str | Column) -> Column:
    return F.try_to_timestamp(F.trim(col(c)))


def safe_int(c: str | Column) -> Column:
    """Text or float-looking text to int: ``'12'`` and ``'12.0'`` give 12, junk gives NULL.

    Goes through a decimal so spreadsheet-style ``85000.0`` survives; fractional
    parts are truncated toward zero, as a plain string-to-int cast would.
    """
    return F.trim(col(c)).try_cast("decimal(38,6)").try_cast("int")


def text_to_bool(c: str | Column, true_token: str = "TRUE") -> Column:
    """``TRUE`` in any case/padding is True; everything else, NULL included, is False."""
    return F.coalesce(F.upper(F.trim(col(c))) == F.lit(true_token), F.lit(False))


def in_domain(c: str | Column, values: Iterable[str]) -> Column:
    """Null-safe membership: NULL is *not* in the domain (plain ``isin`` gives NULL)."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def not_in_domain(c: str | Column, values: Iterable[str]) -> Column:
    return ~in_domain(c, values)


def no_digit(c: str | Column) -> Column:
    """True for a present value without any digit (NULL stays NULL)."""
    return ~col(c).rlike(r"\d")


def hash_text(parts: Sequence[str | Column], null_token: str = NULL_TOKEN,
              sep: str = HASH_SEPARATOR) -> Column:
    """Separator-joined text of the parts with an explicit token for NULL.

    ``concat_ws`` alone skips NULLs, so (NULL, 'a') and ('a', NULL) would collide. A
    value that equals the token, or holds a character of the separator or the escape,
    has it escaped, so different values never give one text; all others stay as they are.
    """
    marks = "".join(sorted(set(sep) | {HASH_ESCAPE}))
    pattern = "([" + "".join("\\" + m for m in marks) + "])"

    def safe(p: str | Column) -> Column:
        text = F.regexp_replace(col(p).cast("string"), pattern, "\\\\$1")
        return (F.when(text.isNull(), F.lit(null_token))
                .when(text == F.lit(null_token), F.lit(HASH_ESCAPE + null_token)).otherwise(text))

    return F.concat_ws(sep, *[safe(p) for p in parts])


def md5_of(parts: Sequence[str | Column], null_token: str = NULL_TOKEN,
           sep: str = HASH_SEPARATOR) -> Column:
    return F.md5(hash_text(parts, null_token, sep))


def keyed_value(array_col: str | Column, key: str, key_field: str = "key",
                value_field: str = "value") -> Column:
    """Value of the first element whose ``key_field`` equals ``key`` in an
    ``array<struct<key,value>>``; NULL for a missing key, empty or NULL array."""
    matches = F.filter(col(array_col), lambda x: x[key_field] == F.lit(key))
    return F.get(matches, 0)[value_field]


def first_element(array_col: str | Column) -> Column:
    """1-based ``element_at(arr, 1)`` that gives NULL (not an error) on empty arrays."""
    return F.try_element_at(col(array_col), F.lit(1))


def ascending(start: Column, stop: Column) -> Column:
    """``sequence(start, stop)``, but empty when start > stop (Spark would count down)."""
    return F.when(start <= stop, F.sequence(start, stop)).otherwise(
        F.array().cast("array<int>"))


def month_index(d: str | Column) -> Column:
    """Months since year 0: a dense integer per calendar month."""
    return F.year(col(d)) * 12 + F.month(col(d)) - 1


def month_end_of_index(m: str | Column) -> Column:
    m = col(m)
    return F.last_day(F.make_date(F.floor(m / 12).cast("int"), (m % 12 + 1).cast("int"), F.lit(1)))
