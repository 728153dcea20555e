"""Surrogate keys and change hashes for versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from strata.functions import NULL_TOKEN, md5_of


def with_keys(versions: DataFrame, key: str | Sequence[str], tracked: Sequence[str],
              sk: str = "version_sk", row_hash: str = "row_hash",
              valid_from: str = "valid_from", null_token: str = NULL_TOKEN) -> DataFrame:
    """Add ``sk = md5(key||valid_from)`` (unique per version) and
    ``row_hash = md5(tracked...)`` (equal when nothing tracked changed).

    Both are row-local projections: no shuffle, and the partitioning of the input
    (by key, after :func:`strata.operators.history.scd2`) is kept.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return versions.withColumns({
        sk: md5_of([*keys, valid_from], null_token),
        row_hash: md5_of(list(tracked), null_token),
    })
