"""Deterministic identifiers and fingerprints.

Random UUIDs would make reruns differ; every id here is a hash of the row's
provenance so a rerun reproduces the same ids.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .periods import col_


def stable_id(*parts: str | Column) -> Column:
    """SHA-256 of the parts joined by ``:`` (nulls become empty strings)."""
    cols = [F.coalesce(col_(p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws(":", *cols), 256)


def fingerprint(*parts: str | Column) -> Column:
    """MD5 hex of the parts joined by ``:``; same hex as any SQL ``md5``."""
    return F.md5(F.concat_ws(":", *[col_(p).cast("string") for p in parts]))
