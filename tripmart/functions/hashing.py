"""Hashes that detect changed attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def record_hash(attrs: tuple[str, ...], algorithm: str = "sha256") -> Column:
    """Hash of the attributes in order; NULL counts as empty text."""
    joined = F.concat_ws("||", *[F.coalesce(F.col(a).cast("string"), F.lit("")) for a in attrs])
    if algorithm == "sha256":
        return F.sha2(joined, 256)
    if algorithm == "md5":
        return F.md5(joined)
    raise ValueError(f"unknown hash algorithm {algorithm}")
