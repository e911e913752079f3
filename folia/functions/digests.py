"""Content identity: SHA-256 of canonical bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(**fields: Column) -> Column:
    """Compact JSON of the fields in sorted order of their names."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def content_id(kind: str, content: Column) -> Column:
    """``kind-`` and the first 24 hex digits of the digest of kind and content."""
    return F.concat(F.lit(kind + "-"), F.substring(sha256(F.concat(F.lit(kind + "\x1f"), content)), 1, 24))


def stable_id(*parts: Column, digits: int = 16) -> Column:
    """The first digits of the digest of parts joined by a unit separator."""
    return F.substring(sha256(F.concat_ws("\x1f", *parts)), 1, digits)
