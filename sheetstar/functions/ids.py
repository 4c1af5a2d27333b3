"""Keys derived from natural keys, the same on every retry of a task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(kind: str, *natural_key: Column) -> Column:
    """UUID-shaped key; null when a part of the natural key is null."""
    parts = [F.lit(kind)]
    for part in natural_key:
        parts += [F.length(part.cast("string")).cast("string"), part.cast("string")]
    # concat keeps nulls (concat_ws would skip them); lengths keep ("a","bc") and ("ab","c") apart.
    digest = F.md5(F.concat(*[F.concat(p, F.lit(":")) for p in parts]))
    return F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
