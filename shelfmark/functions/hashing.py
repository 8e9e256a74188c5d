"""Draws that depend on a row's key alone, not on how the rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _content(df: DataFrame) -> Column:
    """A hash of the whole row, as text that no key equals."""
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(f"`{n}`") for n in hashable]).cast("string"))


def key_text(df: DataFrame, key: str | Sequence[str]) -> Column:
    """One or several key columns as one string.

    A null reads as the hash of the row's content, so rows without a key are drawn apart.
    """
    names = [key] if isinstance(key, str) else list(key)
    parts = []
    for name in names:
        parts.append(F.coalesce(F.col(name).cast("string"), _content(df)))
    return parts[0] if len(parts) == 1 else F.concat_ws("\u001f", *parts)


def unit_hash(df: DataFrame, key: str | Sequence[str], salt: str) -> Column:
    """Uniform double in [0, 1): the first 32 bits of md5(salt:key) over 2^32."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), key_text(df, key)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
