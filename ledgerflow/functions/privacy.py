"""Pseudonymisation with built-in, JVM-side expressions.

The keyed hash is deterministic, so a pseudonymised key column still matches
itself across loads (a random-IV cipher would break every later merge).  The
secret ends up as a literal in the query plan: set
``spark.sql.redaction.string.regex`` on clusters where plans are logged.

``pseudonym`` is a plain hash of secret and value; ``keyed_pseudonym`` is a keyed
MAC (HMAC-SHA256) that names the version of its key, so that keys can rotate.
"""

from __future__ import annotations

import hashlib
from typing import Iterable, Mapping, Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pseudonym(col: Column, secret: str, is_string: bool = True) -> Column:
    """Hex SHA-256 of ``secret || value``.

    A null string becomes the pseudonym of ``""`` (the source jobs fill string
    nulls with the empty string first); a null of any other type stays null.
    """
    text = F.coalesce(col, F.lit("")) if is_string else col.cast("string")
    return F.sha2(F.concat(F.lit(secret), text), 256)


def pseudonymise(df: DataFrame, columns: Iterable[str], secret: str) -> DataFrame:
    """Replace each listed column by its pseudonym, in one projection."""
    columns = [c for c in columns if c]
    if not columns:
        return df
    kinds = {f.name: isinstance(f.dataType, T.StringType) for f in df.schema.fields}
    missing = [c for c in columns if c not in kinds]
    if missing:
        raise ValueError(f"columns to pseudonymise not in frame: {missing}")
    return df.withColumns({c: pseudonym(F.col(c), secret, kinds[c]) for c in columns})


def _text(col: Column, is_string: bool) -> Column:
    return F.coalesce(col, F.lit("")) if is_string else col.cast("string")


def keyed_pseudonym(col: Column, key: str, version: str, is_string: bool = True) -> Column:
    """``<version>:<hex HMAC-SHA256 of the value's text>``, from two nested
    ``sha2`` over the key padded to one block of 64 bytes.  Nulls as in
    ``pseudonym``."""
    if not key:
        raise ValueError("a keyed pseudonym needs a key")
    if not version or ":" in version:
        raise ValueError(f"a key version is a non-empty name without a colon, not {version!r}")
    raw = key.encode()
    block = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    inner, outer = (bytes(b ^ pad for b in block) for pad in (0x36, 0x5C))
    first = F.unhex(F.sha2(F.concat(F.lit(inner), F.encode(_text(col, is_string), "UTF-8")), 256))
    return F.concat(F.lit(f"{version}:"), F.sha2(F.concat(F.lit(outer), first), 256))


def pseudonymise_keyed(df: DataFrame, columns: Iterable[str], keys: Mapping[str, str], version: str) -> DataFrame:
    """Replace each listed column by its keyed pseudonym under ``keys[version]``."""
    kinds = {f.name: isinstance(f.dataType, T.StringType) for f in df.schema.fields}
    columns = [c for c in columns if c]
    missing = [c for c in columns if c not in kinds]
    if missing:
        raise ValueError(f"columns to pseudonymise not in frame: {missing}")
    return df.withColumns({c: keyed_pseudonym(F.col(c), keys[version], version, kinds[c]) for c in columns}) if columns else df


def pseudonym_of(stored: Column, clear: Column, keys: Mapping[str, str], is_string: bool = True) -> Column:
    """True where ``stored`` is a pseudonym of ``clear`` under the key that it
    names; false for a key version that is not among ``keys``, null for null.
    Rows written before and after a rotation match the same clear values."""
    found: Optional[Column] = None
    for version, key in keys.items():
        named = stored.startswith(f"{version}:")
        same = stored == keyed_pseudonym(clear, key, version, is_string)
        found = F.when(named, same) if found is None else found.when(named, same)
    if found is None:
        raise ValueError("no keys given")
    return F.when(stored.isNull(), F.lit(None)).otherwise(found.otherwise(F.lit(False)))
