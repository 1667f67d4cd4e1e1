"""Row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "~null~"
SEPARATOR = "\u001f"


def surrogate_key(*columns: str | Column, separator: str = SEPARATOR, null_token: str = NULL_TOKEN) -> Column:
    """Hex digest over several columns that tells NULL, empty text and column borders apart.

    ``separator`` and ``null_token`` can be set to reproduce keys another tool has issued.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(p.cast("string"), F.lit(null_token)) for p in parts]
    return F.md5(F.concat_ws(separator, *texts))


_DIGEST, _TEXT = bytearray(b"\x01"), bytearray(b"\x00")


def packed_key(key: Column) -> Column:
    """A text key as bytes, for a shuffle: a digest as ``surrogate_key`` makes it in half its length, any other text as it is.

    The first byte tells which, so different keys stay different.
    """

    def packed(key: Column) -> Column:
        return F.when(key.rlike("\\A[0-9a-f]{32}\\z"), F.concat(F.lit(_DIGEST), F.unhex(key))).otherwise(F.concat(F.lit(_TEXT), key.cast("binary")))

    # As the element of an array the key is computed once, however often it is named.
    return F.transform(F.array(key), packed)[0]


def unpacked_key(packed: Column) -> Column:
    """The key that ``packed_key`` made the bytes of."""
    rest = F.substring(packed, 2, (1 << 31) - 1)
    return F.when(F.substring(packed, 1, 1) == F.lit(_DIGEST), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
