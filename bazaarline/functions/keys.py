"""Key expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def surrogate_key(*parts: Column, separator: str = "-") -> Column:
    """Parts joined as text. Null if any part is null, unlike ``concat_ws``."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(part.cast("string"))
    return F.concat(*pieces)


def hashed_key(*parts: Column, separator: str = "-") -> Column:
    """MD5 of :func:`surrogate_key`: fixed width whatever the parts are."""
    return F.md5(surrogate_key(*parts, separator=separator))
