"""Random columns that depend only on (seed, stream, key), never on the partition layout.

``md5`` can be repeated in any SQL engine, ``xxhash64`` is the faster choice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from .columns import by_name
# 13 hex digits = 52 bits, so value + 0.5 is exact in a double
_SCALE = float(1 << 52)


def _uniform_pair(seed, stream, keys, method) -> tuple[Column, Column]:
    stream = stream if isinstance(stream, Column) else F.lit(str(stream))
    if method == "md5":
        digest = F.md5(F.concat_ws("|", F.lit(str(seed)), stream, *[k.cast("string") for k in keys]))
        words = [F.conv(F.substring(digest, at, 13), 16, 10).cast("bigint") for at in (1, 14)]
    elif method == "xxhash64":
        words = [
            F.shiftrightunsigned(F.xxhash64(F.lit(str(seed)), stream, F.lit(half), *keys), 12)
            for half in ("", "'")
        ]
    else:
        raise ValueError(f"unknown random method {method!r}")
    first, second = [(w.cast("double") + F.lit(0.5)) / F.lit(_SCALE) for w in words]
    return first, second


def uniform(seed, stream, *keys, method: str = "md5") -> Column:
    """A double in (0, 1); keys are columns or column names, `stream` text or a column."""
    columns = [by_name(k) if isinstance(k, str) else k for k in keys]
    return _uniform_pair(seed, stream, columns, method)[0]


def normals(count: int, seed, stream, *keys, method: str = "md5") -> list[Column]:
    """`count` independent standard normals by Box-Muller; one digest gives two of them."""
    columns = [by_name(k) if isinstance(k, str) else k for k in keys]
    out: list[Column] = []
    for pair in range((count + 1) // 2):
        first, second = _uniform_pair(seed, f"{stream}:{pair}", columns, method)
        radius = F.sqrt(F.lit(-2.0) * F.ln(first))
        angle = F.lit(2.0 * math.pi) * second
        out += [radius * F.cos(angle), radius * F.sin(angle)]
    return out[:count]
