"""Repeatable pseudo-random numbers from keys, so that a re-run task gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_number(*parts: Column | str) -> Column:
    """Integer in [0, 2**32) from the MD5 of the parts joined with colons."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    digest = F.md5(F.concat_ws(":", *columns).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def md5_fraction(*parts: Column | str) -> Column:
    """The same number as a fraction in [0, 1)."""
    return md5_number(*parts) / F.lit(4294967296.0)
