"""Document keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(*parts: Column | str) -> Column:
    """md5 of the parts printed one after the other. A null prints as ``null``; there is no separator."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat(*[F.coalesce(c.cast("string"), F.lit("null")) for c in columns]))


def report_key(prefix: Column, *parts: Column | str, sep: str = "") -> Column:
    return F.concat(prefix.cast("string"), F.lit(sep), md5_key(*parts))
