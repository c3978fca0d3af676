"""Join helper: null-safe key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def null_safe_keys(df: DataFrame, keys: Sequence[str], prefix: str = "_k") -> tuple[DataFrame, list[str]]:
    """Add non-null stand-ins for possibly-NULL key columns.

    Each key becomes (text value or '', is-null flag).  Windows, aggregates
    and equi-joins over the same stand-ins hash-partition identically, so a
    window followed by a join on the same keys shuffles the big side once —
    a null-safe ``<=>`` join would re-partition on different expressions."""
    cols: dict[str, Column] = {}
    names: list[str] = []
    for i, k in enumerate(keys):
        v, n = f"{prefix}{i}v", f"{prefix}{i}n"
        cols[v] = F.coalesce(F.col(k).cast("string"), F.lit(""))
        cols[n] = F.col(k).isNull()
        names += [v, n]
    return df.withColumns(cols), names
