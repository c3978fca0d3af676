"""Column names of the user's tables, which may be any: ``_sha``, ``a.b``..."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def own_columns(docs: DataFrame) -> list[Column]:
    """All columns of ``docs``, named so that no dot or backtick is read as
    more than a part of the name."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def free_names(docs: DataFrame, *wanted: str) -> list[str]:
    """Names like those wanted that no column of ``docs`` has."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
