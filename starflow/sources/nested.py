"""Nested records as flat tables: a child table per array, at any depth (SRC11,
SRC12, JSN1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

LEAD = ("_row_id", "_parent_id", "_pos")


def record_ids(df: DataFrame, keys: Sequence[str] = ()) -> Column | None:
    """The id of a record by its key columns, None without keys."""
    if not keys:
        return None
    parts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("\\N")) for k in keys]
    return F.concat_ws("|", *parts)


def normalise_nested(df: DataFrame, name: str, keys: Sequence[str] = (), sep: str = "__") -> dict[str, DataFrame]:
    """``df`` and its arrays as tables, by name: the record's own fields under
    ``name``, the elements of each array or map under the name of the table
    that holds it, ``sep`` and the array's path.

    Struct fields become ``a__b`` columns.  A table of elements has ``_row_id``,
    ``_parent_id`` (the row that holds the array) and ``_pos`` (from 0); elements
    that are no structs are a column ``value``, those of a map ``key`` and
    ``value``.  An element's id is its parent's with path and position behind,
    so it needs no numbering and is the same whenever the record is read again.
    A record's id is that of ``keys``, which must tell records apart; without
    keys it is a digest of its content and a number, and the records are
    written with it, so that equal ones need not meet to be told apart.

    Null and empty arrays have no elements, null elements are rows of nulls; an
    empty table gives empty tables.  The names of LEAD are not free for
    columns of a record.  Every table is a plan of its own over ``df``, of
    which a reader takes only the columns that hold its array; nothing is
    collected."""
    clash = set(LEAD) & set(df.columns)
    if clash:
        raise ValueError(f"{name}: columns named {sorted(clash)}")
    own_id = record_ids(df, keys)
    if own_id is not None:
        keyed = df.withColumn("_row_id", own_id)
    else:
        content = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
        keyed = materialise(df.withColumn("_row_id", F.concat_ws("#", content, F.monotonically_increasing_id())), name)
    root = keyed.select("_row_id", F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns]).alias("_e"))
    tables: dict[str, DataFrame] = {}

    def walk(frame: DataFrame, table: str) -> None:
        lead = [c for c in LEAD if c in frame.columns]
        flat: list[tuple[str, Column]] = []
        arrays: list[tuple[str, Column]] = []

        def fields(col: Column, dtype: T.DataType, path: tuple[str, ...]) -> None:
            if isinstance(dtype, T.StructType):
                for f in dtype.fields:
                    fields(col.getField(f.name), f.dataType, (*path, f.name))
            elif isinstance(dtype, T.ArrayType):
                arrays.append((sep.join(path) or "value", col))
            elif isinstance(dtype, T.MapType):
                arrays.append((sep.join(path) or "value", F.map_entries(col)))
            else:
                flat.append((sep.join(path) or "value", col))

        fields(F.col("_e"), frame.schema["_e"].dataType, ())
        names = [*lead, *[n for n, _ in flat]]
        twice = {n for n in names if names.count(n) > 1} | {n for n, _ in arrays if [a for a, _ in arrays].count(n) > 1}
        if twice:
            raise ValueError(f"{table}: two columns would be named {sorted(twice)}")
        tables[table] = frame.select(*lead, *[c.alias(n) for n, c in flat])
        for path, col in arrays:
            elements = frame.select(F.col("_row_id").alias("_parent_id"), F.posexplode(col).alias("_pos", "_e"))
            child = elements.select(
                F.concat_ws("/", "_parent_id", F.lit(path), "_pos").alias("_row_id"), "_parent_id", "_pos", "_e")
            walk(child, table + sep + path)

    walk(root, name)
    return tables
