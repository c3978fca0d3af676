"""Schema drift: recursive comparison, widening and a gate before landing (SRC14)."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .contracts import LINEAGE_COLUMNS
from .readers import append_load, read_loads

WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
# Decimal digits that hold every value of a whole type.
DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
CHANGES = ("load_id string, path string, change string, old_type string, new_type string, compatible boolean, "
           "table_schema string")


@dataclass(frozen=True)
class Change:
    """A difference at ``path`` (``a.b``, ``a[]`` in an array, ``a{key}`` and
    ``a{value}`` in a map).  ``compatible``: no value known or new is lost."""

    path: str
    change: str
    old_type: str | None
    new_type: str | None
    compatible: bool


class IncompatibleSchema(ValueError):
    """A load that does not fit its table; ``changes`` says where."""

    def __init__(self, changes: list[Change]):
        super().__init__("; ".join(f"{c.path}: {c.change} {c.old_type} -> {c.new_type}" for c in changes))
        self.changes = changes


def _digits(t: T.DataType) -> tuple[int, int] | None:
    """Digits before and behind the point."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return (DIGITS[t], 0) if t in DIGITS else None


def widest(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type of the two, or above both, that holds all values of either
    exactly; None if there is none.  Only scalar types."""
    if old == new:
        return old
    if old in WHOLE and new in WHOLE:
        return max(old, new, key=WHOLE.index)
    if {type(old), type(new)} <= {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    for a, b in ((old, new), (new, old)):
        # A double holds whole numbers of 32 bits, a float those of 16.
        if isinstance(b, T.DoubleType) and (isinstance(a, T.FloatType) or a in WHOLE[:3]):
            return b
        if isinstance(b, T.FloatType) and a in WHOLE[:2]:
            return b
    a, b = _digits(old), _digits(new)
    if a and b:
        before, behind = max(a[0], b[0]), max(a[1], b[1])
        return T.DecimalType(before + behind, behind) if before + behind <= 38 else None
    return None


def compare(old: T.DataType, new: T.DataType, path: str = "") -> tuple[T.DataType, list[Change]]:
    """The type that holds both, and what differs, at any depth.  Fields go by
    name; those of ``old`` come first, in their order.  Fields that only one
    has are compatible (NULL for the other); where two types have no common
    one, that of ``old`` stays and the change is incompatible."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        fields, changes = [], []
        names = set(new.names)
        for f in old.fields:
            at = f"{path}.{f.name}" if path else f.name
            if f.name not in names:
                fields.append(T.StructField(f.name, f.dataType, True))
                changes.append(Change(at, "removed", f.dataType.simpleString(), None, True))
                continue
            dtype, inner = compare(f.dataType, new[f.name].dataType, at)
            fields.append(T.StructField(f.name, dtype, True))
            changes += inner
        known = set(old.names)
        for f in new.fields:
            if f.name not in known:
                at = f"{path}.{f.name}" if path else f.name
                fields.append(T.StructField(f.name, f.dataType, True))
                changes.append(Change(at, "added", None, f.dataType.simpleString(), True))
        return T.StructType(fields), changes
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        dtype, changes = compare(old.elementType, new.elementType, f"{path}[]")
        return T.ArrayType(dtype), changes
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        k, first = compare(old.keyType, new.keyType, path + "{key}")
        v, second = compare(old.valueType, new.valueType, path + "{value}")
        return T.MapType(k, v), first + second
    if old == new:
        return old, []
    nested = (T.StructType, T.ArrayType, T.MapType)
    said = old.simpleString(), new.simpleString()
    both = None if isinstance(old, nested) or isinstance(new, nested) else widest(old, new)
    if both is None:
        return old, [Change(path, "retyped", *said, False)]
    return both, [Change(path, "narrower" if both == old else "widened", *said, True)]


def table_schema(spark: SparkSession, drift_path: str) -> T.StructType | None:
    """The schema that holds all loads so far, by the drift log; None before
    the first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(drift_path)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    last = spark.read.schema(f"{CHANGES}, seq long").parquet(drift_path).agg(
        F.max_by("table_schema", "seq").alias("table_schema")).first()[0]
    return T.StructType.fromJson(json.loads(last))


def land(df: DataFrame, path: str, loads_path: str, drift_path: str, load_id: str, inserted_at: str) -> list[Change]:
    """Land a load (``append_load``) behind the gate: its schema is compared
    with that of the loads before; an incompatible change stops it before a
    file is written, else the changes are logged, one row each, with the schema
    that holds all loads, and the load is landed.  A first load is one row
    without a path.  One writer at a time.  A load that dies behind its log rows
    leaves a schema that still holds all loads; landed again, it compares with
    that and logs no change twice."""
    spark = df.sparkSession
    known = table_schema(spark, drift_path)
    both, changes = compare(known, df.schema) if known is not None else (df.schema, [])
    bad = [c for c in changes if not c.compatible]
    if bad:
        raise IncompatibleSchema(bad)
    rows = [(load_id, c.path, c.change, c.old_type, c.new_type, c.compatible, both.json()) for c in changes]
    if known is None or both != known:
        rows = rows or [(load_id, None, "first", None, None, True, both.json())]
    if rows:
        seq = 0 if known is None else spark.read.parquet(drift_path).agg(F.max("seq") + 1).first()[0]
        spark.createDataFrame(rows, CHANGES).withColumn("seq", F.lit(seq).cast("long")).coalesce(1).write.mode(
            "append").parquet(drift_path)
    append_load(df, path, loads_path, load_id, inserted_at)
    return changes


def read_landed(spark: SparkSession, path: str, loads_path: str, drift_path: str) -> DataFrame:
    """All committed loads under the schema that holds them, in one scan: the
    reader widens what a file has narrower and fills what it lacks with NULL."""
    schema = table_schema(spark, drift_path)
    for c in LINEAGE_COLUMNS:
        schema = schema.add(c, T.StringType())
    return read_loads(spark, path, loads_path, schema=schema)
