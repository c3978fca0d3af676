"""Continuous delivery of landed sales exports (optional mode, build step 11).

Raw exports landing in a folder (Parquet, all-text contract plus lineage
columns) are picked up with ``readStream``; every micro-batch is staged and
merged by line key into a Parquet table partitioned by order month, inside
``foreachBatch``: it writes the months it touches and no other.

``dropDuplicatesWithinWatermark`` is not used on purpose: it keeps the first
arrival, and here a later correction must win.  The checkpoint location is in
the shared checkpoint folder, so a restarted query resumes exactly where it
stopped; a batch that was committed before a crash is known by its id and not
merged again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import clean_id_text, sign_int
from ..plans.pipeline import STAGED_COLUMNS, stage_sales
from ..session import checkpoint_dir, materialise
from ..sources import incremental
from ..sources.contracts import SALES_CONTRACT

RAW_SCHEMA = T.StructType(SALES_CONTRACT.fields + [
    T.StructField("_load_id", T.StringType()), T.StructField("_row_id", T.StringType())])


def versions(spark: SparkSession, target_root: str) -> list[int]:
    """Numbers of the complete commits of the target, oldest first."""
    return incremental.commits(spark, target_root)


SEED = "known price"


def _known_prices(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The last price of each day so far of the batch's products, as raw lines
    in the place of the line that had it."""
    asked = batch.select(clean_id_text("product_id").try_cast("bigint").alias("product_id")).distinct()
    daily = (target.filter(F.col("unit_price").isNotNull()).join(asked, "product_id", "left_semi")
             .groupBy("product_id", "order_date")
             .agg(F.max_by("unit_price", "_row_id").alias("unit_price"), F.max("_row_id").alias("_row_id")))
    text = {c: F.col(c).cast("string") for c in ("product_id", "order_date", "unit_price", "_row_id")}
    text |= {"_load_id": F.lit(SEED)}
    return daily.select(*[text.get(f.name, F.lit(None).cast("string")).alias(f.name) for f in RAW_SCHEMA])


def merge_batch(spark: SparkSession, batch: DataFrame, target_root: str, batch_id: str | None = None) -> None:
    """Stage one batch and merge it into the target: of the old and new rows
    of a line key the latest load stays, whatever the order of arrival; prices
    known from earlier batches carry forward.  Only the order months of the
    batch, and those its lines were in before, are written."""
    raw = batch.select(*[f.name for f in RAW_SCHEMA])
    if versions(spark, target_root):
        raw = raw.unionByName(_known_prices(incremental.read(spark, target_root), raw))
    staged = stage_sales(raw).filter(~F.col("is_quarantined") & (F.col("_load_id") != SEED))
    staged = staged.withColumn("line_key", F.concat_ws("-", F.col("order_id").cast("string"),
                                                       F.col("product_id").cast("string"),
                                                       sign_int("quantity").cast("string")))
    incremental.merge(materialise(staged, "stream-batch"), target_root, ["line_key"], incremental.month_of("order_date"),
                      prefer=["_load_id", "_row_id"], batch_id=batch_id)
    # Readers of the commit before may still be at work; older files go.
    incremental.expire(spark, target_root)


def start(spark: SparkSession, landing: str, target_root: str, query_name: str = "sales_stream",
          trigger_once: bool = False):
    """Start the stream; returns the StreamingQuery."""
    # A checkpoint belongs to one (source, target) pair: key it by both.
    pair = hashlib.md5(f"{landing}\n{target_root}".encode()).hexdigest()[:16]
    ckpt = f"{checkpoint_dir(spark)}/stream-{query_name}-{pair}"
    stream = spark.readStream.schema(RAW_SCHEMA).parquet(landing)
    writer = (stream.writeStream.queryName(query_name).option("checkpointLocation", ckpt)
              .foreachBatch(lambda df, epoch: merge_batch(spark, df, target_root, f"{query_name}-{pair}-{epoch}")))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_target(spark: SparkSession, target_root: str) -> DataFrame:
    return incremental.read(spark, target_root).select(*STAGED_COLUMNS, "line_key")
