"""Declared schemas ("contracts") of the landed sources.

Everything a sales export holds is landed as text; typing happens in staging
with try_* casts, so a bad cell becomes NULL plus a quarantine reason instead
of a failed load.
"""

from __future__ import annotations

from pyspark.sql import types as T

# FIXED VALUES: sales export columns after header normalisation, in order.
SALES_COLUMNS = [
    "order_id", "order_date", "ship_date", "customer_id", "customer_name", "country",
    "segment", "product_id", "product_name", "category", "quantity", "unit_price",
    "discount", "amount", "currency", "sales_rep", "order_channel", "tax",
]

# FIXED VALUES: header renames between export versions (after normalisation).
SALES_RENAMES = {"total_amount": "amount"}

SALES_CONTRACT = T.StructType([T.StructField(c, T.StringType(), True) for c in SALES_COLUMNS])

LINEAGE_COLUMNS = ["_load_id", "_row_id"]

FX_LANDING = T.StructType([
    T.StructField("date", T.StringType(), True),
    T.StructField("base", T.StringType(), True),
    T.StructField("quote", T.StringType(), True),
    T.StructField("rate", T.DoubleType(), True),
    T.StructField("requested", T.StringType(), True),
])

COUNTRY_JSON = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("objects", T.ArrayType(T.StructType([
            T.StructField("names", T.StructType([
                T.StructField("common", T.StringType()), T.StructField("official", T.StringType())])),
            T.StructField("codes", T.StructType([
                T.StructField("alpha_2", T.StringType()), T.StructField("alpha_3", T.StringType()),
                T.StructField("ccn3", T.StringType())])),
            T.StructField("region", T.StringType()),
            T.StructField("subregion", T.StringType()),
            T.StructField("population", T.LongType()),
            T.StructField("currencies", T.ArrayType(T.StructType([
                T.StructField("code", T.StringType()), T.StructField("name", T.StringType()),
                T.StructField("symbol", T.StringType())]))),
        ]))),
        T.StructField("meta", T.StructType([T.StructField("total", T.LongType())])),
    ])),
])
