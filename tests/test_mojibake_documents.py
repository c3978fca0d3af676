"""fix_mojibake over the documents table: known clean texts are damaged the way
a UTF-8 file read as Windows-1252 is, and must come back as they were."""

from pyspark.sql import functions as F

from starflow.functions.clean import fix_mojibake

# Characters whose UTF-8 bytes Windows-1252 cannot show; texts with one of
# them cannot have been damaged this way.
UNDAMAGEABLE = set("\u00c1\u00cd\u00cf\u00d0\u00dd\u00e0")


def test_damaged_documents_come_back(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    clean = {r.doc_id: r.text for r in docs if not UNDAMAGEABLE & set(r.text or "") and (r.text or "").strip()}
    assert sum(not t.isascii() for t in clean.values()) > 10
    damaged = spark.createDataFrame([(i, t.encode("utf-8").decode("cp1252")) for i, t in clean.items()],
                                    "doc_id long, text string")
    got = {r.doc_id: r.fixed for r in damaged.select("doc_id", fix_mojibake("text").alias("fixed")).collect()}
    assert got == {i: t.strip() for i, t in clean.items()}
