"""Settings that the caller has made stay."""

from starflow import session


def test_batch_rows_are_set_only_where_unset(spark):
    other = spark.newSession()
    session.share_code(other)
    assert other.conf.get(session._BATCH_ROWS) == "2000"
    third = spark.newSession()
    third.conf.set(session._BATCH_ROWS, "10000")
    session.share_code(third)
    assert third.conf.get(session._BATCH_ROWS) == "10000"


def test_methods_too_large_to_compile_are_split_where_unset(spark):
    other = spark.newSession()
    other.conf.unset("spark.sql.codegen.hugeMethodLimit")
    session.configure(other)
    assert int(other.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000
    third = spark.newSession()
    third.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    session.configure(third)
    assert third.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"
