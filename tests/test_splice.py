"""Late events spliced into versions: equal to the full rebuild."""

import random

import pytest
from pyspark.sql import functions as F

from starflow.operators.scd import scd2_from_events
from starflow.operators.splice import splice_events

EVENTS = "user long, name string, price double, at timestamp, id long"
OPTIONS = ("user", ["name", "price"], "at", "id", "vid")


def events(n, seed, keys=6):
    """Events of few keys, one of which has a third; equal times, repeats, nulls."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = rng.choice([0, 0, 0, None, *range(1, keys)])
        rows.append((user, rng.choice(["a", "a", "b", None]), rng.choice([1.0, 1.05, 1.3, None]),
                     f"2024-01-{rng.randint(1, 9):02d} {rng.randint(0, 2):02d}:00:00", i))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, EVENTS.replace("at timestamp", "at string")).withColumn(
        "at", F.col("at").cast("timestamp"))


def rows_of(df):
    return sorted(map(repr, df.select("user", "name", "price", "valid_from", "valid_to", "vid", "is_current").collect()))


@pytest.mark.parametrize("seed,how", [
    (1, {}), (2, {"first_by": "row_number"}), (3, {"one_per_day": True}),
    (4, {"one_per_day": True, "first_by": "row_number", "tolerance": {"price": 0.1}})])
def test_random_late_batches_give_the_full_rebuild(spark, seed, how):
    rows = events(150, seed)
    cut = [rows[:90], rows[90:95], rows[95:]]
    history = frame(spark, cut[0])
    dim = scd2_from_events(history, *OPTIONS, **how)
    for batch in cut[1:]:
        late = frame(spark, batch)
        dim = splice_events(dim, history, late, *OPTIONS, **how)
        history = history.unionByName(late)
        assert rows_of(dim) == rows_of(scd2_from_events(history, *OPTIONS, **how))


def test_a_value_seen_again_opens_a_version_behind_a_late_one(spark):
    history = frame(spark, [(1, "a", 1.0, "2024-01-01", 1), (1, "a", 1.0, "2024-01-03", 2), (1, "b", 1.0, "2024-01-05", 3),
                            (2, "x", 1.0, "2024-01-01", 4)])
    dim = scd2_from_events(history, *OPTIONS)
    got = splice_events(dim, history, frame(spark, [(1, "c", 1.0, "2024-01-02", 9)]), *OPTIONS)
    assert [(r.name, r.valid_from.day) for r in got.filter("user = 1").orderBy("valid_from").collect()] == [
        ("a", 1), ("c", 2), ("a", 3), ("b", 5)]
    assert got.filter("user = 2").count() == 1


def test_edges(spark):
    history = frame(spark, events(20, 7))
    none = history.limit(0)
    dim = scd2_from_events(history, *OPTIONS)
    assert rows_of(splice_events(dim, history, none, *OPTIONS)) == rows_of(dim)
    assert rows_of(splice_events(dim.limit(0), none, history, *OPTIONS)) == rows_of(dim)
    # Rows without a time are not read; other columns neither.
    undated = frame(spark, [(0, "z", 1.0, None, 99)]).withColumn("since", F.lit(1)).withColumn("_splice_since", F.lit(2))
    assert rows_of(splice_events(dim, history, undated, *OPTIONS)) == rows_of(dim)
