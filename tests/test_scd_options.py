"""Versions per day, by row number and outside a band, against a plain loop."""

import datetime
import random

import pytest

from starflow.operators.scd import scd2_from_events

DAY = datetime.date(2024, 1, 1)
SCHEMA = "k int, name string, price double, d date, r string"


def on(n):
    return DAY + datetime.timedelta(days=n)


def versions(spark, rows, **options):
    got = scd2_from_events(spark.createDataFrame(rows, SCHEMA), "k", ["name", "price"], "d", "r", "sk", **options)
    return sorted(((r.k, r.name, r.price, r.valid_from, r.valid_to, r.is_current) for r in got.collect()), key=str)


def brute(rows, tolerance=0.0, first_by="value"):
    """One row per day and key, folded in order."""
    out = []
    for k in {r[0] for r in rows}:
        last = {}
        for r in sorted((r for r in rows if r[0] == k), key=lambda r: (r[3], r[4])):
            last[r[3]] = r
        mine, before, kept = [], None, None
        for d in sorted(last):
            _, name, price, _, _ = last[d]
            new = before is None or name != before[0] or (first_by == "value" and before[0] is None)
            if price is None or kept is None:
                new = new or price != kept
            else:
                new = new or abs(price - kept) > tolerance * abs(kept)
            if new:
                mine.append((k, name, price, d))
                kept = price
            before = (name,)
        ends = [m[3] for m in mine[1:]] + [None]
        out += [(*m, e, e is None) for m, e in zip(mine, ends, strict=True)]
    return sorted(out, key=str)


def test_a_drifting_price_opens_a_version_when_it_left_the_band(spark):
    """Each day 1 % more: no step leaves a band of 5 %, the sum of them does."""
    rows = [(1, "a", 100 * 1.01 ** n, on(n), "r") for n in range(30)]
    got = versions(spark, rows, one_per_day=True, tolerance={"price": 0.05})
    assert [v[3] for v in got] == [on(n) for n in range(0, 30, 5)]  # 1.01 ** 5 > 1.05
    assert len(versions(spark, rows)) == 30
    # There and back inside the band is no history at all.
    rows = [(1, "a", 100.0 + 4 * (n % 2), on(n), "r") for n in range(30)]
    assert len(versions(spark, rows, one_per_day=True, tolerance={"price": 0.05})) == 1


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(9)
    # A third of all rows is of one key; names and prices may be missing.
    return [(0 if rng.random() < 0.34 else rng.randrange(1, 9),
             rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *[rng.uniform(90, 130) for _ in range(8)]]),
             on(rng.randrange(60)), f"{i:04d}") for i in range(900)]


@pytest.mark.parametrize("first_by", ["value", "row_number"])
@pytest.mark.parametrize("tolerance", [0.0, 0.05, 0.2])
def test_matches_a_plain_fold(spark, random_rows, first_by, tolerance):
    options = {"tolerance": {"price": tolerance}} if tolerance else {}
    got = versions(spark, random_rows, one_per_day=True, first_by=first_by, **options)
    assert got == brute(random_rows, tolerance, first_by)
    assert len({(v[0], v[3]) for v in got}) == len(got)


def test_a_name_that_is_never_known(spark):
    rows = [(1, None, 5.0, on(n), "r") for n in range(6)]
    assert len(versions(spark, rows)) == 6
    assert len(versions(spark, rows, first_by="row_number")) == 1


def test_undated_rows_and_options_that_do_not_fit(spark):
    rows = [(1, "a", 1.0, None, "r1"), (1, "b", 1.0, None, "r2"), (1, "a", 1.0, on(0), "r0"), (None, "n", 2.0, on(1), "x")]
    got = versions(spark, rows, one_per_day=True)
    assert [(v[0], v[1], v[3]) for v in got] == sorted([(1, "a", on(0)), (1, "b", None), (None, "n", on(1))], key=str)
    assert versions(spark, [], one_per_day=True, tolerance={"price": 0.1}) == []
    with pytest.raises(ValueError):
        versions(spark, rows, tolerance={"price": 0.1})
    with pytest.raises(ValueError):
        versions(spark, rows, first_by="rank")
