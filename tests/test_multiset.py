import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from funnelwright.operators import added, copies, kept, multiset, removed


@pytest.fixture(scope="module")
def sides():
    draw = random.Random(5)
    return [[(draw.choice(["a", "b", None]), draw.choice([1, 2, None]), draw.choice("xy")) for _ in range(n)] for n in (70, 90)]


def frames(spark, sides):
    return [spark.createDataFrame(rows, "`a.b` string, n int, c string").repartition(3) for rows in sides]


def test_differences_equal_counters(spark, sides, monkeypatch):
    monkeypatch.setattr(multiset, "_AT_ONCE", 3)
    old, new = frames(spark, sides)
    new = new.select("c", "n", "`a.b`")  # matched by name
    one, other = map(Counter, sides)
    for work, expected in ((added, other - one), (removed, one - other), (kept, one & other)):
        found = work(old, new)
        assert found.columns == old.columns
        assert Counter(map(tuple, found.collect())) == expected
    counted = {tuple(r)[:3]: (r.n_old, r.n_new) for r in copies(old, new).collect()}
    assert counted == {row: (one[row], other[row]) for row in one | other}


def test_differences_equal_sparks_own(spark, sides):
    old, new = frames(spark, sides)
    for ours, theirs in ((added(old, new), new.exceptAll(old)), (kept(old, new), old.intersectAll(new))):
        assert Counter(map(tuple, ours.collect())) == Counter(map(tuple, theirs.collect()))


def test_differences_of_nothing(spark, sides):
    old, new = frames(spark, sides)
    assert added(old, new.limit(0)).isEmpty() and kept(old, new.limit(0)).isEmpty()
    assert removed(old, new.limit(0)).count() == len(sides[0]) and removed(old, old).isEmpty()


def test_very_many_copies(spark):
    old = spark.range(0).select(F.lit("same").alias("k"))
    new = spark.range(0, 350_001, 1, 4).select(F.lit("same").alias("k"))
    assert added(old, new).count() == 350_001


def test_other_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="columns differ"):
        added(spark.range(1), spark.range(1).toDF("x"))
