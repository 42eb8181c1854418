import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from funnelwright.operators import full_outer_join, heavy_keys, left_join, unmatched
from funnelwright.operators.joins import crowds, slices_of


def brute_force(left, right):
    """LEFT JOIN on the first two fields; NULL matches nothing."""
    found = Counter()
    for k, m, x in left:
        matches = [u for k2, m2, u in right if None not in (k, m) and (k, m) == (k2, m2)]
        found.update((k, m, x, u) for u in matches or [None])
    return found


@pytest.fixture(scope="module")
def sides():
    rng = random.Random(1)
    keys = ["hot"] * 10 + ["a", "b", "c", None]
    left = [(rng.choice(keys), rng.choice([1, 2, None]), i % 7) for i in range(150)] + [("left only", 1, 0)] * 20
    right = [(rng.choice(keys), rng.choice([1, 2, None]), f"u{i}") for i in range(120)] + [("right only", 1, "v")] * 9
    return left, right


@pytest.mark.parametrize(
    "heavy",
    [
        None,
        [("hot", 1, 3, 1)],
        [("hot", 1, 1, 4), ("hot", 2, 2, 5)],
        [("hot", 1, 3, 3), ("a", 2, 2, 1), ("left only", 1, 4, 1), ("right only", 1, 1, 4), ("nowhere", 1, 2, 2)],
    ],
)
def test_left_join_equals_brute_force(spark, sides, heavy):
    left, right = sides
    left_frame = spark.createDataFrame(left, "k string, m int, x int").repartition(5)
    right_frame = spark.createDataFrame(right, "k string, m int, u string")
    heavy_frame = heavy and spark.createDataFrame(heavy, "k string, m int, _left_slices int, _right_slices int")
    joined = left_join(left_frame, right_frame, ["k", "m"], heavy_frame, slice_by=["u"])
    assert Counter(map(tuple, joined.select("k", "m", "x", "u").collect())) == brute_force(left, right)
    assert set(joined.columns) == {"k", "m", "x", "u"}


def test_required_columns(spark):
    left = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "k string, n int")
    right = spark.createDataFrame([("a", "u"), ("a", "v")], "k string, u string")
    joined = left_join(left, right, ["k"], required=["n"])
    expected = [("a", 1, "u"), ("a", 1, "v"), ("a", None, None), (None, 1, None)]
    assert Counter(map(tuple, joined.select("k", "n", "u").collect())) == Counter(expected)


def test_heavy_keys(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    frame = spark.range(30_000).select(hot.alias("k"), (F.col("id") % 2).alias("m"))
    other = spark.range(9_000).select(F.lit("wide").alias("k"), F.lit(7).cast("long").alias("m"))
    found = heavy_keys(frame, other, ["k", "m"], least_rows=1_000)
    assert found.columns == ["k", "m", "_left_slices", "_right_slices"]
    assert sorted(map(tuple, found.collect())) == [("hot", 0, 5, 1), ("hot", 1, 5, 1), ("wide", 7, 1, 9)]
    assert heavy_keys(frame, other, ["k", "m"]).isEmpty()
    assert heavy_keys(frame.limit(0), other.limit(0), ["k", "m"], least_rows=1).isEmpty()


def test_heavy_keys_of_counted_rows(spark):
    counted = spark.createDataFrame([("a", 30), ("a", 25), ("b", 49), (None, 99)], "k string, n long")
    other = spark.createDataFrame([("b",)], "k string")
    found = heavy_keys(counted, other, ["k"], least_rows=50, left_rows="n")
    assert list(map(tuple, found.collect())) == [("a", 2, 1)]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_heavy_keys_with_empty_tasks(spark, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        one_full_task = spark.range(0, 800, 1, 16).filter("id < 50").select(F.lit("a").alias("k"))
        nulls = spark.range(10).select(F.lit(None).cast("string").alias("k"))
        assert list(map(tuple, heavy_keys(one_full_task, nulls, ["k"], least_rows=10).collect())) == [("a", 5, 1)]
        assert heavy_keys(nulls, nulls, ["k"], least_rows=1).isEmpty()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_every_heavy_key_is_split(spark, threshold):
    """5,000 keys, all at the limit, whether the list of them can be broadcast or not."""
    many = spark.range(0, 20_000, 1, 8).select((F.col("id") % 5_000).alias("k"), F.col("id").alias("u"))
    heavy = heavy_keys(many.select("k"), many, ["k"], least_rows=2)
    assert heavy.groupBy("_left_slices", "_right_slices").count().collect() == [(2, 2, 5_000)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        joined = left_join(many.select("k"), many, ["k"], heavy, slice_by=["u"])
        assert joined.count() == 80_000 and joined.distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_task_gets_all_rows_of_a_heavy_key(spark):
    """Half of the left rows are copies of one row, and half of the right rows share another key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        id_text = F.col("id").cast("string")
        left = spark.range(0, 40_000, 1, 16).select(
            F.when(F.col("id") % 2 == 0, "copied").when(F.col("id") == 1, "crowded").otherwise(id_text).alias("k")
        )
        right = spark.range(0, 40_000, 1, 16).select(
            F.when(F.col("id") % 2 == 0, "crowded").when(F.col("id") == 1, "copied").otherwise(id_text).alias("k"),
            id_text.alias("u"),
        )
        heavy = heavy_keys(left, right, ["k"], least_rows=1_000)
        joined = left_join(left, right, ["k"], heavy, slice_by=["u"])
        sizes = joined.groupBy("k", F.spark_partition_id().alias("task")).count()
        largest = {k: (n, most) for k, n, most in sizes.groupBy("k").agg(F.sum("count"), F.max("count")).collect()}
        assert largest["copied"][0] == largest["crowded"][0] == 20_000
        assert largest["copied"][1] < 10_000 and largest["crowded"][1] < 10_000
        assert joined.count() == 20_000 + 20_000 + 19_999
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_adaptive_execution_splits_what_heavy_keys_leave(spark):
    """A third of the left rows share a key: adaptive execution cuts that partition up."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.md5(F.col("id").cast("string")))
        left = spark.range(0, 60_000, 1, 8).select(key.alias("k"), F.sha1(F.col("id").cast("string")).alias("x"))
        right = spark.range(2_000).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit(1).alias("u"))
        right = right.union(spark.createDataFrame([("hot", 2)], "k string, u int"))
        joined = left_join(left, right, ["k"])
        counts = {row.u: row.n for row in joined.groupBy("u").agg(F.count("*").alias("n")).collect()}
        assert counts[2] == 20_000 and sum(counts.values()) == 60_000
        joined.collect()
        assert "skewed" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)


HEAVY = [
    None,
    [],
    [("hot", 1, 3, 1)],
    [("hot", 1, 1, 4), ("hot", 2, 2, 5)],
    [("hot", 1, 3, 3), ("a", 2, 2, 1), ("left only", 1, 4, 2), ("right only", 1, 2, 4), ("nowhere", 1, 2, 2)],
]


@pytest.mark.parametrize("heavy", HEAVY)
def test_full_outer_join_equals_brute_force(spark, sides, heavy):
    left, right = sides
    left, right = left + [(None, 1, 0), ("left only", 1, 0)], right + [(None, None, "w"), ("right only", 1, "v")]
    left_frame = spark.createDataFrame(left, "k string, m int, x int").repartition(5)
    right_frame = spark.createDataFrame(right, "k string, m int, u string").repartition(3)
    heavy_frame = heavy if heavy is None else spark.createDataFrame(heavy, "k string, m int, _left_slices int, _right_slices int")
    joined = full_outer_join(left_frame, right_frame, ["k", "m"], heavy_frame)
    expected = Counter()
    for (k, m, x, u), n in brute_force(left, right).items():
        expected[k, m, x, u, True, u is not None] += n
    for (k, m, u, x), n in brute_force(right, left).items():
        if x is None:
            expected[k, m, None, u, False, True] += n
    found = joined.select("k", "m", "x", "u", "in_left", "in_right")
    assert Counter(map(tuple, found.collect())) == expected
    assert set(joined.columns) == {"k", "m", "x", "u", "in_left", "in_right"}


@pytest.mark.parametrize("heavy", HEAVY)
def test_unmatched_equals_brute_force(spark, sides, heavy):
    left, right = sides
    left_frame = spark.createDataFrame(left, "k string, m int, x int").repartition(5)
    right_frame = spark.createDataFrame(right, "k string, m int, u string")
    heavy_frame = heavy if heavy is None else spark.createDataFrame(heavy, "k string, m int, _left_slices int, _right_slices int")
    keys = {row[:2] for row in right if None not in row[:2]}
    found = unmatched(left_frame, right_frame, ["k", "m"], heavy_frame)
    assert found.columns == ["k", "m", "x"]
    assert Counter(map(tuple, found.collect())) == Counter(row for row in left if row[:2] not in keys)
    assert unmatched(left_frame, right_frame.limit(0), ["k", "m"], heavy_frame).count() == len(left)
    assert unmatched(left_frame.limit(0), right_frame, ["k", "m"], heavy_frame).isEmpty()


def test_a_hot_key_in_one_input_partition_is_cut(spark):
    left = spark.range(0, 60_000, 1, 1).select(F.lit("hot").alias("k"), F.col("id").alias("x"))
    right = spark.createDataFrame([("hot", "u")], "k string, u string")
    heavy = heavy_keys(left, right, ["k"], least_rows=5_000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else tasks are merged, which hides how rows are dealt
    try:
        for joined in (left_join(left, right, ["k"], heavy, ["u"]), unmatched(left, right.limit(0), ["k"], heavy), full_outer_join(left, right, ["k"], heavy)):
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            assert sum(sizes) == 60_000 and max(sizes) < 30_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_rows_of_a_key_that_both_sides_have_often_are_repeated_in_proportion(spark):
    """Slices of three rows would repeat 300 left rows 2,700 times and 8,100 right rows 100 times: two thirds of all pairs."""
    left = spark.range(300).select(F.lit("hot").alias("k"), F.col("id").alias("x"))
    right = spark.range(8_100).select(F.lit("hot").alias("k"), F.col("id").alias("u"))
    heavy = heavy_keys(left, right, ["k"], least_rows=3)
    [(_, rows, columns)] = map(tuple, heavy.collect())
    assert rows > 1 and columns > 1 and 300 * columns + 8_100 * rows <= 20 * 8_400
    for joined in (left_join(left, right, ["k"], heavy, ["u"]), full_outer_join(left, right, ["k"], heavy)):
        assert joined.count() == joined.select("x", "u").distinct().count() == 300 * 8_100


def test_crowds_give_the_heavy_keys_of_several_joins(spark):
    """A key with rows enough by one count only is heavy in the joins that go by that count."""
    one = spark.createDataFrame([("x",)] * 4 + [("y",)] * 2 + [(None,)] * 9, "k string")
    two = spark.createDataFrame([("x", 1), ("y", 5), ("z", 1), (None, 9)], "k string, n long")
    found = crowds([(one, {"a": F.count("*")}), (two, {"b": F.count("*"), "c": F.sum("n")})], ["k"], 3)
    assert sorted(map(tuple, found.collect())) == [("x", 4, None, None), ("y", None, 1, 5)]
    for left, right, rows, names in ((one, two, None, ("a", "b")), (two, one, "n", ("c", "a"))):
        expected = sorted(map(tuple, heavy_keys(left, right, ["k"], 3, rows).collect()))
        assert sorted(map(tuple, slices_of(found, ["k"], *names, 3).collect())) == expected != []


def test_full_outer_join_holds_no_product_of_a_key(spark):
    """Spark's own full join keeps all pairs of a key in a task's memory until the last one is made."""
    left = spark.range(400).select(F.when(F.col("id") < 300, "hot").otherwise("left").alias("k"), F.col("id").alias("x"))
    right = spark.range(400).select(F.when(F.col("id") < 300, "hot").otherwise("right").alias("k"), F.col("id").alias("u"))
    for heavy in (None, heavy_keys(left, right, ["k"], least_rows=50)):
        joined = full_outer_join(left, right, ["k"], heavy)
        assert "FullOuter" not in joined._jdf.queryExecution().optimizedPlan().toString()
        counts = {(r.in_left, r.in_right): r["count"] for r in joined.groupBy("in_left", "in_right").count().collect()}
        assert counts == {(True, True): 90_000, (True, False): 100, (False, True): 100}
