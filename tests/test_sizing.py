from funnelwright.plans.sizing import LARGEST_SPLIT, MOST_PARTITIONS, sized_for, task_sizes
from funnelwright.sources import stored_bytes, write_table

MB, TB = 1 << 20, 1 << 40


def test_small_input_keeps_the_settings():
    assert task_sizes(10 * MB, 200, 128 * MB) == (200, 128 * MB)
    assert task_sizes(0, 8, 128 * MB) == (8, 128 * MB)


def test_large_input_raises_them_within_limits():
    assert task_sizes(1 * TB, 200, 128 * MB) == (4096, 128 * MB)
    assert task_sizes(100 * TB, 200, 128 * MB) == (MOST_PARTITIONS, LARGEST_SPLIT)
    assert task_sizes(1 * TB, 50_000, 2 * LARGEST_SPLIT) == (50_000, 2 * LARGEST_SPLIT)


def test_expansion_counts_for_shuffles_only():
    assert task_sizes(1 * TB, 200, 128 * MB, expansion=4) == (4 * 4096, 128 * MB)
    assert task_sizes(25 * TB, 200, 128 * MB, expansion=4) == (MOST_PARTITIONS, -(-25 * TB // 100_000))
    assert task_sizes(100 * TB, 200, 128 * MB, expansion=4) == (MOST_PARTITIONS, LARGEST_SPLIT)


def test_settings_hold_within_the_block_only(spark, tmp_path, monkeypatch):
    write_table(spark.range(1000), str(tmp_path), "t")
    n_bytes = stored_bytes(spark, f"{tmp_path}/t")
    assert n_bytes == sum(file.stat().st_size for file in (tmp_path / "t").glob("[!.]*"))
    assert stored_bytes(spark, f"{tmp_path}/*") == n_bytes
    assert stored_bytes(spark, f"{tmp_path}/nothing") == 0
    monkeypatch.setattr("funnelwright.plans.sizing.SHUFFLE_BYTES", n_bytes // 10)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    with sized_for(spark, str(tmp_path), expansion=4):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= 40
    assert before == (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.files.maxPartitionBytes"))
    for text in ("128m", "128MB", "134217728", "134217728b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", text)
        with sized_for(spark, str(tmp_path)):
            assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(128 * MB)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == text
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[1])


def test_merged_size_holds_within_the_block_only(spark, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    with sized_for(spark, str(tmp_path), merge_to=8 * MB):
        assert spark.conf.get(name) == str(8 * MB)
    assert spark.conf.get(name) == before


def test_aggregations_have_no_small_first_map_within_the_block(spark, tmp_path):
    name = "spark.sql.codegen.aggregate.map.twolevel.enabled"
    before = spark.conf.get(name)
    with sized_for(spark, str(tmp_path)):
        assert spark.conf.get(name) == "false"
    assert spark.conf.get(name) == before
