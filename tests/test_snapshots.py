"""The snapshots as files: rows that are stored as lines, and whose texts are made where they are written."""

from datetime import date

from pyspark.sql import functions as F

from funnelwright.sources import read_table
from funnelwright.sources.files import SOURCE_FILE, read_csv_folder
from verification.fixture import raw_snapshots, snapshot_lines, snapshots_of
from verification.queries import _csv_snapshots_in_turn, _write_csv_snapshots


def _tables(spark, folder):
    """Orders 97, 194, 970 and 1,940 lose their number in the report, the last two their hashes too; order 5 is there twice."""
    customers = [(1, "AUTO  MOBILE", 0), (2, None, 0), (1, "MACHINERY", 0), (None, "BUILDING", 0)]
    spark.createDataFrame(customers, "c_custkey long, c_mktsegment string, c_nationkey int").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(0, "PERU"), (1, None)], "n_nationkey int, n_name string").write.parquet(f"{folder}/nation.parquet")
    keys = [5, 5, 10, 20, 97, 194, 970, 1940, None]
    orders = [(key, 1 + turn % 2, "FOP"[turn % 3], date(1995, 1, 2) if turn % 4 else None, "1-URGENT") for turn, key in enumerate(keys)]
    kinds = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date, o_orderpriority string"
    spark.createDataFrame(orders, kinds).write.parquet(f"{folder}/orders.parquet")
    items = [(key, turn % 3 + 1 if turn else None, flag) for turn in range(4) for key in keys for flag in ("A", "N", "R", None)]
    spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_returnflag string").write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_lines_make_the_rows_of_the_sql(spark, tmp_path):
    folder = _tables(spark, tmp_path)
    expected, found = raw_snapshots(spark, folder), snapshots_of(snapshot_lines(spark, folder))
    assert found.columns == expected.columns
    assert expected.count() > 100
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_rows_move_as_lines_and_copies_share_a_file(spark, tmp_path):
    folder, out = _tables(spark, tmp_path / "in"), str(tmp_path / "out")
    assert [*_csv_snapshots_in_turn(spark, folder, out)] == [f"{out}/snapshot-*"] * 3
    assert set(read_table(spark, out, "_source").columns) == set(snapshot_lines(spark, folder).columns)
    raw = raw_snapshots(spark, folder)
    for snapshot in "ANR":
        written = read_csv_folder(spark, f"{out}/snapshot-{snapshot}").withColumnRenamed("CITY", "CityName")
        expected = raw.filter(F.col("snapshot") == f"snapshot-{snapshot}")
        assert written.count() == expected.count() > 0
        shared = [F.col(f"`{name}`") for name in raw.columns if name not in ("snapshot", "Dispo")]
        assert written.groupBy(*shared).agg(F.count_distinct(SOURCE_FILE).alias("files")).filter("files > 1").isEmpty()


def test_lines_hold_the_customer_once(spark, tmp_path):
    """The key of the join is in both of its tables, and a line needs it once."""
    assert not {"o_custkey", "c_custkey"} <= set(snapshot_lines(spark, _tables(spark, tmp_path)).columns)


def test_snapshots_are_compressed_and_their_lines_go(spark, tmp_path):
    folder, out = _tables(spark, tmp_path / "in"), tmp_path / "out"
    assert _write_csv_snapshots(spark, folder, str(out)) == f"{out}/snapshot-*"
    assert sorted(entry.name for entry in out.iterdir()) == ["snapshot-A", "snapshot-N", "snapshot-R"]
    assert {file.name.split(".", 1)[1] for file in out.glob("*/part-*")} == {"csv.gz"}
    found, expected = read_csv_folder(spark, f"{out}/snapshot-*"), raw_snapshots(spark, folder)
    assert found.count() == expected.filter("snapshot IS NOT NULL").count() > 0
