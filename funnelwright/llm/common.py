"""What the operators of this subpackage share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return. On bytes of
# UTF-8, Python's ``split`` without argument splits at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text, in order; none for NULL."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


BATCH_BYTES = 8 << 20  # of rows that go to a Python worker at once: a worker and its task's JVM hold copies of them


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside send Python workers batches of about ``BATCH_BYTES`` (or one row, if that is longer).

    Results do not depend on it. The session's own limit holds again afterwards, and throughout if it is smaller.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(name)
    given = re.fullmatch(r"(\d+)([bkmg]?)b?", own.strip().lower())
    if given and int(given[1]) * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(given[2], 1) <= BATCH_BYTES:
        yield
        return
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, own)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return root.rstrip("/")


class Scratch:
    """Tables of one run of an operator, in a new folder that all executors share.

    A stored table cuts the lineage: whoever reads it later survives the loss of any executor. Results read from these
    tables, so the folder may go once the result is written elsewhere.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        with small_batches(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove a table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
