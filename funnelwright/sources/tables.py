"""Stored tables: replaced as a whole, or grown by numbered batches.

Every write makes a new folder, and an empty marker file beside it says that it is complete. Creating one empty file is a single
step on every store, so a reader sees the table before a write or after it, and a job that dies leaves the old table as it was.

``root/name/``
    the files of the first version, which has no table to protect
    ``_v00000007-<id>``, ``v00000007-<id>/``   marker and folder of a later version; the last marker is the table
    ``batch-000000003/``                        a table of its own: what batch 3 brought
    ``through-000000002/``                      all batches up to number 2, merged
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_MARKER = re.compile(r"_v(\d{8})-[0-9a-f]{32}")
_DIRECT = "0" * 32  # the id of a version whose files lie in the table's folder itself
_CODEC = "zstd"  # hashes in hexadecimal digits take half the bytes that they take with the default
_PART = re.compile(r"(batch|through)-(\d{9})")
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written inside go when it is written, rather than when the driver collects its garbage.

    What is stored is read from its files from then on. So a job of many steps has the shuffle files of one on its disks.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table written by :func:`write_table` or :func:`write_batch`. Its files share one schema, so no footers are merged."""
    return spark.read.parquet(*table_paths(spark, f"{root.rstrip('/')}/{name}"))


def write_table(df: DataFrame, root: str, name: str) -> DataFrame:
    """Replace table ``name`` below ``root`` and return it as stored, with a lineage of one file scan.

    The version before stays for those that are reading it; older ones go, and what writes that died have left with them.
    """
    spark, folder = df.sparkSession, f"{root.rstrip('/')}/{name}"
    markers, names = _markers(spark, folder), _names(spark, folder)
    if not markers and "_SUCCESS" not in names:
        with without_leftovers(spark):
            df.write.mode("overwrite").parquet(folder, compression=_CODEC)
        _mark(spark, folder, f"v{1:08d}-{_DIRECT}")
        return spark.read.schema(df.schema).parquet(folder)
    last = int(_MARKER.fullmatch(markers[-1])[1]) if markers else 1
    version = f"v{last + 1:08d}-{uuid.uuid4().hex}"
    with without_leftovers(spark):
        df.write.parquet(f"{folder}/{version}", compression=_CODEC)
    _mark(spark, folder, version)
    for entry in names:
        number = re.match(r"_?v(\d{8})-", entry)
        if (int(number[1]) if number else 1) < last:
            remove(spark, f"{folder}/{entry}")
    return spark.read.schema(df.schema).parquet(f"{folder}/{version}")


def write_batch(df: DataFrame, root: str, name: str, number: int) -> DataFrame:
    """Add batch ``number`` to table ``name``, or replace what it has brought before; returns the batch as stored.

    So a batch that is written again, as its first writer died before it could say that it had ended, counts once. Batches that
    are merged already are left alone. A table that is replaced as a whole takes no batches.
    """
    folder = f"{root.rstrip('/')}/{name}"
    if _markers(df.sparkSession, folder):
        raise ValueError(f"{folder} is replaced as a whole, it has no batches")
    merged, _ = _parts(df.sparkSession, folder)
    if merged is not None and number <= merged:
        return read_table(df.sparkSession, folder, _part("through", merged))
    return write_table(df, folder, _part("batch", number))


def read_batches(spark: SparkSession, root: str, name: str, after: int = -1, through: int | None = None) -> DataFrame | None:
    """The rows of the batches with numbers above ``after`` and up to ``through``; None if there are none.

    Batches that are merged can only be read together.
    """
    folder = f"{root.rstrip('/')}/{name}"
    merged, numbers = _parts(spark, folder)
    last = max([*numbers, -1 if merged is None else merged]) if through is None else through
    wanted = [number for number in numbers if after < number <= last]
    if merged is not None and after < merged:
        if after >= 0 or last < merged:
            raise ValueError(f"batches of {folder} are merged up to {merged}, they cannot be read from {after + 1} to {last}")
        parts = [_part("through", merged)]
    else:
        parts = []
    paths = [path for part in [*parts, *[_part("batch", number) for number in wanted]] for path in table_paths(spark, f"{folder}/{part}")]
    return spark.read.parquet(*paths) if paths else None


def last_batch(spark: SparkSession, root: str, name: str) -> int:
    """The number of the last batch, -1 if there is none."""
    merged, numbers = _parts(spark, f"{root.rstrip('/')}/{name}")
    return max([*numbers, -1 if merged is None else merged])


def merge_batches(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Write all batches of a table as one, so that readers have few folders to list; the batches go afterwards."""
    folder = f"{root.rstrip('/')}/{name}"
    before, numbers = _parts(spark, folder)
    if not numbers:
        return read_table(spark, root, name)
    merged = write_table(read_table(spark, root, name), folder, _part("through", numbers[-1]))
    for number in numbers:
        remove(spark, f"{folder}/{_part('batch', number)}")
    if before is not None:
        remove(spark, f"{folder}/{_part('through', before)}")
    return merged


def table_paths(spark: SparkSession, folder: str) -> list[str]:
    """The folders that hold a table's rows now; ``folder`` itself if it is no table of this module's."""
    markers = _markers(spark, folder)
    if markers:
        return [folder if markers[-1].endswith(_DIRECT) else f"{folder}/{markers[-1][1:]}"]
    merged, numbers = _parts(spark, folder)
    parts = ([_part("through", merged)] if merged is not None else []) + [_part("batch", number) for number in numbers]
    return [path for part in parts for path in table_paths(spark, f"{folder}/{part}")] or [folder]


def _mark(spark: SparkSession, folder: str, version: str) -> None:
    files, path = _file_system(spark, f"{folder}/_{version}")
    files.create(path, False).close()


def remove(spark: SparkSession, path: str) -> None:
    files, location = _file_system(spark, path)
    files.delete(location, True)


def _part(kind: str, number: int) -> str:
    return f"{kind}-{number:09d}"


def _parts(spark: SparkSession, folder: str) -> tuple[int | None, list[int]]:
    """Up to which batch the table is merged, and the numbers of complete batches after it, in order."""
    found: dict[str, list[int]] = {"batch": [], "through": []}
    for entry in _names(spark, folder):
        part = _PART.fullmatch(entry)
        if part and _markers(spark, f"{folder}/{entry}"):
            found[part[1]].append(int(part[2]))
    merged = max(found["through"], default=None)
    return merged, sorted(number for number in found["batch"] if merged is None or number > merged)


def _markers(spark: SparkSession, folder: str) -> list[str]:
    return [name for name in _names(spark, folder) if _MARKER.fullmatch(name)]


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names in a folder, none if there is no such folder or it is a file or a glob."""
    files, path = _file_system(spark, folder)
    if not files.exists(path) or not files.getFileStatus(path).isDirectory():
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(path))


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location
