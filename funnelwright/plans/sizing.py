"""Task sizes that follow the input.

Adaptive execution merges shuffle partitions that are too small but never makes more of them, so the starting number
has to fit the data: the default of 200 would put half a terabyte of a 100 TB table into each task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from funnelwright.sources.files import stored_bytes

_PARTITIONS = "spark.sql.shuffle.partitions"
_SPLIT = "spark.sql.files.maxPartitionBytes"
_MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# A small first map for the keys of an aggregation holds 65,536 of them. Jobs that look for copies have as many keys as rows, and then
# each row is looked up in vain there before the map proper.
_FIRST_MAP = "spark.sql.codegen.aggregate.map.twolevel.enabled"

SHUFFLE_BYTES = 256 << 20
# Each map task keeps a block per shuffle partition, so neither number may grow without end. At the limits tasks get
# larger and spill: 100 TB of files make 100,000 map tasks of 1 GB, and 40,000 shuffle partitions of 2.5 GB times the
# expansion of the files. 256 MB per shuffle partition hold up to 10 TB of shuffled bytes.
MOST_PARTITIONS = 40_000
MOST_SPLITS = 100_000
LARGEST_SPLIT = 1 << 30


def task_sizes(n_bytes: int, partitions: int, split: int, expansion: int = 1) -> tuple[int, int]:
    """Shuffle partitions and bytes per file split for ``n_bytes`` of files, of which shuffled rows take ``expansion``
    times as many; never below the given settings."""
    wanted_partitions = min(math.ceil(expansion * n_bytes / SHUFFLE_BYTES), MOST_PARTITIONS)
    wanted_split = min(math.ceil(n_bytes / MOST_SPLITS), LARGEST_SPLIT)
    return max(partitions, wanted_partitions), max(split, wanted_split)


@contextmanager
def sized_for(spark: SparkSession, *paths: str, expansion: int = 1, merge_to: int | None = None) -> Iterator[None]:
    """Raise the session's task sizes for the files below ``paths`` within the block; restore them afterwards.

    ``expansion`` is the factor by which rows in a shuffle exceed the bytes on disk. ``merge_to``: adaptive execution merges shuffle
    partitions up to so many compressed bytes, for rows that compress so well that the usual number holds too many of them.
    """
    with sized_for_bytes(spark, sum(stored_bytes(spark, path) for path in paths), expansion, merge_to):
        yield


@contextmanager
def sized_for_bytes(spark: SparkSession, n_bytes: int, expansion: int = 1, merge_to: int | None = None) -> Iterator[None]:
    """As :func:`sized_for`, for files whose size is known. Aggregations do without their small first map within the block."""
    before = {name: spark.conf.get(name) for name in (_PARTITIONS, _SPLIT, _FIRST_MAP, *([] if merge_to is None else [_MERGED]))}
    partitions, split = task_sizes(n_bytes, int(before[_PARTITIONS]), _in_bytes(before[_SPLIT]), expansion)
    spark.conf.set(_PARTITIONS, str(partitions))
    spark.conf.set(_SPLIT, str(split))
    spark.conf.set(_FIRST_MAP, "false")
    if merge_to is not None:
        spark.conf.set(_MERGED, str(merge_to))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _in_bytes(setting: str) -> int:
    """'134217728', '134217728b', '128m' or '128MB' in bytes."""
    text = setting.strip().lower().removesuffix("b")
    powers = {"k": 10, "m": 20, "g": 30, "t": 40}
    return int(text[:-1]) << powers[text[-1]] if text[-1] in powers else int(text)
