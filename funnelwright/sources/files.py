"""File scans.

Raw scans carry the file each row came from in ``SOURCE_FILE``, because raw rows are deduplicated per file.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.functions.text import quoted
from funnelwright.operators.union import union_all_by_name
from funnelwright.sources.tables import table_paths
from funnelwright.specs import TableSpec

SOURCE_FILE = "_source_file"
SOURCE_TIME = "_source_time"

# CSV files, plain or compressed. A compressed file is one task, however large.
CSV_FILES = "*.csv{,.gz}"
# Bytes of text, about, for each byte of a compressed file.
_UNPACKED = 3

_HEADER_READERS = 32

# CSV files whose header lines the driver reads itself; beyond, tasks do.
_OPENED_BY_DRIVER = 500


def read_csv(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV files that share one header line. Every column is a string; nothing is read before an action.

    ``enforceSchema=False`` makes Spark compare the header of each file with the first one's: a file with other
    columns fails the query, where it would otherwise be read by position into the wrong columns.
    """
    return spark.read.option("header", True).option("enforceSchema", False).csv(paths)


def read_csv_folder(spark: SparkSession, folder: str, spec: TableSpec | None = None) -> DataFrame:
    """All ``*.csv`` and ``*.csv.gz`` files directly in ``folder``, whatever their headers, as one DataFrame.

    Files are grouped by header line: one scan per distinct header, not per file. Columns that a file lacks are
    NULL in its rows. With ``spec``, a column is first renamed to the leading one of the names that the spec
    allows for it, so that one column of the result holds it for all files; columns the spec does not use are
    prefixed ``_other_`` and still count when copies of rows are looked for.
    """
    return read_csv_files(spark, _list_files(spark, folder, CSV_FILES), spec, where=folder)


def read_csv_files(
    spark: SparkSession, paths: Sequence[str], spec: TableSpec | None = None, where: str = "the given list", times: bool = False
) -> DataFrame:
    """As :func:`read_csv_folder`, for a list of files; with ``times``, the files' times are in ``SOURCE_TIME``."""
    by_header: dict[str, list[str]] = {}
    for path, header in zip(paths, _header_lines(spark, paths), strict=True):
        if header is not None:
            by_header.setdefault(header, []).append(path)
    if not by_header:
        raise FileNotFoundError(f"no CSV file with a header line in {where}")
    scans = [_with_leading_names(_with_source_file(read_csv(spark, group), times), spec) for group in by_header.values()]
    return union_all_by_name(scans)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """One Parquet file, Spark-written Parquet folder or stored table."""
    return spark.read.parquet(*table_paths(spark, path.rstrip("/")))


def read_parquet_folder(spark: SparkSession, folder: str, spec: TableSpec | None = None) -> DataFrame:
    """All ``*.parquet`` files directly in ``folder``, merged by column name, missing columns NULL.

    Names are as in :func:`read_csv_folder`. Files that agree in types, and of the names that the spec allows for a column
    use one, are one scan, for which Spark reads the footers in a distributed job of its own. Otherwise there is one scan per
    distinct schema, and columns whose types differ become strings; then the driver asks for the schema of each file.
    """
    merged = _merged_parquet(spark, f"{folder.rstrip('/')}/*.parquet")
    if merged is not None and not _has_rival_names(merged, spec):
        return _with_leading_names(_with_source_file(merged), spec)
    return _scans_by_schema(spark, _list_files(spark, folder, "*.parquet", folders=True), spec, False)


def read_parquet_files(spark: SparkSession, paths: Sequence[str], spec: TableSpec | None = None, times: bool = False) -> DataFrame:
    """As :func:`read_parquet_folder`, for a list of files; with ``times``, the files' times are in ``SOURCE_TIME``."""
    merged = _merged_parquet(spark, *paths)
    if merged is not None and not _has_rival_names(merged, spec):
        return _with_leading_names(_with_source_file(merged, times), spec)
    return _scans_by_schema(spark, paths, spec, times)


def _scans_by_schema(spark: SparkSession, paths: Sequence[str], spec: TableSpec | None, times: bool) -> DataFrame:
    by_schema: dict[str, list[str]] = {}
    with ThreadPoolExecutor(_HEADER_READERS) as pool:
        for path, schema in zip(paths, pool.map(lambda path: spark.read.parquet(path).schema.json(), paths), strict=True):
            by_schema.setdefault(schema, []).append(path)
    scans = [spark.read.parquet(*group) for group in by_schema.values()]
    return union_all_by_name(_with_common_types([_with_leading_names(_with_source_file(scan, times), spec) for scan in scans]))


def stored_bytes(spark: SparkSession, pattern: str) -> int:
    """Size of the files and folders that match a path or glob."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(files.getContentSummary(status.getPath()).getLength() for status in files.globStatus(path) or [])


def csv_bytes(spark: SparkSession, folder: str) -> int:
    """Size of the text in the CSV files directly in ``folder``, about."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{CSV_FILES}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(unpacked_bytes(status.getPath().getName(), status.getLen()) for status in files.globStatus(path) or [])


def unpacked_bytes(path: str, length: int) -> int:
    """Size of the text in a file of ``length`` bytes, about."""
    return length * _UNPACKED if path.endswith(".gz") else length


def _merged_parquet(spark: SparkSession, *patterns: str) -> DataFrame | None:
    """The files as one scan; None if columns of one name differ in type."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*patterns)
    except Exception as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return None


def _has_rival_names(df: DataFrame, spec: TableSpec | None) -> bool:
    """Whether several of the names that the spec allows for a column occur."""
    return spec is not None and any(len(set(field.names) & set(df.columns)) > 1 for field in spec.fields)


def _with_common_types(scans: Sequence[DataFrame]) -> list[DataFrame]:
    """Columns that differ in type between the scans as strings in all of them."""
    kinds: dict[str, set[str]] = {}
    for scan in scans:
        for name, kind in scan.dtypes:
            kinds.setdefault(name, set()).add(kind)
    return [
        scan.select([quoted(name).cast("string").alias(name) if len(kinds[name]) > 1 else quoted(name) for name in scan.columns])
        for scan in scans
    ]


def _with_source_file(df: DataFrame, times: bool = False) -> DataFrame:
    time = [F.col("_metadata.file_modification_time").alias(SOURCE_TIME)] if times else []
    return df.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE), *time)


def _with_leading_names(df: DataFrame, spec: TableSpec | None) -> DataFrame:
    if spec is None:
        return df
    leading = {SOURCE_FILE: SOURCE_FILE, SOURCE_TIME: SOURCE_TIME}
    for field in spec.fields:
        source = field.source_in(df.columns)
        if source is not None:
            leading[source] = field.names[0]
    # The spec's names are case-sensitive, a union by name is not: set the other columns apart.
    return df.select([quoted(name).alias(leading.get(name, f"_other_{name}")) for name in df.columns])


def _list_files(spark: SparkSession, folder: str, glob: str, folders: bool = False) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{glob}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    names = [(status.getPath().getName(), status.getPath().toString()) for status in found if folders or status.isFile()]
    return sorted(full for name, full in names if not name.startswith(("_", ".")))


def _header_lines(spark: SparkSession, paths: Sequence[str]) -> list[str | None]:
    """First line of each file, None for an empty file.

    A few files are opened by the driver, which is quicker than a job. The header lines of many are found by a job, so the driver
    opens no file, however many there are.
    """
    read = _lines_read_by_driver if len(paths) <= _OPENED_BY_DRIVER else _lines_read_by_tasks
    return read(spark, paths)


def _lines_read_by_driver(spark: SparkSession, paths: Sequence[str]) -> list[str | None]:
    """Opens the files through the session's own Hadoop file system and reads one line of each; the opens overlap."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(path: str) -> str | None:
        location = jvm.org.apache.hadoop.fs.Path(path)
        files, codec = location.getFileSystem(conf), codecs.getCodec(location)
        if codec is not None and not files.getFileStatus(location).getLen():
            return None
        stream = files.open(location)
        try:
            text = stream if codec is None else codec.createInputStream(stream)
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
        finally:
            stream.close()

    with ThreadPoolExecutor(_HEADER_READERS) as pool:
        return list(pool.map(first_line, paths))


# While header lines are read: a file is one split and one task, and lines reach the task's Python one by one.
_FILE_PER_TASK = {
    "spark.sql.files.maxPartitionBytes": str(1 << 50),
    "spark.sql.files.openCostInBytes": str(1 << 50),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1",
}


def _lines_read_by_tasks(spark: SparkSession, paths: Sequence[str]) -> list[str | None]:
    """A task per file, which ends after the file's first line; the driver gets a line per file."""

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    before = {name: spark.conf.get(name) for name in _FILE_PER_TASK}
    for name, value in _FILE_PER_TASK.items():
        spark.conf.set(name, value)
    try:
        lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("path"))
        found = lines.mapInArrow(first, "value string, path string").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def full_name(location) -> str:
        return location.getFileSystem(conf).makeQualified(location).toString()

    by_name = {full_name(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.path))): row.value for row in found}
    return [by_name.get(full_name(jvm.org.apache.hadoop.fs.Path(path))) for path in paths]
