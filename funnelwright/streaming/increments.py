"""Ingest of what is new: each run takes the files that no run before it has taken, and adds them to a table as batches.

A file stream finds the files. Its progress is kept beside the table, and a batch is written under its own number: a run that
died is taken up where it stopped, and the batch that it may have written already replaces itself. Copies of rows are looked for within a
file, and a file is in one batch, so the batches of any number of runs together are what one run over all files gives.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.operators.cleaning import count_invalid
from funnelwright.plans.jobs import INVALID, PARQUET_EXPANSION, conform_leads, conform_reports
from funnelwright.plans.sizing import sized_for_bytes
from funnelwright.sources.files import CSV_FILES, SOURCE_FILE, SOURCE_TIME, read_csv_files, read_parquet_files, unpacked_bytes
from funnelwright.sources.tables import last_batch, read_table, write_batch
from funnelwright.specs import SPECS, TableSpec

# Columns of the grown tables that say where a row is from, and when that file came.
FILE, TIME = "source_file", "source_time"

# Files of a batch. The driver reads the header line of each.
FILES_PER_BATCH = 10_000

INVALID_VALUES = "report_invalid_values"

_FILES = "path string, modificationTime timestamp, length long, content binary"


def increment_reports(
    spark: SparkSession, folder: str, out: str, spec: TableSpec = SPECS["reports"], files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """New CSV files in ``folder`` -> table ``reports``, which is returned, and the counts of invalid values of each batch.

    As :func:`funnelwright.plans.ingest_reports`, with all columns of the spec whether files have them or not, and with the columns
    ``source_file`` and ``source_time``. A file that changes under its name is not taken again.
    """

    def ingest(session: SparkSession, paths: Sequence[str], number: int) -> None:
        raw = _with_all_columns(read_csv_files(session, paths, spec, times=True), spec)
        conformed = conform_reports(raw, (SOURCE_FILE, SOURCE_TIME), spec, INVALID, (SOURCE_FILE, SOURCE_TIME))
        stored = write_batch(_with_source(conformed), out, "reports", number)
        write_batch(count_invalid(stored, INVALID), out, INVALID_VALUES, number)

    return _take_new_files(spark, folder, CSV_FILES, out, "reports", ingest, files_per_batch)


def increment_leads(
    spark: SparkSession, folder: str, out: str, spec: TableSpec = SPECS["leads"], files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """New Parquet files in ``folder`` -> table ``leads``, which is returned; see :func:`increment_reports`."""

    def ingest(session: SparkSession, paths: Sequence[str], number: int) -> None:
        raw = _with_all_columns(read_parquet_files(session, paths, spec, times=True), spec)
        conformed = conform_leads(raw, (SOURCE_FILE, SOURCE_TIME), spec, (SOURCE_FILE, SOURCE_TIME))
        write_batch(_with_source(conformed), out, "leads", number)

    return _take_new_files(spark, folder, "*.parquet", out, "leads", ingest, files_per_batch, PARQUET_EXPANSION)


def invalid_values_of_increments(spark: SparkSession, out: str) -> DataFrame:
    """(column_name, raw_value, n_rows) of all batches of reports."""
    counted = read_table(spark, out, INVALID_VALUES).groupBy("column_name", "raw_value")
    return counted.agg(F.sum("n_rows").alias("n_rows"))


def _take_new_files(
    spark: SparkSession,
    folder: str,
    glob: str,
    out: str,
    name: str,
    ingest: Callable[[SparkSession, Sequence[str], int], None],
    files_per_batch: int,
    expansion: int = 1,
) -> DataFrame:
    """Run ``ingest`` on the new files in batches, then return the table. Of the files only names and sizes are streamed."""

    def take(batch: DataFrame, number: int) -> None:
        files = batch.select("path", "length").collect()  # at most files_per_batch
        paths = sorted(row.path for row in files if row.length)
        if paths:
            with sized_for_bytes(batch.sparkSession, sum(unpacked_bytes(row.path, row.length) for row in files), expansion):
                ingest(batch.sparkSession, paths, number)

    listed = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", glob)
    listed = listed.option("maxFilesPerTrigger", files_per_batch).load(folder).select("path", "length")
    writer = listed.writeStream.foreachBatch(take).trigger(availableNow=True)
    writer.option("checkpointLocation", f"{out.rstrip('/')}/_progress/{name}").start().awaitTermination()
    if last_batch(spark, out, name) < 0:
        raise FileNotFoundError(f"no file to take in {folder} yet")
    return read_table(spark, out, name)


def _with_all_columns(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """``raw`` and, as NULL, the columns of the spec that it lacks. So all batches have one schema."""
    missing = [field.names[0] for field in spec.fields if field.source_in(raw.columns) is None]
    return raw.withColumns({name: F.lit(None).cast("string") for name in missing})


def _with_source(conformed: DataFrame) -> DataFrame:
    """Columns in the order of their names, so that batches agree in it too."""
    renamed = conformed.withColumnsRenamed({SOURCE_FILE: FILE, SOURCE_TIME: TIME})
    return renamed.select(*sorted(renamed.columns))
