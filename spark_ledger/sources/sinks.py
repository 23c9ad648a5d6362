"""Sinks (A-7, A-8, A-9): Parquet exports, partitioned CSV, plain CSV."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: files a task may hold open; a task with more partition values sorts the rest
OPEN_FILES = 64
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """Partition values are written as they come, each into its open file; Spark's
    default sorts a task's rows by them first."""
    old = spark.conf.get(_OPEN_FILES, None)
    spark.conf.set(_OPEN_FILES, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.unset(_OPEN_FILES) if old is None else spark.conf.set(_OPEN_FILES, old)


def export_parquet(tables: dict[str, DataFrame | None], root: str) -> list[str]:
    """A-7: write each available table as ``root/<name>.parquet``; tables that
    do not exist (None) are skipped.  Returns the names written."""
    written = []
    for name, df in tables.items():
        if df is None:
            continue
        df.write.mode("overwrite").parquet(os.path.join(root, f"{name}.parquet"))
        written.append(name)
    return written


def write_partitioned_csv(df: DataFrame, root: str, partition_cols: list[str], sort_cols: list[str] | None = None,
                          mode: str = "overwrite", fresh: bool = False) -> None:
    """A-8: one folder per partition value (e.g. vendor / route / as_of_date),
    header in every file.  Rows are clustered by the partition columns first so
    each partition is written by one task (one file per folder); with dynamic
    partition overwrite only the partitions present are replaced.  Rows are only
    sorted where ``sort_cols`` ask for it: otherwise they pass through, and a
    task's memory does not follow the size of a partition.

    ``fresh``: the root must not exist yet.  Nothing is there to be replaced, so
    tasks move their files into place and the driver none."""
    out = df.repartition(*partition_cols)
    if sort_cols:
        out = out.sortWithinPartitions(*partition_cols, *sort_cols)
    # helper columns (``__*``) only order the rows; the partition columns stay
    # a prefix of the ordering, so the writer keeps this order.
    out = out.drop(*[c for c in out.columns if c.startswith("__")])
    writer = out.write.mode("errorifexists" if fresh else mode).option("header", True).partitionBy(*partition_cols)
    if fresh:
        writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    if sort_cols:
        writer.csv(root)
    else:
        with _open_files(df.sparkSession):
            writer.csv(root)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """A-9: projection outputs as CSV with a header.  ``single_file`` only for
    small report tables (it funnels the write through one task)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
