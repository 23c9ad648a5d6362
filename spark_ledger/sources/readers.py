"""Typed readers and schema conformance (A-1, A-2, A-4, A-5, A-7, A-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, infer: bool = False,
             encoding: str = "UTF-8") -> DataFrame:
    """A-1 / A-15: CSV with a header row; a declared schema for fixed inputs,
    inference only for the optional-column rule files; ``encoding`` for
    Windows exports (cp1252).  A UTF-8 BOM is dropped by the reader (A-4)."""
    r = spark.read.option("header", True).option("encoding", encoding)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """A-2: insert by name into a fixed schema — columns matched
    case-insensitively, missing ones null, every column cast to its type;
    extra columns are dropped."""
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        c = F.col(f"`{src}`") if src is not None else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_parquet_union(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A-5: one dataset over several folders (e.g. two path depths)."""
    return spark.read.parquet(*paths)


def read_parquet_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """A-7 (read side): a table that may not exist yet is None, not an error."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path) if root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root) else None
