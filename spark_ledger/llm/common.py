"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_ledger.session import checkpoint_dir, cut_lineage, release  # noqa: F401

#: whitespace that separates words: \x20 and \x09-\x0D (fixed by the contract)
SPACE = "\\x20\\x09-\\x0D"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that were started
    elsewhere: once per application, through Spark's own file service.  A
    PYTHONPATH that names the package's folder makes this needless."""
    root, app = Path(__file__).resolve().parents[2], spark.sparkContext.applicationId
    if app in _SHIPPED or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    name = Path(__file__).resolve().parents[1].name
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), name), "zip", root, name))
    _SHIPPED.add(app)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder for a written intermediate table below the shared
    checkpoint folder; unique per call, so runs never meet."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/llm-{name}-{uuid.uuid4().hex[:12]}"


def _name_of(path: str) -> str:
    return path.rsplit("/", 1)[1].replace("-", "_")


def bucketed(df: DataFrame, path: str, key: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder in buckets by ``key``, as many as a
    shuffle has partitions, and read it back: a join by ``key`` deals its other side
    to the buckets and moves none of these rows.  Spark knows buckets by a table's
    entry in the session's catalog, so one is made (see ``drop_bucketed``)."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(_name_of(path))
    return spark.table(_name_of(path))


def drop_bucketed(spark: SparkSession, path: str) -> None:
    """Take back the catalog's entry; the folder goes with ``release``."""
    spark.sql(f"DROP TABLE IF EXISTS {_name_of(path)}")


def ascii_lower(col):
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
