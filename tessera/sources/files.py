"""File sources and sinks (A1-A4) and resumable ingest.

Excel and pickle have no Spark source; CSV and parquet stand in for them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

# Column contracts of the landed CSV files.
FACULTY = T.StructType([T.StructField("Name", T.StringType())])
PAPERS = T.StructType(
    [
        T.StructField("Professor", T.StringType()),
        T.StructField("Title", T.StringType()),
        T.StructField("Publication Year", T.StringType()),
        T.StructField("Authors", T.StringType()),
        T.StructField("Total Citations", T.StringType()),
    ]
)
# What a pandas CSV read takes for missing.
MISSING_TEXT = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """A1: header CSV; the missing markers of a pandas read are NULL.

    ``multi_line`` allows quoted line breaks, at the price of one task per file; ``splitcsv.read_csv``
    reads such files in parallel."""
    df = spark.read.schema(schema).option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path)
    return df.select(*(missing(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields))


def missing(col, kind: T.DataType):
    """Text that a pandas read takes for missing as NULL; other types as they are."""
    return F.when(~col.isin(MISSING_TEXT), col) if isinstance(kind, T.StringType) else col


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A3: header CSV."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """A2: a saved dataset snapshot (parquet)."""
    return spark.read.parquet(path)


def write_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """A4: dataset snapshot; labelled output is partitioned by level_1 so a
    cluster filter prunes whole folders."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def pending(keys: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Keys not processed yet (left anti join)."""
    return keys.join(processed.select(key).distinct(), key, "left_anti")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system that holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def table_version(spark: SparkSession, path: str) -> str:
    """A digest that changes when a table's files do: their names (which Spark
    has listed), number and bytes, and the folder's modification time. Two calls
    to the file system, however many files there are."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    total = fs.getContentSummary(p)
    files = sorted(spark.read.parquet(path).inputFiles())
    seen = [fs.makeQualified(p).toString(), fs.getFileStatus(p).getModificationTime(), total.getLength(), total.getFileCount(), *files]
    return hashlib.sha256("\n".join(map(str, seen)).encode()).hexdigest()[:32]


def resume_append(spark: SparkSession, batch: DataFrame, key: str, table_path: str) -> int:
    """A7 (batch): append one row of each key that is not in the table yet;
    returns the rows appended.

    Idempotent: re-running after a crash appends nothing twice. A table that
    exists but can't be read raises."""
    new = batch.dropDuplicates([key])
    if path_exists(spark, table_path):
        new = pending(new, spark.read.parquet(table_path), key)
    new = cut_lineage(new)  # the table it was compared with is about to change
    n = new.count()
    if n:
        new.write.mode("append").parquet(table_path)
    return n
