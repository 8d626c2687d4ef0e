"""Readers and writers for tables, reports and run metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from parcelcast.contracts import ContractError
from parcelcast.functions.expressions import nan_to_null

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with an explicit schema; unreadable cells and NaN become NULL."""
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampFormat", TIMESTAMP_TEXT)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return rows.withColumns({
        f.name: nan_to_null(f.name) for f in schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    })


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("timestampFormat", TIMESTAMP_TEXT).csv(path)
    return path


def write_report_csv(df: DataFrame, path: str) -> str:
    """One CSV file for a report whose row count is fixed by its design (splits, rules, features, bins)."""
    return write_csv(df.repartition(1), path)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_metadata(row: DataFrame, path: str) -> str:
    """One nested row of run metadata as JSON."""
    row.repartition(1).write.mode("overwrite").json(path)
    return path


def read_metadata(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def _file_listing(spark: SparkSession, path: str, glob: str, recursive: bool = False) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path)


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Name, size and time of each file; the content column is pruned, so no file is opened."""
    return _file_listing(spark, path, glob).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), "modificationTime"
    )


def require_files(spark: SparkSession, path: str, expected: Sequence[str], glob: str = "*") -> DataFrame:
    """The inventory, or an error naming expected files that are not there."""
    found = file_inventory(spark, path, glob)
    wanted = spark.createDataFrame([(name,) for name in expected], "file string")
    missing = sorted(r.file for r in wanted.join(found, "file", "left_anti").collect())
    if missing:
        raise ContractError(f"missing files under {path}: {missing}")
    return found


def artifact_fingerprint(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SHA-256 of each file of an artifact and of the whole artifact (hashes in path order)."""
    root = path.rstrip("/") + "/"
    files = _file_listing(spark, path, glob, recursive=True).select(
        F.substring_index("path", root, -1).alias("file"), F.sha2("content", 256).alias("sha256")
    )
    entries = F.sort_array(F.collect_list(F.struct("file", "sha256")))
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.sha2(F.concat_ws("", F.transform(entries, lambda e: e["sha256"])).cast("binary"), 256).alias("sha256"),
    )
