"""Typed readers and writers for the workforce tables."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.session import new_path
from rollcall.sources import schemas
from rollcall.sources.tables import Workforce


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Read one table with its declared schema. CSV cannot hold an empty string, so flags come back as ''.

    A CSV is matched to the schema by its own header, so a raw file may have fewer columns or another order.
    """
    schema = schemas.SCHEMAS[name]
    if fmt != "csv":
        df = spark.read.schema(schema).format(fmt).load(path)
    else:
        df = _read_csv(spark, schema, path)
    return df.fillna({"dq_flag": ""}) if "dq_flag" in df.columns else df


def _read_csv(spark, schema, path):
    """Every file by its own header: files are grouped by header line, and the groups meet by column name."""
    options = {"header": True, "multiLine": False, "escape": '"'}
    frames = []
    for header, files in _headers(spark, path).items():
        names = next(csv.reader([header.lstrip("\ufeff")]))
        text = spark.read.options(**options).schema(", ".join(f"`{c}` string" for c in names)).csv(files)
        known = set(names)
        frames.append(text.select(*[_typed(field, known) for field in schema.fields]))
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def _headers(spark, path) -> dict[str, list[str]]:
    """Files by header line, in one job: a file's header is the first line of its first block. Of large files no more than
    that block is gathered; of each file one line reaches the driver."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
    )
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    found: dict[str, list[str]] = {}
    for row in sorted(first.collect()):
        found.setdefault(row["header"], []).append(unquote(row["file"]))
    return found


def _typed(field, known) -> Column:
    if field.name not in known:
        return F.lit(None).cast(field.dataType).alias(field.name)
    raw = F.col(f"`{field.name}`")
    if field.dataType == schemas.WHOLE:
        raw = raw.cast("decimal(20,2)")  # a nullable whole number may have been written as 12.0
    return raw.cast(field.dataType).alias(field.name)


def read_workforce(spark: SparkSession, folder: str, fmt: str = "parquet") -> Workforce:
    """Read the five HR tables, the three benchmark tables, the provenance list and the workforce summary from
    ``folder/<table>``. Of the last three, those that the folder lacks are left out."""
    names = ["employees", "absences", "recruitment", "leavers", "training", "staff_profile", "earnings"]
    names += [n for n in ("pay_gap", "data_sources", "workforce_summary") if _there(spark, f"{folder}/{n}")]
    kinds = {"data_sources": "parquet"}  # it holds lists, which CSV has not
    return Workforce(**{n: read_table(spark, n, f"{folder}/{n}", kinds.get(n, fmt)) for n in names})


def _there(spark, path) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write one table. Parquet between stages; CSV (header, no index) for exchange."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def round_trip(df: DataFrame, name: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> DataFrame:
    """The rows as they come back from a file in the shared folder, in the columns that they had."""
    path = new_path(df.sparkSession, f"{name}.{fmt}")
    write_table(df, path, fmt, partition_by)
    return read_table(df.sparkSession, name, path, fmt).select(*df.columns)


def write_json_record(one_row: DataFrame, path: str) -> None:
    """Write a one-row record, such as the KPI export, as JSON."""
    one_row.coalesce(1).write.mode("overwrite").json(path)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
