"""Small append-only tables: the run log and the silver ledger.

The run log takes one folder per append, so writers never collide and readers
take all folders together. The ledger is numbered besides: rows are staged in a
folder of their own and count once a commit file of the next number names that
folder. The file is created only if it is absent, so of two writers that
saw the same state one gets the number and the other is told. (That creation is
atomic on HDFS and stores with conditional creation; a local disk is checked
and then written.)
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.sources import paths

_DIGITS = 12


def append(spark: SparkSession, folder: str, frame: DataFrame) -> None:
    frame.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/{uuid.uuid4().hex}")


def read(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All rows; no rows if nothing was ever appended. Any failure raises."""
    if not paths.exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)


def newest_entry(spark: SparkSession, folder: str) -> int:
    """Number of the newest commit, 0 before the first."""
    return max((int(name) for name, _ in paths.children(spark, f"{folder}/commits") if name.isdigit()), default=0)


def stage(frame: DataFrame, folder: str) -> str:
    """Write the rows of an entry where no reader takes them yet; returns their name."""
    name = uuid.uuid4().hex
    frame.coalesce(1).write.mode("errorifexists").parquet(f"{folder}/rows/staged={name}")
    return name


def commit(spark: SparkSession, folder: str, number: int, staged: str) -> bool:
    """Make the staged rows entry ``number``; False if that number is taken."""
    return paths.create_text(spark, f"{folder}/commits/{number:0{_DIGITS}d}", staged)


def read_entries(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All committed rows with their ``entry`` number (a number whose writer died
    between taking it and naming its rows has none)."""
    if not newest_entry(spark, folder):
        return spark.createDataFrame([], StructType([*schema.fields]).add("entry", "long"))
    number = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).cast("bigint")
    commits = spark.read.text(f"{folder}/commits").select(F.col("value").alias("staged"), number.alias("entry"))
    held = {name.removeprefix("staged=") for name, _ in paths.children(spark, f"{folder}/rows")}
    lost = sorted({r["staged"] for r in commits.select("staged").collect()} - held)  # one name per append
    if lost:
        raise FileNotFoundError(f"{folder} has lost the rows of {len(lost)} entries: {lost[:3]}")
    rows = spark.read.schema(StructType([*schema.fields]).add("staged", "string")).option("basePath", f"{folder}/rows").parquet(f"{folder}/rows")
    return rows.join(commits, "staged").select(*schema.fieldNames(), "entry")
