"""Monthly shard files: discovery, enforced schemas, month window, reload.

Two layouts are read the same way: one CSV per month (``orders202301.csv``, in
the folder or in sub-folders), or a folder partitioned by ``source_month``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyloom.config import RetailConfig
from tallyloom.operators.cleaning import ITEM_COLUMNS, ORDER_COLUMNS


def _all_text(columns: tuple[str, ...]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


# Facts are read as text, so malformed values stay visible to the audit.
RAW_SCHEMAS = {"orders": _all_text(ORDER_COLUMNS), "items": _all_text(ITEM_COLUMNS)}

# How written shards tell an empty text from a missing one.
MARKS = {"emptyValue": "", "nullValue": "\\N"}


def _any_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


def shard_glob(kind: str) -> str:
    return _any_case(kind) + "[0-9]" * 6 + _any_case(".csv")


def shard_files(spark: SparkSession, folder: str, kind: str) -> list[str]:
    """Paths of the month files of one kind, sorted. Reads no file content."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", shard_glob(kind)).load(folder).select("path")
    )
    return sorted(r["path"] for r in found.collect())


def read_month_files(spark: SparkSession, folder: str, kind: str, cfg: RetailConfig) -> DataFrame:
    """All month files in the window as one table with source_month.

    The header of every file must match the enforced schema, or the read fails.
    Files outside the window are dropped by name before they are opened.
    """
    month = F.regexp_extract("_metadata.file_name", r"(\d{6})\.[cC][sS][vV]$", 1)
    return (
        spark.read.schema(RAW_SCHEMAS[kind]).option("header", True).option("enforceSchema", False)
        .option("recursiveFileLookup", True).option("pathGlobFilter", shard_glob(kind))
        .csv(folder)
        .filter(month.between(cfg.start_month, cfg.end_month))
        .withColumn("source_month", month)
    )


def write_months(raw: DataFrame, folder: str, replace_all: bool = False) -> None:
    """Rows as CSV, one partition per month.

    Only the months present in ``raw`` are replaced, or, with ``replace_all``,
    the whole folder, so that no stale month survives.
    """
    mode = "static" if replace_all else "dynamic"
    # Rebalancing gathers a month's rows into few files and splits a very large month.
    (
        raw.hint("rebalance", F.col("source_month")).write.mode("overwrite").option("header", True).option("nullValue", "\\N")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("partitionOverwriteMode", mode).partitionBy("source_month").csv(folder)
    )


def read_months(spark: SparkSession, folder: str, kind: str, cfg: RetailConfig) -> DataFrame:
    """Partitions of the window; the filter on source_month prunes the others."""
    schema = StructType([*RAW_SCHEMAS[kind].fields, StructField("source_month", StringType())])
    return (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        .options(**MARKS).csv(folder)
        .filter(F.col("source_month").between(cfg.start_month, cfg.end_month))
    )


def check_schema(df: DataFrame, kind: str) -> DataFrame:
    """df unchanged, or an error naming both schemas."""
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema if f.name != "source_month"]
    expected = [(f.name, f.dataType.simpleString()) for f in RAW_SCHEMAS[kind]]
    if actual != expected:
        raise ValueError(f"Schema mismatch for {kind}.\nExpected: {expected}\nActual:   {actual}")
    return df


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """A dimension file as text: an id such as 00123 stays as it is (``shapes.detected`` finds types)."""
    return spark.read.option("header", True).csv(path)


def no_rows(spark: SparkSession, kind: str) -> DataFrame:
    """An empty table of the raw shape, for a source whose contract is broken."""
    schema = StructType([*RAW_SCHEMAS[kind].fields, StructField("source_month", StringType())])
    return spark.createDataFrame([], schema)
