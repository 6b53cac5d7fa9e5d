"""Month shards of different shapes: what each file holds, and one table from all of them.

Files of one kind may differ in their columns. A first job looks at the first block of every
file and keeps the header lines alone, a row per file. Files with the same header are read by
one scan, whatever their number; columns are aligned by name. A second job, one scan per
header, classifies every filled value and counts the classes per shard and column, which
gives the physical type of text files.

The driver holds the names of the files, as for any scan, and the distinct headers.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.config import RetailConfig
from tallyloom.functions.text import trimmed
from tallyloom.sources.shards import MARKS, RAW_SCHEMAS, no_rows, shard_glob

INVENTORY = "table_name string, column_name string, data_type string, ordinal_position int"
MOST_SHAPES = 100  # headers of one kind; more are an error in the folder, not a shape
LEAST_FILLED = 10  # values that a shard must hold in a column before they say anything of its type

# How the text of each type looks. A number with a leading zero is a key, so text.
TYPE_PATTERNS = (
    ("bigint", r"^[+-]?(0|[1-9]\d{0,17})$"),
    ("decimal", r"^[+-]?((0|[1-9]\d*)(\.\d+)?|\.\d+)$"),
    ("date", r"^\d{4}-\d{1,2}-\d{1,2}$"),
)


@dataclass(frozen=True)
class Shape:
    """One header and the files that have it, each with its month."""

    columns: tuple[str, ...]
    files: tuple[str, ...]
    months: tuple[str, ...]


def _month_of(path: Column) -> Column:
    """The month in a partition's name, or before the ending of a file's; positions only, since every row asks."""
    at = F.instr(path, "source_month=")
    return F.when(at > 0, F.substring(path, at + 13, F.lit(6))).otherwise(F.substring(path, F.length(path) - 9, F.lit(6)))


def _glob(kind: str) -> str:
    """Month files of a kind, or the files of a folder with a partition per month."""
    return f"{{{shard_glob(kind)},part-*.csv}}"


def _files(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Every file's path and month, from the listing; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", _glob(kind)).load(folder)
    return found.select("path", _month_of(F.col("path")).alias("month"))


def header_lines(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """(path, header) of every file whose first line names one of the kind's columns.

    Only a file's first block is looked at, and only lines that hold a name pass on to the
    aggregation, so what is grouped is about a line per file.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", _glob(kind)).text(folder)
        .filter("_metadata.file_block_start = 0")
        .select("value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"))
    )
    names = RAW_SCHEMAS[kind].fieldNames()
    anywhere = reduce(lambda a, b: a | b, [F.col("value").contains(n) for n in names])  # far cheaper than the pattern, and nearly always false
    titles = lines.filter(anywhere & F.col("value").rlike(rf'(^|[,"\x{{FEFF}}])({"|".join(names)})("|,|\r|$)'))
    return titles.groupBy("path").agg(F.min_by("value", "at").alias("header"))


def shapes(spark: SparkSession, folder: str, kind: str, cfg: RetailConfig) -> list[Shape]:
    """The headers of a kind's shards in the month window; a file without a known column has an empty one."""
    listed = _files(spark, folder, kind).filter(F.col("month").between(cfg.start_month, cfg.end_month))
    # the two readers write one path with and without an empty authority
    bare = lambda c: F.regexp_replace(c, r"^file:/+", "/")
    headed = header_lines(spark, folder, kind).select(bare(F.col("path")).alias("bare"), "header")
    rows = listed.withColumn("bare", bare(F.col("path"))).join(headed, "bare", "left").select("path", "month", "header").collect()
    held: dict[tuple[str, ...], list[tuple[str, str]]] = {}
    for r in rows:
        line = (r["header"] or "").lstrip("﻿").rstrip("\r")
        held.setdefault(tuple(next(csv.reader([line]), [])), []).append((r["path"], r["month"]))
    if len(held) > MOST_SHAPES:
        raise ValueError(f"{len(held)} different headers among the {kind} shards of {folder}")
    return [Shape(columns, *map(tuple, zip(*sorted(files)))) for columns, files in sorted(held.items())]


def _scan(spark: SparkSession, shape: Shape) -> DataFrame:
    """All files of one shape, as text, with their month."""
    fields = ", ".join(f"`{c}` string" for c in shape.columns)
    rows = spark.read.schema(fields).option("header", True).options(**MARKS).csv(list(shape.files))
    return rows.withColumn("source_month", _month_of(F.col("_metadata.file_path")))


def read_shapes(spark: SparkSession, found: list[Shape], kind: str) -> DataFrame:
    """One table of the kind's columns: aligned by name, NULL where a shard lacks one, extra ones left out."""
    wanted = RAW_SCHEMAS[kind].fieldNames()
    parts = [
        _scan(spark, shape).select(*[F.col(f"`{c}`") if c in shape.columns else F.lit(None).cast("string").alias(c) for c in wanted], "source_month")
        for shape in found if shape.columns
    ]
    return reduce(DataFrame.unionByName, parts) if parts else no_rows(spark, kind)


def value_class(text: Column) -> Column:
    """Place of the first type in ``TYPE_PATTERNS`` that a trimmed text looks like; NULL for a blank, -1 for other text.

    Patterns, not casts: a cast that fails costs far more than a pattern that doesn't match.
    """
    kind = F.lit(-1)
    for at, (_, pattern) in reversed(list(enumerate(TYPE_PATTERNS))):
        kind = F.when(text.rlike(pattern), at).otherwise(kind)
    return F.when(F.coalesce(text, F.lit("")) != "", kind)


def _type(filled: Column, whole: Column, number: Column, day: Column, least: int) -> Column:
    """The type that most filled values have; whole numbers are numbers too."""
    return (
        F.when(F.coalesce(filled, F.lit(0)) < least, F.lit(None).cast("string")).when(2 * whole > filled, "bigint")
        .when(2 * (whole + number) > filled, "decimal").when(2 * day > filled, "date").otherwise("string")
    )


def _counted(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Per month and column, the number of filled values by class; values are counted before they are shuffled."""
    texts = F.array(*[trimmed(F.col(f"`{c}`")) for c in columns])
    each = rows.select("source_month", F.posexplode(texts).alias("at", "text")).select("source_month", "at", value_class(F.col("text")).alias("class"))
    counts = each.groupBy("source_month", "at", "class").agg(F.count("class").alias("n"))
    return counts.groupBy("source_month", "at").agg(
        F.sum("n").alias("filled"), *[F.sum(F.when(F.col("class") == k, F.col("n")).otherwise(0)).alias(name) for k, (name, _) in enumerate(TYPE_PATTERNS)],
    ).select(
        "source_month", F.element_at(F.array(*map(F.lit, columns)), F.col("at") + 1).alias("column_name"),
        (F.col("at") + 1).alias("ordinal_position"), "filled", *[name for name, _ in TYPE_PATTERNS],
    )


def inventory(spark: SparkSession, found: list[Shape], kind: str, least: int = LEAST_FILLED) -> DataFrame:
    """(table, column, type, position): what the shards hold, a table per month.

    A month whose files differ has the columns that all of them have. The type is what most
    filled values look like, NULL below ``least`` of them. A month whose files name no known
    column is listed with a NULL column.
    """
    held = [(m, c) for shape in found for m in sorted(set(shape.months)) for c in shape.columns]
    months = spark.createDataFrame([(m,) for shape in found for m in sorted(set(shape.months))], "source_month string")
    shared = spark.createDataFrame(held, "source_month string, column_name string").groupBy("source_month", "column_name").agg(F.count("*").alias("have"))
    whole = months.groupBy("source_month").agg(F.count("*").alias("shapes")).join(
        shared.withColumnRenamed("source_month", "m"), (F.col("source_month") == F.col("m")) & (F.col("have") == F.col("shapes")), "left"
    ).select("source_month", "column_name")
    parts = [_counted(_scan(spark, shape), shape.columns) for shape in found if shape.columns]
    if not parts:
        return whole.select(F.concat(F.lit(kind), "source_month").alias("table_name"), "column_name", F.lit(None).cast("string").alias("data_type"), F.lit(None).cast("int").alias("ordinal_position"))
    sums = reduce(DataFrame.unionByName, parts).groupBy("source_month", "column_name").agg(
        F.min("ordinal_position").alias("ordinal_position"), *[F.sum(c).alias(c) for c in ("filled", *(n for n, _ in TYPE_PATTERNS))],
    )
    return whole.join(sums, ["source_month", "column_name"], "left").select(
        F.concat(F.lit(kind), "source_month").alias("table_name"), "column_name",
        _type(F.col("filled"), F.col("bigint"), F.col("decimal"), F.col("date"), least).alias("data_type"), "ordinal_position",
    )


def detected(table: DataFrame) -> DataFrame:
    """A text table with typed columns: a column takes a type when all its filled values have it."""
    classes = table.select(*[value_class(trimmed(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(table.columns)])
    seen = classes.agg(*[F.collect_set(f"k{i}").alias(f"k{i}") for i in range(len(table.columns))]).first()  # at most four values a column

    def typed(c: str, kinds: set[int]) -> Column:
        text = trimmed(F.col(f"`{c}`"))
        if kinds and kinds <= {0}:
            return text.try_cast("bigint").alias(c)
        if kinds and kinds <= {0, 1}:
            return text.try_cast("double").alias(c)
        if kinds == {2}:
            return text.try_cast("date").alias(c)
        return F.col(f"`{c}`")

    return table.select(*[typed(c, set(seen[i])) for i, c in enumerate(table.columns)])
