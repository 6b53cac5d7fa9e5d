"""Stored baselines: named values, accepted as numbered versions that later runs compare with.

A version is a small Parquet folder that is never changed; the committed marker lists the
versions in the order they were accepted, so a run that breaks off leaves the last one as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.store import StageStore

SCHEMA = "version int, note string, name string, value decimal(28,4)"
#: Version of the file format that ``read_file`` knows.
FILE_VERSION = 1


class Baselines:
    """The baselines under one folder, each with a label."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.store = spark, StageStore(spark, root)

    def _versions(self, label: str) -> list[str]:
        entry = self.store.entry(label)
        return entry["versions"] if entry else []

    def accept(self, label: str, values: DataFrame, note: str) -> int:
        """Store (name, value) as the next version and return its number; a reason must be given, a name stands once."""
        if not note.strip():
            raise ValueError("a baseline is accepted for a reason")
        held, folder = self._versions(label), uuid.uuid4().hex[:12]
        rows = values.select(
            F.lit(len(held) + 1).cast("int").alias("version"), F.lit(note).alias("note"), "name", F.col("value").cast("decimal(28,4)").alias("value")
        )
        path = f"{self.store.root}/{label}/{folder}"
        rows.coalesce(1).write.parquet(path)
        twice = self.spark.read.schema(SCHEMA).parquet(path).groupBy("name").count().filter("count > 1 OR name IS NULL").limit(1).collect()
        if twice:
            raise ValueError(f"baseline {label} names {twice[0]['name']} more than once, or without a name")
        self.store.commit(label, {"versions": [*held, folder]})
        return len(held) + 1

    def read(self, label: str, version: int | None = None) -> DataFrame:
        """(name, value) of a version, the last one by default."""
        held = self._versions(label)
        number = len(held) if version is None else version
        if not 1 <= number <= len(held):
            raise LookupError(f"baseline {label} has no version {number}")
        return self.spark.read.schema(SCHEMA).parquet(f"{self.store.root}/{label}/{held[number - 1]}").select("name", "value")

    def history(self, label: str) -> DataFrame:
        """(version, note, name, value) of all versions."""
        paths = [f"{self.store.root}/{label}/{folder}" for folder in self._versions(label)]
        return self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """(name, value) of a JSON file with the maps ``primitives`` and ``derived``; another file version is an error."""
    maps = "map<string,decimal(28,4)>"
    rows = spark.read.schema(f"schema_version int, primitives {maps}, derived {maps}").option("multiLine", True).json(path)
    known = F.when(F.col("schema_version") == FILE_VERSION, F.col("schema_version")).otherwise(
        F.raise_error(F.concat(F.lit("unknown baseline version "), F.coalesce(F.col("schema_version").cast("string"), F.lit("none")))).cast("int")
    )
    empty = F.create_map().cast(maps)
    both = F.map_concat(F.coalesce("primitives", empty), F.coalesce("derived", empty))
    return rows.select(F.explode(F.when(known.isNotNull(), both)).alias("name", "value"))
