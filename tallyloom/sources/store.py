"""Stages that outlive an application: versions written aside, committed by a marker.

A stage is a folder of versions under the store's root. Its marker, a small JSON file, names
the version that counts and the key it was made from: settings, and the identities of the
stages it reads. A new version is written first and committed by renaming a marker into
place, so a run that breaks off leaves the last committed state as it was, and the next run
goes on from there. Stages kept by month list a version for each month: only months whose key
changed are written again, the others stay as they lie there.

Markers are numbered; the highest one counts. ``purge`` deletes what no marker names.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.sources.staging import bucketed_scans, inputs

#: Part of every key: raised when a stage's rules change, so that older versions are not used.
RULES = 2
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name for a NULL partition


def key_of(*parts: object) -> str:
    return hashlib.sha256(json.dumps([RULES, *parts], default=str, sort_keys=True).encode()).hexdigest()[:24]


def content_marks(df: DataFrame, by: str | None = None) -> dict[str, str]:
    """A key per month (or one, under "") that changes with the rows; one scan, a count and a sum of hashes each."""
    month = F.lit("") if by is None else F.coalesce(F.col(by), F.lit(NO_MONTH))
    # nulls leave a hash as it is, so the places of the filled cells are part of the mark
    filled = sum((F.col(f"`{c}`").isNotNull().cast("bigint") * (i + 1) for i, c in enumerate(df.columns)), F.lit(0))
    marks = df.select(month.alias("m"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)").alias("h"), filled.alias("f"))
    sums = marks.groupBy("m").agg(F.count("*").alias("n"), F.sum("h").alias("h"), F.sum("f").alias("f"))
    return {r["m"]: key_of(r["n"], str(r["h"]), r["f"]) for r in sums.collect()}


class StageStore:
    """A folder of committed stages that every session with the same root shares."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        path = self._path(*parts)
        return sorted(s.getPath().getName() for s in self._fs().listStatus(path)) if self._fs().exists(path) else []

    def _markers(self, label: str) -> list[str]:
        return [n for n in self._names("_markers") if n.startswith(f"{label}.") and n.endswith(".json")]

    def entry(self, label: str) -> dict | None:
        """What is committed of a stage."""
        names = self._markers(label)
        if not names:
            return None
        path = self._path("_markers", names[-1]).toString()
        return json.loads("".join(r[0] for r in self.spark.read.option("wholetext", True).text(path).collect()))

    def commit(self, label: str, entry: dict) -> None:
        """Make an entry the one that counts; fails if another run committed meanwhile."""
        last = self._markers(label)
        number = int(last[-1].split(".")[-2]) + 1 if last else 1
        draft = self._path("_markers", f"_{label}-{uuid.uuid4().hex}.draft")
        out = self._fs().create(draft)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        if not self._fs().rename(draft, self._path("_markers", f"{label}.{number:09d}.json")):
            raise RuntimeError(f"another run committed {label}")

    # --- whole stages ---

    def whole(self, label: str, key: str, build: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
        """The committed table of this key, or a new version of it; and its identity."""
        entry = self.entry(label)
        if entry is None or entry["key"] != key:
            version = uuid.uuid4().hex[:12]
            df = build()
            df.write.parquet(f"{self.root}/{label}/{version}")
            entry = {"key": key, "version": version, "schema": df.schema.json()}
            self.commit(label, entry)
        schema = StructType.fromJson(json.loads(entry["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.root}/{label}/{entry['version']}"), entry["version"]

    def bucketed(self, label: str, key: str, build: Callable[[], DataFrame], column: str, buckets: int) -> tuple[DataFrame, str, str]:
        """As ``whole``, laid out by a join key; the third value is the name of the session's table."""
        entry = self.entry(label)
        if entry is None or entry["key"] != key:
            version = uuid.uuid4().hex[:12]
            df = build()
            name = f"tallyloom_{label}_{version}"
            with bucketed_scans(self.spark):
                (
                    df.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column)
                    .option("path", f"{self.root}/{label}/{version}").format("parquet").saveAsTable(name)
                )
            entry = {"key": key, "version": version, "columns": [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema], "buckets": buckets}
            self.commit(label, entry)
        name = f"tallyloom_{label}_{entry['version']}"
        if not self.spark.catalog.tableExists(name):  # another session wrote it
            self.spark.sql(
                f"CREATE TABLE {name} ({', '.join(entry['columns'])}) USING parquet CLUSTERED BY ({column}) SORTED BY ({column}) "
                f"INTO {entry['buckets']} BUCKETS LOCATION '{self.root}/{label}/{entry['version']}'"
            )
        return self.spark.table(name), entry["version"], name

    # --- stages by month ---

    def months(self, label: str, keys: dict[str, str], build: Callable[[], DataFrame], by: str = "source_month", files: str = "") -> tuple[DataFrame, dict[str, str]]:
        """A table whose months are versions of their own; only months with a new key are built.

        ``files`` is noted beside the keys, see ``same_files``.
        """
        entry = self.entry(label) or {"months": {}}
        old = entry["months"]
        changed = [m for m, key in keys.items() if m not in old or old[m][0] != key]
        if changed or set(old) - set(keys) or entry.get("files") != files:
            version, df = uuid.uuid4().hex[:12], build()
            where = F.coalesce(F.col(by), F.lit(NO_MONTH))
            if changed:
                rows = df.filter(where.isin(changed)).hint("rebalance", F.col(by)).withColumn("version", F.lit(version))
                rows.write.mode("append").partitionBy(by, "version").parquet(f"{self.root}/{label}")
            there = {m: version if self._fs().exists(self._path(label, f"{by}={m}", f"version={version}")) else "" for m in changed}
            held = {m: [key, there[m] if m in there else old[m][1]] for m, key in keys.items()}
            entry = {"months": held, "files": files, "schema": df.schema.json()}
            self.commit(label, entry)
        schema = StructType.fromJson(json.loads(entry["schema"]))
        paths = [f"{self.root}/{label}/{by}={m}/version={v}" for m, (_, v) in sorted(entry["months"].items()) if v]
        read = self.spark.read.schema(StructType(schema.fields).add("version", "string"))
        table = read.option("basePath", f"{self.root}/{label}").parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return table.select(*schema.fieldNames()), {m: v for m, (_, v) in entry["months"].items()}

    def raw_months(self, label: str, raw: DataFrame, by: str = "source_month") -> tuple[DataFrame, dict[str, str]]:
        """``months`` of a source: its files are looked at first, its rows only if a file differs."""
        plan = raw._jdf.queryExecution().analyzed().canonicalized().toString()
        state = key_of(raw.schema.json(), plan, inputs(raw))
        entry = self.entry(label)
        if entry and raw.inputFiles() and entry.get("files") == state:
            return self.months(label, {m: key for m, (key, _) in entry["months"].items()}, lambda: raw, by, state)
        return self.months(label, content_marks(raw, by), lambda: raw, by, state)

    def purge(self) -> None:
        """Delete versions and markers that no longer count. Not while another run reads or writes here."""
        fs = self._fs()
        for name in self._names("_markers"):
            label = name.split(".")[0]
            if name.endswith(".draft") or name != self._markers(label)[-1]:
                fs.delete(self._path("_markers", name), False)
        for label in (n for n in self._names() if n != "_markers"):
            entry = self.entry(label) or {"months": {}}
            for name in self._names(label):
                if "months" not in entry:
                    if name != entry["version"]:
                        fs.delete(self._path(label, name), True)
                elif name.startswith("_"):
                    continue
                else:
                    keep = entry["months"].get(name.split("=", 1)[-1], ["", ""])[1]
                    for version in self._names(label, name):
                        if version != f"version={keep}":
                            fs.delete(self._path(label, name, version), True)
