"""Side-by-side comparison of every registered query with its SQL twin.

    python tests/compare.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(value):
    if value is None:
        return ("", "")
    if isinstance(value, float):
        return ("n", "nan") if math.isnan(value) else ("n", value + 0.0)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("n", float(value))
    return ("s", str(value))


def rows_of(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_key(r[i]) for i in at) for r in rows], key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when columns and all values agree exactly."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    theirs = rows_of(names, cursor.fetchall())
    ours = rows_of(spark_df.columns, spark_df.collect())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if not bad:
        return None
    cells = [(c, x[1], y[1]) for a, b in bad[:3] for c, x, y in zip(sorted(names), a, b) if x != y]
    return f"{len(bad)} rows differ, e.g. {cells[:6]}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    session = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    con, sqls = duck(folder), entry.oracle_sql()
    good = 0
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        if name not in sqls:
            print(f"NOSQL {name} {query(session, folder).count()} rows", flush=True)
            continue
        try:
            found = difference(query(session, folder), con, sqls[name])
        except Exception as e:  # noqa: BLE001
            found = f"error {str(e)[:400]}"
        good += found is None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{good} agree")
