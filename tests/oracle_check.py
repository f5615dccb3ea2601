"""Runs registered queries on Spark and their SQL on DuckDB and compares schema and rows.

    python tests/oracle_check.py [folder] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences found; empty when schema and bag of rows agree."""
    con.execute(sql)
    described = [(c[0], str(c[1])) for c in con.description]
    want_rows = con.fetchall()
    have_types = {
        f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
        for f in spark_df.schema.fields
    }
    problems = []
    want_types = dict(described)
    if sorted(have_types) != sorted(want_types):
        return [f"columns {sorted(have_types)} against {sorted(want_types)}"]
    for name in have_types:
        if have_types[name].replace(" ", "") != want_types[name].replace(" ", ""):
            problems.append(f"type of {name}: {have_types[name]} against {want_types[name]}")
    names = sorted(have_types)
    order = [[c[0] for c in described].index(n) for n in names]
    want = Counter(tuple(_plain(r[i]) for i in order) for r in want_rows)
    have = Counter(tuple(_plain(r[n]) for n in names) for r in spark_df.collect())
    if have != want:
        extra, lacking = have - want, want - have
        problems.append(
            f"rows {sum(have.values())} against {sum(want.values())}; "
            f"only Spark {list(extra)[:2]}; only SQL {list(lacking)[:2]}"
        )
    elif not have:
        problems.append("no rows")
    return problems


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE_PARTITIONS", "8"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sqls = entry.oracle_sql()
    bad = 0
    for key, run in entry.queries().items():
        if only and key not in only:
            continue
        t = time.time()
        try:
            if key in sqls:
                problems = compare(run(spark, folder), con, sqls[key])
            else:
                n = run(spark, folder).count()
                problems = [] if n else ["no rows"]
        except Exception as e:
            problems = [f"{type(e).__name__}: {str(e)[-700:]}"]
        bad += bool(problems)
        tag = "ok  " if not problems else "BAD "
        print(f"{tag}{key} {time.time() - t:.1f}s{'' if key in sqls else ' (rows only)'}", flush=True)
        for p in problems:
            print("      ", p, flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
