"""Run every query beside its SQL and report differences.

    python -m checks.compare [directory] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.registry import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPE_NAMES = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar",
              "boolean": "boolean"}


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(r[i]) for i in order) for r in rows]
    return sorted(
        out, key=lambda t: tuple((v is None, str(type(v)), 0 if v is None else v) for v in t)
    )


def oracle_connection(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{directory}/{t}.parquet'")
    return con


def compare(spark: SparkSession, con, name: str, directory: str) -> tuple[bool, str]:
    df = REGISTRY[name](spark, directory)
    got = rows_of(df.columns, df.collect())
    if name not in ORACLE:
        return True, f"{len(got)} rows, no SQL"
    found = con.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    want = rows_of(columns, found.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} but SQL has {sorted(columns)}"
    if got == want:
        kinds = {c[0]: str(c[1]).lower() for c in found.description}
        other = [
            f"{f.name} {f.dataType.simpleString()}/{kinds[f.name]}"
            for f in df.schema.fields
            if TYPE_NAMES.get(f.dataType.simpleString()) != kinds[f.name]
        ]
        return True, f"{len(got)} rows" + (f", types differ: {other}" if other else "")
    diff = [(g, w) for g, w in zip(got, want) if g != w][:2]
    return False, f"{len(got)} rows against {len(want)}; first differences {diff}"


def main(directory: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(directory)
    failed = []
    for name in names or REGISTRY:
        start = time.time()
        try:
            ok, note = compare(spark, con, name, directory)
        except Exception as e:  # report it and go on with the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        if not ok:
            failed.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.2f}s {note}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
