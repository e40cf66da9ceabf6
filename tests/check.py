"""Run every registered query and its SQL side by side: python tests/check.py [name ...]."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str = FOLDER):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if hasattr(value, "asDict"):
        return _plain(value.asDict())
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def _sorted(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_plain(r[i]) for i in at) for r in rows]
    return [columns[i] for i in at], sorted(shaped, key=repr)


def compare(spark, con, run, sql, folder: str = FOLDER) -> str | None:
    """None when equal, else the first difference."""
    df = run(spark, folder)
    got_cols, got = _sorted(df.columns, df.collect())
    rel = con.sql(sql)
    want_cols, want = _sorted(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} / {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} / {b}"
    return "EMPTY" if not got else None


def main(names):
    from hydrolens import catalog
    from hydrolens.session import get_session

    if os.environ.get("CHECK_PLAIN"):  # a session without any of our settings
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = get_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(), catalog.oracle(), 0
    for name, run in catalog.queries().items():
        if names and not any(name == n or name.startswith(n.rstrip("*")) and n.endswith("*") for n in names):
            continue
        begin = time.time()
        try:
            if name in sqls:
                diff = compare(spark, con, run, sqls[name])
            else:
                diff = f"NO SQL, {run(spark, FOLDER).count()} rows"
        except Exception as error:  # report and go on
            diff = "ERROR " + str(error)[:1500]
            if names:
                traceback.print_exc()
        if diff:
            bad += 1
        print(f"{time.time() - begin:6.2f}s {name}: {diff or 'ok'}", flush=True)
    print(f"{bad} to look at")


if __name__ == "__main__":
    main(sys.argv[1:])
