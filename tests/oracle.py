"""Compare queries with their SQL in DuckDB: python tests/oracle.py [folder] [name ...]"""

import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def compare(spark, con, folder, function, sql):
    """None if equal, else a description of the difference."""
    frame = function(spark, folder)
    columns = sorted(frame.columns)
    got = sorted((tuple(normal(v) for v in r) for r in frame.select(*columns).collect()), key=repr)
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    places = [names.index(c) for c in columns]
    want = sorted((tuple(normal(r[p]) for p in places) for r in result.fetchall()), key=repr)
    if got == want:
        return None if got else "both empty"
    diff = [(g, w) for g, w in zip(got, want) if g != w][:3]
    return f"{len(got)} rows, expected {len(want)}; {columns}; {diff}"


if __name__ == "__main__":
    from paperfield.catalog import ORACLES, QUERIES
    from paperfield.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="paperfield-oracle-"),
    })
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, folder, QUERIES[name], ORACLES.get(name))
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:6000]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    sys.exit(bool(failed))
