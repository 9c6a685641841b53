"""Run a registered query and its SQL side by side, as the driver does."""

import importlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, canon(x)) for k, x in v.items())
    if hasattr(v, "asDict"):
        return tuple((k, canon(x)) for k, x in v.asDict().items())
    if v.__class__.__name__ == "Decimal":
        return canon(float(v))
    return str(v) if v is not None else None


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canon(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, name, sf_dir):
    """(number of rows, first differences): none if the two agree."""
    entry = importlib.import_module("__spark_entry__")
    df = entry.queries()[name](spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return len(mine), [("columns", df.columns, columns)]
    theirs = rows_of(columns, cur.fetchall())
    if mine == theirs:
        return len(mine), []
    return len(mine), [("rows", len(mine), len(theirs)), *[(a, b) for a, b in zip(mine, theirs) if a != b][:3]]


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[6]").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    entry = importlib.import_module("__spark_entry__")
    sf = os.environ.get("SF", "/root/testdata/sf0.01")
    names = [n for n in entry.queries() if not sys.argv[1:] or any(n.startswith(a) for a in sys.argv[1:])]
    bad = 0
    for name in names:
        t = time.time()
        try:
            if name in entry.oracle_sql():
                n, diff = compare(spark, name, sf)
            else:
                n, diff = entry.queries()[name](spark, sf).count(), []
                diff = [] if n else ["no rows"]
        except Exception as e:  # the report goes on with the next query
            n, diff = -1, [str(e)[:1500]]
        bad += bool(diff)
        print("BAD" if diff else "ok ", name, n, f"{time.time() - t:.1f}s", diff if diff else "", flush=True)
    print("bad:", bad)
