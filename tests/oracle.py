"""A query's rows against its SQL's rows."""

import glob
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{files}'")
    return con


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(map(tuple, frame[columns].astype(str).values.tolist()))


def assert_same(query, sql, spark, folder):
    got, want = rows(query(spark, folder).toPandas()), rows(connect(folder).execute(sql).df())
    assert got[0] == want[0]
    assert got[1] == want[1]
