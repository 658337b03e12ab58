"""Runs every query against its SQL: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple(map(_text, row)) for row in df.itertuples(index=False))


def _text(v) -> str:
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return "null"
    return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def differences(spark, con, name, query, sql, sf_dir) -> str | None:
    mine = query(spark, sf_dir).toPandas()
    if sql is None:
        return None if len(mine) else "no rows"
    theirs = con.sql(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} / {sorted(theirs.columns)}"
    a, b = canonical(mine), canonical(theirs)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}: {[x for x in a if x not in set(b)][:2]} / {[x for x in b if x not in set(a)][:2]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ: {bad[0]}"
    return None if len(a) else "no rows"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries
    from plazalens.session import configure

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    builder = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
    spark = configure(builder.config("spark.ui.showConsoleProgress", "false")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(sf), oracle_sql()
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            said = differences(spark, con, name, query, sqls.get(name), sf)
        except Exception as e:
            said = f"{type(e).__name__}: {str(e)[:600]}"
        verdict = ("ok" if sqls.get(name) else "rows only") if said is None else "DIFFERS " + said[:900]
        print(f"{name:28} {time.time() - start:6.2f}s {verdict}", flush=True)
    spark.stop()
