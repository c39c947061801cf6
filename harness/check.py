"""Compare registered queries with their DuckDB counterparts.

python -m harness.check SF_DIR [QUERY ...]"""

from __future__ import annotations

import datetime
import glob
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession


TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def session(cores: str = "8") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("ratings_engine")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", os.environ.get("CHECK_MEMORY", "8g"))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def compare(spark, connection, function, sql: str, sf_dir: str) -> str:
    """'' when names, types and rows agree, else what differs."""
    frame = function(spark, sf_dir)
    names = sorted(frame.columns)
    got = Counter(tuple(_plain(v) for v in row) for row in frame.select(*names).collect())
    result = connection.sql(sql)
    found = [d[0] for d in result.description]
    if sorted(found) != names:
        return f"columns {names} against {sorted(found)}"
    order = [found.index(n) for n in names]
    want = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    if got == want:
        kinds = dict(frame.dtypes)
        odd = [(d[0], kinds[d[0]], str(d[1])) for d in result.description
               if TYPES.get(kinds[d[0]]) != str(d[1])]
        return f"types differ: {odd}" if odd else ""
    return (f"{got.total()} rows against {want.total()}; only Spark {list((got - want).items())[:2]}, "
            f"only DuckDB {list((want - got).items())[:2]}")


def main(sf_dir: str, *wanted: str) -> int:
    from harness.oracles import ORACLES
    from harness.queries import QUERIES
    spark, connection, bad = session(), duck(sf_dir), 0
    for name in wanted or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, connection, QUERIES[name], ORACLES[name], sf_dir)
            else:
                problem = "" if QUERIES[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} of {len(wanted or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
