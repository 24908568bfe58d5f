"""Registered queries against their DuckDB counterparts; DuckDB runs in a process of its own."""

import json
import math
import subprocess
import sys

import __spark_entry__
from talkweave.plans import oracles
from talkweave.plans import queries as plans

ORACLE = """
import sys, json, duckdb
con = duckdb.connect()
con.execute("SET enable_progress_bar = false")
for t in "documents embeddings pages benchmark labels conversations events".split():
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sys.argv[1]}/{t}.parquet'")
out = {}
for name, sql in json.load(sys.stdin).items():
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    out[name] = (names, [[str(v) if v is not None and not isinstance(v, (int, float, bool, str)) else v for v in r] for r in cur.fetchall()])
json.dump(out, sys.stdout)
"""


def rows_of(names, rows):
    """Rows with columns by name, floats to six places, in a fixed order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: round(v, 5) + 0.0 if isinstance(v, float) and not math.isnan(v) else v
    return sorted(([plain(r[i]) for i in order] for r in rows), key=str)


def compare(spark, sf, found, sql):
    out = subprocess.run([sys.executable, "-c", ORACLE, sf], input=json.dumps(sql), capture_output=True, text=True, check=True).stdout
    for name, (names, rows) in json.loads(out).items():
        df = found[name](spark, sf)
        assert sorted(df.columns) == sorted(names), name
        assert rows_of(df.columns, [list(r) for r in df.collect()]) == rows_of(names, rows), name


def test_queries_match_sql(spark, sf):
    compare(spark, sf, plans.QUERIES, oracles.ORACLES)


def test_the_others_run(spark, sf):
    for name in plans.QUERIES.keys() - oracles.ORACLES.keys():
        assert plans.QUERIES[name](spark, sf).count() > 0, name


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
