"""Run registered queries against their SQL counterparts on the same tables.

    python tests/oracle_check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from contentloom.session import get_session  # noqa: E402


def canonical(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, Decimal)):
        return "NaN" if math.isnan(value) else f"{float(value):.9g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(canonical, value)) + "]"
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def kind(type_name: str) -> str:
    t = type_name.lower()
    for names, label in (
        (("bigint", "long", "hugeint"), "int64"), (("integer", "int"), "int32"),
        (("double", "float"), "double"), (("varchar", "string"), "string"),
        (("timestamp", "timestamp_ntz", "timestamp with time zone"), "timestamp"),
    ):
        if t in names:
            return label
    return t


def connect(sf_dir: str):
    con = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    df = queries()[name](spark, sf_dir)
    got = df.collect()
    took = time.time() - start
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"rows-only {len(got)} rows, spark {took:.1f}s"
    start = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: kind(str(d[1])) for d in result.description}
    want = result.fetchall()
    oracle_took = time.time() - start
    head = f"{len(got)}/{len(want)} rows, spark {took:.1f}s, oracle {oracle_took:.1f}s"
    if sorted(df.columns) != sorted(names):
        return False, f"{head}; columns {sorted(df.columns)} != {sorted(names)}"
    spark_types = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    differing = {c: (spark_types[c], types[c]) for c in names if spark_types[c] != types[c]}
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:2]
        only_b = [r for r in b if r not in set(a)][:2]
        return False, f"{head}; spark only {str(only_a)[:600]}; oracle only {str(only_b)[:600]}"
    if differing:
        return False, f"{head}; values equal, types differ {differing}"
    return True, head


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = get_session(
        f"local[{os.environ.get('CORES', '8')}]", **{"spark.sql.shuffle.partitions": os.environ.get("CORES", "8"), "spark.ui.enabled": "false",
                       "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = 0
    for name in args.names or queries():
        try:
            ok, note = compare(spark, con, name, args.sf)
        except Exception as e:  # report and go on with the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:900]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main())
