"""Run queries against their SQL: ``python tools/check.py [sf] [name ...]``."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (int(v) if v == int(v) and abs(v) < 1e15 else v)
    if isinstance(v, bool):
        return v
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def ordered(columns, rows):
    pos = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in pos) for r in rows]
    return [columns[i] for i in pos], sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


KINDS = {"bigint": "int", "int": "int", "smallint": "int", "tinyint": "int", "double": "double", "string": "str",
         "timestamp_ntz": "ts", "timestamp": "ts_tz", "boolean": "bool", "date": "date"}
DUCK_KINDS = {"BIGINT": "int", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "str", "TIMESTAMP": "ts",
              "TIMESTAMP WITH TIME ZONE": "ts_tz", "BOOLEAN": "bool", "DATE": "date", "HUGEINT": "HUGEINT"}


def compare(df, con, sql):
    """None when equal, else what differs."""
    kinds = {c: KINDS.get(t, t) for c, t in df.dtypes}
    mine_cols, mine = ordered(df.columns, df.collect())
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    theirs_kinds = {d[0]: DUCK_KINDS.get(str(d[1]), str(d[1])) for d in cur.description}
    their_cols, theirs = ordered(cols, cur.fetchall())
    if mine_cols != their_cols:
        return f"columns {mine_cols} != {their_cols}"
    if kinds != theirs_kinds:
        return "types " + str({c: (kinds[c], theirs_kinds[c]) for c in kinds if kinds[c] != theirs_kinds[c]})
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, e.g. {mine_cols}: {bad[0][0]} != {bad[0][1]}"
    if not mine:
        return "EMPTY on both sides"
    return None


def main() -> int:
    from pulsegrid.session import local_session
    from pulsegrid.suite import load

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    queries, sql = load()
    names = sys.argv[2:] or list(queries)
    spark = local_session()
    spark.sparkContext.setLogLevel("OFF")
    con, failed = duck(sf_dir), 0
    for name in names:
        t = time.time()
        try:
            df = queries[name](spark, sf_dir)
            note = compare(df, con, sql[name]) if name in sql else f"rows only: {df.count()}"
        except Exception as e:
            note = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        ok = note is None or note.startswith("rows only")
        failed += not ok
        print(f"{'ok ' if ok else 'BAD'} {time.time() - t:6.2f}s {name} {note or ''}", flush=True)
    print(f"{len(names)} checked, {failed} bad")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
