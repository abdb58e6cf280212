"""Compare a registered query with its SQL on the same parquet folder."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, bool):
        return v
    return v


def _kind(v):
    return "number" if isinstance(v, (int, float)) and not isinstance(v, bool) else type(v).__name__


def differences(spark, folder, fn, sql):
    """Empty text when both agree in columns, rows and values."""
    df = fn(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
        return "the plan pairs rows without a key"
    cols = sorted(df.columns)
    ours = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    cur = connect(folder).execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} and {sorted(names)}"
    pos = [names.index(c) for c in cols]
    theirs = [tuple(_norm(r[i]) for i in pos) for r in cur.fetchall()]
    if not ours:
        return "no rows"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)} rows; {ours[:2]} {theirs[:2]}"
    key = lambda r: tuple((v is None, str(type(v)) if isinstance(v, str) else "", str(v) if not isinstance(v, (int, float)) else "", v if isinstance(v, (int, float)) else 0) for v in r)
    ours.sort(key=key)
    theirs.sort(key=key)
    for a, b in zip(ours, theirs):
        if a != b or [_kind(x) for x in a] != [_kind(x) for x in b]:
            return f"{dict(zip(cols, a))} is not {dict(zip(cols, b))}"
    types = {c: t for c, t in df.dtypes}
    for c, v in zip(cols, ours[0]):
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            other = theirs[0][cols.index(c)]
            if isinstance(v, int) != isinstance(other, int):
                return f"{c} is {types[c]} here and {type(other).__name__} in SQL"
    return ""
