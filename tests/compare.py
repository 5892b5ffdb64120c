"""Run registered queries against their reference SQL in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gaugework.sources.tables import DRIVER_TABLES  # noqa: E402


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def kind(type_name: str) -> str:
    s = str(type_name).lower()
    for a, b in (("bigint", "int"), ("hugeint", "huge"), ("smallint", "int"), ("integer", "int"), ("varchar", "string"), ("timestamp_ntz", "timestamp"), ("boolean", "bool")):
        s = s.replace(a, b)
    if s.startswith('array<'):
        s = s[6:-1] + '[]'
    return s.split("(")[0]


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for n in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{folder}/{n}.parquet')")
    return con


def differences(df, con, sql) -> list[str]:
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    got_types = dict(df.dtypes)
    problems = []
    if sorted(want_types) != sorted(got_types):
        return [f"columns {sorted(got_types)} want {sorted(want_types)}"]
    if len(rel.columns) != len(df.columns):
        return ["repeated column names"]
    for c in got_types:
        if kind(got_types[c]) != kind(want_types[c]):
            problems.append(f"type of {c}: {got_types[c]} want {want_types[c]}")
    order = sorted(got_types)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    at = [rel.columns.index(c) for c in order]
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    if len(got) != len(want):
        problems.append(f"{len(got)} rows want {len(want)}")
    elif got != want:
        bad = [(a, b) for a, b in zip(got, want) if a != b]
        problems.append(f"{len(bad)} of {len(got)} rows differ over {order}, e.g. {bad[:2]}")
    return problems


def main(folder: str, prefixes: list[str]) -> int:
    from gaugework.queries import ORACLES, QUERIES
    from gaugework.session import local_session

    spark, con, bad = local_session(8), connect(folder), 0
    for name, run in QUERIES.items():
        if prefixes and not name.startswith(tuple(prefixes)):
            continue
        t = time.time()
        try:
            df = run(spark, folder)
            if name in ORACLES:
                problems = differences(df, con, ORACLES[name])
                n = ""
            else:
                problems, n = [], f" rows={len(df.collect())} (no SQL)"
        except Exception as e:  # noqa: BLE001
            problems, n = [f"{type(e).__name__}: {str(e)[:1200]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - t:.1f}s{n}", *problems, sep="\n     " if problems else "", flush=True)
    print(f"{bad} failed of {len(QUERIES)} registered", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
