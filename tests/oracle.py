"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(value):
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "∅"
        return repr(round(value, 9) + 0.0)
    return f"{type(value).__name__[:3]}:{value}"


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    cursor = con.execute(sql)
    want_cols, want = normal([d[0] for d in cursor.description], cursor.fetchall())
    got_cols, got = normal(df.columns, [tuple(r) for r in df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} rows against {len(want)}; only spark {sorted(a)[:2]}; only sql {sorted(b)[:2]}"
    return None


def main(sf: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from arealoom.session import local_session

    spark = local_session()
    con, failed = connect(sf), []
    queries, oracles = entry.queries(), entry.oracle_sql()
    chosen = [q for q in queries if not names or any(q.startswith(n) for n in names)]
    for name in chosen:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracles:
                problem = differences(df, con, oracles[name])
                note = "ok" if problem is None else "DIFF " + problem[:900]
            else:
                problem, note = None, f"rows only: {len(df.collect())}"
        except Exception as error:
            problem = str(error)
            note = "ERROR " + traceback.format_exc()[-1200:] if "-v" in sys.argv else "ERROR " + str(error)[:700]
        if problem:
            failed.append(name)
        print(f"{name:34s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{len(chosen)} queries, {len(failed)} failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], [a for a in sys.argv[2:] if not a.startswith("-")]))
