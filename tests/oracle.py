"""Compare queries with their SQL in DuckDB: python tests/oracle.py [folder] [name...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parents[1]))


def connection(folder: str):
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for p in Path(folder).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def _cell(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "as_tuple"):
        return float(v)
    if isinstance(v, (list, tuple)):
        return str([_cell(x) for x in v])
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder, query, sql) -> tuple[bool, str]:
    df = query(spark, folder)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = canonical(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return False, f"columns {df.columns} {rel.columns}"
    if got == want:
        return True, f"{len(got)} rows"
    a, b = [x for x in got if x not in want][:3], [x for x in want if x not in got][:3]
    return False, f"{len(got)} rows, not {len(want)}; only here {a}; only there {b}"


def main(folder="/root/testdata/sf0.01", *names):
    import __spark_entry__ as entry

    from bindery.runtime import session

    spark, con = session("8"), connection(folder)
    spark.sparkContext.setLogLevel("ERROR")
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            ok, said = compare(spark, con, folder, query, sqls[name]) if name in sqls else (True, f"{query(spark, folder).count()} rows, no SQL")
        except Exception as e:
            ok, said = False, repr(e)[:700]
        bad += not ok
        print("ok  " if ok else "FAIL", name, f"{time.time() - t:.1f}s", said, flush=True)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main(*sys.argv[1:])
