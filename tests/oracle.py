"""Compare queries with their SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.date):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(df, con, sql):
    """Difference of a DataFrame and a SQL result; empty text when equal."""
    ours = df.collect()
    cur = con.execute(sql)
    names = [x[0] for x in cur.description]
    theirs = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, ours), rows_of(names, theirs)
    if a == b:
        return ""
    diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
    only_a, only_b = set(a) - set(b), set(b) - set(a)
    return f"rows {len(a)} vs {len(b)}; only ours {list(only_a)[:2]}; only sql {list(only_b)[:2]}; first {diff}"[:1800]


def main(sf_dir: str, names: list[str]) -> None:
    sys.path.insert(0, str(Path(__file__).parent.parent))
    from __spark_entry__ import oracle_sql, queries
    from foliograph.session import local_session

    spark, con = local_session("8"), connect(sf_dir)
    todo = {k: v for k, v in queries().items() if not names or k in names}
    bad = 0
    for name, fn in todo.items():
        t = time.time()
        try:
            sql = oracle_sql().get(name)
            df = fn(spark, sf_dir)
            said = compare(df, con, sql) if sql else f"no sql, {df.count()} rows"
        except Exception as e:
            said = f"ERROR {str(e)[:900]}"
        wrong = said and not said.startswith("no sql")
        bad += bool(wrong)
        print(f"{'BAD ' if wrong else 'ok  '}{name} {time.time() - t:.1f}s {said}", flush=True)
    print(f"{len(todo) - bad}/{len(todo)} good")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
