"""Run registered queries against their SQL: ``python -m remitlens.verification.compare FOLDER [query ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

from remitlens.session import local_session
from remitlens.verification.catalog import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


def connect(folder: str):
    import duckdb

    db = duckdb.connect()
    for table in TABLES.split():
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return db


def _plain(value):
    return tuple(_plain(v) for v in value) if isinstance(value, list) else value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, result) -> str | None:
    """None when the Spark frame and the SQL result hold the same columns and rows, else what differs."""
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(names, result.fetchall())
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).items()), list((theirs - ours).items())
    return f"rows {ours.total()} and {theirs.total()}; only in Spark {extra[:2]}; only in SQL {missing[:2]}"


def main(folder: str, names: list[str]) -> int:
    spark, db, failures = local_session(8), connect(folder), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLE:
                problem = difference(df, db.execute(ORACLE[name]))
                note = "same" if problem is None else problem
            else:
                problem, note = None, f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # a failing query must not hide the others
            problem = note = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {name:28} {time.time() - start:6.1f}s {note}", flush=True)
    print(f"{failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
