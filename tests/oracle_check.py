"""Compare every registered query with its SQL on the given tables.

Used by the test suite, and by hand: ``python -m tests.oracle_check [sf_dir] [query ...]``.
"""

from __future__ import annotations

import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, float):
        return repr(round(value, 9))
    return str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, sf_dir, run, sql):
    """Return (row count, problem or None)."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want_types = {d[0]: str(d[1]) for d in result.description}
    want = _sorted_rows(want_columns, result.fetchall())
    df = run(spark, sf_dir)
    if sorted(df.columns) != sorted(want_columns):
        return 0, f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    types = {name: SQL_TYPES.get(kind, kind) for name, kind in df.dtypes}
    if types != want_types:
        return 0, f"types differ: {[(n, types[n], want_types[n]) for n in types if types[n] != want_types[n]]}"
    got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(want):
        return len(got), f"{len(got)} rows != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return len(got), f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from barloom.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if len(argv) > 1 and name not in argv[1:]:
            continue
        started = time.time()
        try:
            if name in sql:
                rows, problem = compare(spark, con, sf_dir, run, sql[name])
            else:
                rows, problem = run(spark, sf_dir).count(), None
        except Exception as error:  # report and go on with the next query
            rows, problem = 0, str(error)[:600]
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={rows} {time.time() - started:.2f}s {problem or ''}")
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
