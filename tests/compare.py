"""Run every registered query beside its SQL in DuckDB and compare whole results."""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(f"{value:.9g}") + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def close(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12))
    return a == b


def difference(query, sql, spark, con, folder):
    """None when equal, else a short description."""
    df = query(spark, folder)
    got_columns, got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if not all(map(close, g, w))]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from lateralis.checks import all_oracles, all_queries
    from lateralis.session import local_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(all_queries())
    spark, con = local_session(8), connect(folder)
    spark.sparkContext.setLogLevel("ERROR")
    oracles = all_oracles()
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                verdict = difference(all_queries()[name], oracles[name], spark, con, folder) or "equal"
            else:
                verdict = f"{all_queries()[name](spark, folder).count()} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:36s} {time.time() - start:6.1f}s {verdict}", flush=True)
