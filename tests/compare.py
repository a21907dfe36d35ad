"""Run registered queries and their SQL side by side and compare the rows."""

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return round(float(v), 6) + 0.0
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in data), key=repr)


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return rows([d[0] for d in cur.description], cur.fetchall())


def mismatch(df, con, sql):
    """None when equal, otherwise a description of the difference."""
    cur = con.execute(sql)
    names = sorted(d[0] for d in cur.description)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} != {names}"
    theirs = rows([d[0] for d in cur.description], cur.fetchall())
    ours = spark_rows(df)
    if ours == theirs:
        return None
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(bad)} of {len(ours)} rows differ, e.g. spark {bad[0][0]} sql {bad[0][1]}"


def main(argv):
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import __spark_entry__ as e

    from tests.conftest import session

    spark = session()
    sf = argv[0]
    con = connect(sf)
    sql, names = e.oracle_sql(), argv[1:]
    failed = 0
    for name, run in e.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = run(spark, sf)
            if name in sql:
                bad = mismatch(df, con, sql[name])
                state = "ok" if bad is None else "FAIL " + bad
            else:
                state = f"rows {df.count()}"
        except Exception as x:  # report and go on with the next query
            bad, state = True, "ERROR " + str(x)[:600]
        failed += state.startswith(("FAIL", "ERROR"))
        print(f"{name:28s} {time.time() - t:6.2f}s {state}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
