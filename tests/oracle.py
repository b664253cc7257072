"""Run registered queries beside their SQL: `python tests/oracle.py [sf] [name ...]`."""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def cell(x):
        # Text of a float tells -0.0 from 0.0 and makes NaN equal to itself.
        return repr(x) if isinstance(x, float) else x
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql):
    """Empty when the results agree; otherwise a short account."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    want = canonical(names, found.fetchall())
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} differ, first {str(bad[0])[:600]}" if bad else ""


def main():
    from corpusprep import build_session
    from corpusprep.queries import ORACLES, QUERIES
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, failed = connect(sf_dir), []
    for name in wanted:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            note = differences(df, con, ORACLES[name]) if name in ORACLES else \
                f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            note = f"ERROR {str(error)[:700]}"
        failed += [name] if note and not note.startswith("rows only") else []
        print(f"{name:28s} {time.time() - start:6.1f}s  {note or 'ok'}", flush=True)
    print(f"{len(wanted) - len(failed)} of {len(wanted)} agree", failed)


if __name__ == "__main__":
    main()
