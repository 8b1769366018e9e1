"""Side-by-side comparison of a registered query with its oracle SQL."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value + 0.0))
    return (1, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, name, query, sql, sf_dir):
    """Return a list of differences; empty when both sides agree."""
    t0 = time.time()
    frame = query(spark, sf_dir)
    got = frame.collect()
    t1 = time.time()
    cursor = con.execute(sql)
    want = cursor.fetchall()
    t2 = time.time()
    notes = []
    types = {d[0]: str(d[1]) for d in cursor.description}
    for field in frame.schema.fields:
        kind = KINDS.get(field.dataType.simpleString(), field.dataType.simpleString())
        if types.get(field.name) != kind:
            notes.append(f"type of {field.name}: spark {kind}, oracle {types.get(field.name)}")
    if sorted(types) != sorted(frame.columns):
        notes.append(f"columns {sorted(frame.columns)} vs {sorted(types)}")
        return notes, len(got), t1 - t0, t2 - t1
    if len(got) != len(want):
        notes.append(f"rows {len(got)} vs {len(want)}")
    left, right = _rows(frame.columns, got), _rows(list(types), want)
    if left != right:
        odd = [(a, b) for a, b in zip(left, right) if a != b][:2]
        notes.append(f"values differ, e.g. {str(odd)[:1500]}")
    return notes, len(got), t1 - t0, t2 - t1


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from quaestor import build_session
    sf_dir = argv[0]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        try:
            if name in oracles:
                notes, n, ts, td = compare(spark, con, name, query, oracles[name], sf_dir)
            else:
                t0 = time.time()
                n, notes, td = len(query(spark, sf_dir).collect()), ["(no oracle)"], 0
                ts = time.time() - t0
        except Exception as error:  # report and go on
            notes, n, ts, td = [f"ERROR {str(error)[:1500]}"], -1, 0, 0
        bad += bool(notes) and notes != ["(no oracle)"]
        print(f"{'ok ' if not notes else '-- '} {name:24s} rows={n:<7d} spark={ts:6.2f}s oracle={td:6.2f}s {' | '.join(notes)}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
