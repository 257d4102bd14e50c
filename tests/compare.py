"""Run queries against DuckDB on the same tables: ``python tests/compare.py DIR [name ...]``."""

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None:
        return ""
    if isinstance(value, float):
        return f"{value:.9g}"
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, con, run, sql, sf_dir):
    """Differences as text, or None when both sides have the same columns, types and rows."""
    df = run(spark, sf_dir)
    mine, my_columns = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.sql(sql)
    theirs, their_columns = rows_of(result.columns, result.fetchall())
    if my_columns != their_columns:
        return f"columns {my_columns} != {their_columns}"
    kinds = dict(zip(result.columns, [str(t) for t in result.types]))
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    for field in df.schema:
        if names.get(field.dataType.simpleString()) != kinds[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} != {kinds[field.name]}"
    if not mine:
        return "no rows"
    if mine != theirs:
        extra = sorted(set(mine) - set(theirs))[:3]
        missing = sorted(set(theirs) - set(mine))[:3]
        return f"{len(mine)} and {len(theirs)} rows of {my_columns}; only ours {extra}; only theirs {missing}"
    return None


def main(sf_dir, wanted):
    import __spark_entry__ as entry
    from gaugeline.session import local_session

    spark = local_session(8)
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            problem = compare(spark, con, run, oracles[name], sf_dir) if name in oracles else "no oracle"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        bad += problem is not None
        print(f"{time.time() - began:6.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{bad} of {len(wanted) or len(queries)} differ")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
