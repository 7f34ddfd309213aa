"""Compare registered queries with their SQL in DuckDB: ``python tests/checker.py <sf_dir> [name ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int", "double": "float", "float": "float", "string": "str",
    "boolean": "bool", "BIGINT": "int", "INTEGER": "int", "HUGEINT": "huge", "SMALLINT": "int", "DOUBLE": "float", "FLOAT": "float",
    "VARCHAR": "str", "BOOLEAN": "bool", "date": "date", "DATE": "date", "timestamp_ntz": "ts", "timestamp": "ts", "TIMESTAMP": "ts",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value) if value is not None else "\0null"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(row[i]) for i in order) for row in rows)


def compare(spark, con, name, query, sql, sf_dir):
    """(ok, message)."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    relation = con.sql(sql)
    want = relation.fetchall()
    if sorted(df.columns) != sorted(relation.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    mine = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    theirs = {n: KINDS.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    if mine != theirs:
        return False, f"types differ: { {n: (mine[n], theirs[n]) for n in mine if mine[n] != theirs[n]} }"
    a, b = rows_of(df.columns, got), rows_of(relation.columns, want)
    if a != b:
        in_a, in_b = set(a), set(b)
        only_a, only_b = [r for r in a if r not in in_b][:3], [r for r in b if r not in in_a][:3]
        return False, f"rows {len(a)} vs {len(b)}; columns {sorted(df.columns)}; spark only {only_a}; sql only {only_b}"
    return True, f"{len(a)} rows"


def main() -> None:
    import __spark_entry__ as entry
    from crawlweave.session import local_session

    sf_dir = sys.argv[1]
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                ok, message = compare(spark, con, name, queries[name], oracles[name], sf_dir)
            else:
                ok, message = True, f"{queries[name](spark, sf_dir).count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            ok, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {message}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main()
