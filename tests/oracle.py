"""Run registered queries on Spark and their SQL on DuckDB, and compare whole results.

``python -m tests.oracle [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
_TYPES = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "string": {"VARCHAR"}, "boolean": {"BOOLEAN"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(df, con, sql: str) -> str | None:
    """None when columns, types and the multiset of rows agree; otherwise what differs."""
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if set(described) != set(types):
        return f"columns differ: spark {sorted(types)}, sql {sorted(described)}"
    wrong = {c: (types[c], described[c]) for c in types if described[c] not in _TYPES.get(types[c], set())}
    if wrong:
        return f"types differ: {wrong}"
    names = sorted(types)
    ours = Counter(tuple(r) for r in df.select(*names).collect())
    listed = ", ".join(f'"{n}"' for n in names)
    theirs = Counter(con.execute(f"SELECT {listed} FROM ({sql})").fetchall())
    if ours == theirs:
        return None
    extra, lacking = ours - theirs, theirs - ours
    return (
        f"rows differ: spark {sum(ours.values())}, sql {sum(theirs.values())}; {names}; "
        f"only spark {list(extra)[:2]}, only sql {list(lacking)[:2]}"
    )


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracles:
                result = compare(df, con, oracles[name])
                note = f"{df.count()} rows" if result is None else result
            else:
                result, note = None, f"{df.count()} rows, no sql"
        except Exception as error:  # noqa: BLE001
            result = note = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += result is not None
        print(f"{'ok  ' if result is None else 'FAIL'} {name}: {note} [{time.time() - started:.1f}s]", flush=True)
    print(f"failures: {bad}")


if __name__ == "__main__":
    main()
