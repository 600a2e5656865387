"""Side-by-side run of registered queries and their SQL counterparts."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    return type(value).__name__


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, con, sf_dir, query, sql) -> str | None:
    start = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    middle = time.time()
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    want = res.fetchall()
    print(f"  spark {middle - start:.1f}s sql {time.time() - middle:.1f}s", end=" ")
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    for x, y in zip(a, b):
        if x != y:
            return f"values {x} != {y}"
        if [kind(v) for v in x] != [kind(v) for v in y]:
            return f"types {x} != {y}"
    if not a:
        return "no rows"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from lexivane.session import get_spark

    spark, con = get_spark(cpus=8), connect(sf_dir)
    oracle, bad = oracle_sql(), 0
    chosen = [n for n in queries() if not names or any(n.startswith(p) for p in names)]
    for name in chosen:
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, sf_dir, queries()[name], oracle[name])
            else:
                problem = None if queries()[name](spark, sf_dir).count() else "no rows"
        except Exception as failure:
            problem = f"{type(failure).__name__}: {str(failure)[:700]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.1f}s {'' if name in oracle else '(rows only)'} {problem or ''}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} fine")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
