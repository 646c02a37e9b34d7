"""Run registered queries next to their SQL and compare rows. Usage: python -m tests.compare [sf] [name prefix ...]"""

import math
import sys
import time

import duckdb

from loanfold.bindings import REGISTRY
from loanfold.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def kind(type_name: str) -> str:
    """A name both engines share for a column type."""
    t = type_name.lower()
    if t.startswith("decimal"):
        return "decimal"
    return {"string": "text", "varchar": "text", "bigint": "int64", "long": "int64", "int": "int32", "integer": "int32",
            "timestamp_ntz": "timestamp", "float": "float"}.get(t, t)


def canonical(rows, order) -> list[str]:
    def show(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(0.0 if v == 0 else v)
        return repr(v)

    return sorted("|".join(show(row[i]) for i in order) for row in rows)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when the query and its SQL agree, else what differs."""
    run, oracle = REGISTRY[name]
    df = run(spark, sf_dir)
    rows = df.collect()
    result = con.execute(oracle)
    columns = [c[0] for c in result.description]
    kinds = {c[0]: kind(str(c[1])) for c in result.description}
    expected = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}"
    wrong = [(f.name, kind(f.dataType.simpleString()), kinds[f.name]) for f in df.schema.fields
             if kind(f.dataType.simpleString()) != kinds[f.name]]
    if wrong:
        return f"types {wrong}"
    if len(rows) != len(expected):
        return f"rows {len(rows)} != {len(expected)}"
    names = sorted(columns)
    mine = canonical(rows, [df.columns.index(c) for c in names])
    theirs = canonical(expected, [columns.index(c) for c in names])
    if mine != theirs:
        odd = next((a, b) for a, b in zip(mine, theirs) if a != b)
        cells = [f"{n}: {x} | {y}" for n, x, y in zip(names, odd[0].split("|"), odd[1].split("|")) if x != y]
        return f"{sum(a != b for a, b in zip(mine, theirs))} of {len(mine)} rows differ, first {cells[:6]} in {odd[0][:200]}"
    return None


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), connect(sf_dir)
    failed = 0
    for name in REGISTRY:
        if not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            if REGISTRY[name].oracle is None:
                problem, note = None, f"{REGISTRY[name].run(spark, sf_dir).count()} rows, no SQL"
            else:
                problem, note = difference(spark, con, name, sf_dir), "same"
        except Exception as error:  # report every query, whatever one of them raises
            problem, note = f"{type(error).__name__}: {str(error)[:700]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or note}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
