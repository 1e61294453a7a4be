"""Run the queries and their checking SQL side by side: python -m workload.check [sf] [names...]"""

from __future__ import annotations

import math
import sys
import time


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def norm(v):
        if isinstance(v, bool) or v is None:
            return v
        if isinstance(v, float):
            return None if math.isnan(v) else float(f"{v:.9g}")
        if isinstance(v, int):
            return float(v)
        return str(v)

    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def _kind(type_name: str) -> str:
    """Coarse type, to notice results that only look equal."""
    name = str(type_name).lower()
    for kind, words in {"array": ("[]", "array", "list"), "bool": ("bool",), "wide": ("hugeint", "decimal"), "float": ("double", "float"),
                        "int": ("int", "long"), "time": ("timestamp", "date"), "text": ("char", "string")}.items():
        if any(w in name for w in words):
            return kind
    return name


def compare(spark, connection, sf_dir: str, fn, sql: str | None) -> tuple[bool | None, int, float, str]:
    start = time.time()
    df = fn(spark, sf_dir)
    names = df.columns
    ours = rows_of(names, [tuple(r) for r in df.collect()])
    took = time.time() - start
    if sql is None:
        return None, len(ours), took, ""
    result = connection.execute(sql)
    other = [d[0] for d in result.description]
    theirs = rows_of(other, result.fetchall())
    if sorted(names) != sorted(other):
        return False, len(ours), took, f"columns {sorted(names)} / {sorted(other)}"
    kinds = {f.name: _kind(f.dataType.simpleString()) for f in df.schema.fields}
    off = [f"{d[0]}: {kinds[d[0]]} / {d[1]}" for d in result.description if _kind(d[1]) != kinds[d[0]]]
    if off:
        return False, len(ours), took, f"types {off}"
    if ours != theirs:
        a, b = [r for r in ours if r not in set(theirs)][:2], [r for r in theirs if r not in set(ours)][:2]
        return False, len(ours), took, f"{len(ours)} / {len(theirs)} rows\n   spark {a}\n   sql   {b}"
    return True, len(ours), took, ""


def main() -> int:
    import duckdb

    from mdcatalog.session import build_session

    from . import star
    from . import queries_files, queries_more  # noqa: F401  (register their queries)
    from .queries import ORACLES, QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                                               "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb.connect()
    for t in star.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name in wanted:
        try:
            ok, n, took, why = compare(spark, connection, sf_dir, QUERIES[name], ORACLES.get(name))
        except Exception as error:
            ok, n, took, why = False, -1, 0.0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += ok is False
        print(f"{'ok  ' if ok else 'rows' if ok is None else 'FAIL'} {name:28} {n:8} rows {took:6.2f} s {why}", flush=True)
    print(f"{bad} failed of {len(wanted)}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
