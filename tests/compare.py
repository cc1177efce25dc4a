"""Run the registered queries against DuckDB: ``python tests/compare.py [folder] [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402


def open_oracle(folder: str):
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(v)) for v in r))


def differences(con, sql: str, df) -> list[str]:
    """What differs between a Spark result and the SQL's: nothing, if they agree."""
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    wanted = _sorted(found.fetchall(), names)
    got = _sorted([tuple(r) for r in df.collect()], df.columns)
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(got) != len(wanted):
        problems.append(f"{len(got)} rows, expected {len(wanted)}")
    only_spark, only_sql = set(got) - set(wanted), set(wanted) - set(got)
    if only_spark or only_sql or got != wanted:
        problems.append(f"{len(only_spark)} rows only in spark, {len(only_sql)} only in sql")
        problems += [f"  spark {r}" for r in sorted(only_spark, key=str)[:3]]
        problems += [f"  sql   {r}" for r in sorted(only_sql, key=str)[:3]]
        if got and wanted and not problems[1:]:
            problems.append(f"  {got[0]} / {wanted[0]}")
        types = {type(a) for r in got for a in r} ^ {type(a) for r in wanted for a in r}
        if types:
            problems.append(f"  types on one side only: {types}")
    return problems


def main() -> int:
    import __spark_entry__ as entry
    from mercata.session import build_session, clear_scratch

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "compare",
        f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = open_oracle(folder), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        if name not in sql:
            print(f"-- {name}: {query(spark, folder).count()} rows, no SQL, {time.time() - start:.1f}s", flush=True)
            continue
        try:
            problems = differences(con, sql[name], query(spark, folder))
        except Exception as error:  # keep going: one report for all queries
            problems = [f"{type(error).__name__}: {str(error)[:800]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - start:.1f}s", flush=True)
        for p in problems:
            print("   ", p)
    print(f"{bad} of {len(sql)} differ")
    clear_scratch(spark)
    return bad


if __name__ == "__main__":
    sys.exit(main())
