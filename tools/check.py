"""Compare every registered query with its SQL: python tools/check.py FOLDER [names]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ladewerk.plans.oracle_queries import ORACLES  # noqa: E402
from ladewerk.plans.queries import QUERIES  # noqa: E402
from ladewerk.session import local_session  # noqa: E402


def _cell(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(_cell(r[k]) for k in order) for r in rows)


def main(folder: str, names: list[str]) -> int:
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    spark = local_session()
    bad = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, folder)
            columns, rows = normal(df.columns, [tuple(r) for r in df.collect()])
        except Exception as exc:
            print(f"FAIL {name}: {str(exc)[:1500]}", flush=True)
            bad += 1
            continue
        spent = time.time() - started
        if name not in ORACLES:
            print(f"rows {name}: {len(rows)} ({spent:.1f}s)", flush=True)
            continue
        try:
            result = con.execute(ORACLES[name])
            want_columns, want = normal([d[0] for d in result.description], result.fetchall())
        except Exception as exc:
            print(f"FAIL {name} (sql): {str(exc)[:1500]}", flush=True)
            bad += 1
            continue
        if (columns, rows) == (want_columns, want):
            print(f"ok   {name}: {len(rows)} ({spent:.1f}s)", flush=True)
            continue
        bad += 1
        print(f"DIFF {name}: {len(rows)} / {len(want)} rows, {columns} / {want_columns}")
        have, need = set(rows), set(want)
        print("   only here:", sorted(have - need)[:3])
        print("   only sql: ", sorted(need - have)[:3], flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
