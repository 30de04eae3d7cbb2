"""Command line: list the registered queries, show a query's plan, or run one.

    python -m echolens list
    python -m echolens explain lift_by_theme --data /root/testdata/sf0.01
    python -m echolens run lift_by_theme --data /root/testdata/sf0.01 [--out PATH --format csv|parquet]

Without ``--out`` the first rows are printed; with it the whole result is
written by the executors (nothing is collected to the driver).
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="echolens")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "explain"):
        s = sub.add_parser(name)
        s.add_argument("query")
        s.add_argument("--data", required=True, help="folder with the input tables (<name>.parquet)")
        s.add_argument("--master", default=None)
        if name == "run":
            s.add_argument("--out", default=None)
            s.add_argument("--format", default="parquet", choices=["parquet", "csv"])
            s.add_argument("--show", type=int, default=20)
    a = p.parse_args(argv)

    from .plans.catalog import ORACLES, QUERIES
    if a.cmd == "list":
        for name in sorted(QUERIES):
            doc = (QUERIES[name].__doc__ or "").strip().split("\n")[0]
            print(f"{name:28s} {'oracle' if name in ORACLES else 'rows  '}  {doc}")
        return 0
    if a.query not in QUERIES:
        print(f"unknown query {a.query!r}; see `python -m echolens list`", file=sys.stderr)
        return 2
    from .session import build_session
    spark = build_session(a.master)
    df = QUERIES[a.query](spark, a.data)
    if a.cmd == "explain":
        df.explain("formatted")
    elif a.out:
        w = df.write.mode("overwrite")
        (w.option("header", True).csv(a.out) if a.format == "csv" else w.parquet(a.out))
        print(f"wrote {a.query} to {a.out}")
    else:
        df.show(a.show, truncate=80)
    return 0


if __name__ == "__main__":
    sys.exit(main())
