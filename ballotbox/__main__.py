"""Run a registered query: ``python -m ballotbox <query> [--sf-dir DIR] [--out PATH] [--format parquet]``.

Without ``--out`` the first rows are shown; ``--list`` prints the queries.
"""

from __future__ import annotations

import argparse

from ballotbox.plans.registry import load_all
from ballotbox.session import get_spark


def main() -> None:
    ap = argparse.ArgumentParser(prog="python -m ballotbox")
    ap.add_argument("query", nargs="?")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    ap.add_argument("--master")
    ap.add_argument("--list", action="store_true")
    args = ap.parse_args()
    registry = load_all()
    if args.list or not args.query:
        for name, q in sorted(registry.items()):
            print(f"{q.operator:5} {name}")
        return
    spark = get_spark(args.master)
    df = registry[args.query].fn(spark, args.sf_dir)
    if args.out:
        writer = df.write.mode("overwrite")
        if args.format == "csv":
            writer = writer.option("header", "true")
        writer.format(args.format).save(args.out)
        print(f"wrote {args.query} to {args.out}")
    else:
        df.show(20, truncate=60)


if __name__ == "__main__":
    main()
