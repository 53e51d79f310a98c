"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ballotbox.plans.registry import load_all  # noqa: E402
from ballotbox.session import get_spark  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 16)
    registry = load_all()
    for name in args:
        print(f"===== {name}")
        registry[name].fn(spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
