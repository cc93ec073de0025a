"""Write docs/queries.md: every registered query with its output columns and types.

Usage: python scripts/describe_queries.py [sf_dir] [out.md]
"""

import inspect
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillsight.plans.catalog import STAR_QUERIES, run_on  # noqa: E402
from tillsight.session import local_session  # noqa: E402
from tillsight.sources.model import Star  # noqa: E402


def _operator_doc(fn) -> str:
    """First line of the docstring of the operator the query calls."""
    src = inspect.getsource(fn)
    for mod_name in ("affinity", "customers", "dashboard", "funnel", "prep", "quality",
                     "retention", "revenue", "rolling", "segments"):
        marker = f"{mod_name}."
        if marker in src:
            name = src.split(marker, 1)[1].split("(", 1)[0]
            mod = __import__(f"tillsight.operators.{mod_name}", fromlist=[name])
            doc = (getattr(mod, name).__doc__ or "").strip().splitlines()
            return " ".join(line.strip() for line in doc[:2]) if doc else ""
    return ""


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    out = sys.argv[2] if len(sys.argv) > 2 else "docs/queries.md"
    spark = local_session(shuffle_partitions=4)
    star = Star(spark, sf_dir)
    parts = ["# Registered queries and their outputs\n\n",
             "Generated by `scripts/describe_queries.py`. Run any of them with\n",
             "`python -m tillsight run NAME --data DIR` or `plans.catalog.run_on(star, NAME)`.\n"]
    for name, fn in STAR_QUERIES.items():
        schema = run_on(star, name).schema
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts.append(f"\n## {name}\n\n{_operator_doc(fn)}\n\nColumns: {cols}\n")
    with open(out, "w") as f:
        f.write("".join(parts))
    print(out)
