"""Write the final (post-AQE) physical plan of every registered query.

Usage: python scripts/snapshot_plans.py [sf_dir] [out.md]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillsight.plans.catalog import QUERIES  # noqa: E402
from tillsight.session import local_session  # noqa: E402


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    text = df._jdf.queryExecution().executedPlan().toString()
    if "== Initial Plan ==" in text:
        text = text.split("== Initial Plan ==")[0].rstrip(" +-\n")
    return "\n".join(line[:200] for line in text.splitlines())


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "docs/plans.md"
    spark = local_session(shuffle_partitions=16)
    parts = [f"# Final physical plans at {sf_dir} (local[*], 16 shuffle partitions, AQE on)\n",
             "Generated by `scripts/snapshot_plans.py`; `*(n)` marks whole-stage codegen.\n"]
    for name, fn in QUERIES.items():
        parts.append(f"\n## {name}\n\n```\n{final_plan(fn(spark, sf_dir))}\n```\n")
    os.makedirs(os.path.dirname(out) or ".", exist_ok=True)
    with open(out, "w") as f:
        f.write("".join(parts))
    print(out)
