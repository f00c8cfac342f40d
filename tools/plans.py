"""Write PLANS.md: the executed (AQE final) plan shape of every library query.

Usage: python tools/plans.py [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ticketlens.plans.registry import queries  # noqa: E402
from ticketlens.session import local_session  # noqa: E402

def final_part(text: str) -> str:
    return text.split("+- == Initial Plan ==")[0]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(cores=8)
    lines = [
        "# Physical plans",
        "",
        f"Generated by `python tools/plans.py {sf_dir}` after running each query once (AQE final plans).",
        "Counts are of the final plan's operators. The citation table is the stored, partitioned parquet table.",
        "",
        "| Query | Scans | Exchanges | WindowGroupLimit | Broadcast joins | Sort-merge joins |",
        "|---|---|---|---|---|---|",
    ]
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        df.collect()
        plan = final_part(df._jdf.queryExecution().executedPlan().toString())
        lines.append(
            f"| `{name}` | {plan.count('Scan parquet') + plan.count('Scan csv')} | {len(re.findall(r'Exchange', plan)) - plan.count('BroadcastExchange')} "
            f"| {plan.count('WindowGroupLimit')} | {plan.count('BroadcastHashJoin')} | {plan.count('SortMergeJoin')} |"
        )
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
