"""Write PLANS.md: the operator skeleton of each headline query's physical plan.

Usage: python tools/dump_plans.py [sf_dir]

Keeps exchanges, joins, aggregates, windows, Python stages, generators and
scans (with their read schema), so the shuffles and column pruning of every
plan can be reviewed without running it.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.plans import queries as Q  # noqa: E402
from quire.plans.session import get_session  # noqa: E402

KEEP = re.compile(r"Exchange|Join|Aggregate|Window|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|"
                  r"Generate|FileScan|Scan ExistingRDD|Sort ")
HEADLINE = ("paragraphs", "filter_corpus_screened", "aggregates", "chunks", "conversation_aggregates", "spans", "embed_chunks")


def skeleton(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: [^,]*, ", "", line)
        m = re.search(r"ReadSchema: (struct<[^>]*>)", line)
        if "FileScan" in line:
            head = line[: line.index("FileScan")] + "FileScan parquet"
            line = head + (f" ReadSchema {m.group(1)}" if m else "")
        out.append(line.rstrip()[:220])
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    parts = ["# Physical plans (skeleton)\n",
             f"Generated by `tools/dump_plans.py` at `{sf}` (local[8]; AQE may re-plan at run time).",
             "Planning steps run before the final plan (counts, quantiles, lineage cuts) are",
             "not shown: their tables appear here as parquet scans of the checkpoint folder.\n"]
    for name in HEADLINE:
        df = Q.QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        parts.append(f"## {name}\n\n```")
        parts.extend(skeleton(plan))
        parts.append("```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
