"""Summarise the final (adaptive) physical plan of every catalog query.

Usage: python -m tests.plan_summary [sf_dir] > docs/PLANS.md

Each query is run once (collect), then its executed plan is reduced to the
operators that matter for scale: exchanges, aggregates, joins, windows,
generators, Python nodes and scans with their pushed filters and read schema.
"""

from __future__ import annotations

import re
import sys

KEEP = ("Exchange", "Aggregate", "Join", "Window", "Generate", "MapInPandas", "TakeOrdered",
        "Scan", "Limit", "Union", "Expand", "Sort ")


def summarise(plan: str) -> list[str]:
    out = []
    for line in plan.split("\n"):
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "", line)
        line = re.sub(r"file:[^ ,\]]*/", "", line)
        if "FileScan" in line:
            scan = re.search(r"FileScan parquet \[[^\]]*\]", line)
            pushed = re.search(r"PushedFilters: \[[^\]]*\]", line)
            schema = re.search(r"ReadSchema: \S+", line)
            indent = line[: len(line) - len(line.lstrip(" :+-"))]
            line = indent + " ".join(x.group(0) for x in (scan, pushed, schema) if x)
        elif len(line) > 220:
            line = line[:217] + "..."
        out.append(line)
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from hearth.session import local_session
    spark = local_session(8)
    print(f"# Final physical plans at {sf_dir.rstrip('/').rsplit('/', 1)[-1]} (local[8], AQE on)\n")
    print("Generated by `python -m tests.plan_summary`; operators that matter for scale only.\n")
    for name, fn in E.queries().items():
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]
        print(f"## {name}\n\n```")
        print("\n".join(summarise(plan)))
        print("```\n")


if __name__ == "__main__":
    main(sys.argv)
