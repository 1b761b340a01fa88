"""Summarise the physical plan of every registered batch query.

Usage: python tools/plan_report.py [sf_dir] > docs/PLANS.md
For each query: exchanges (shuffles), join strategies, pushed filters, read
schemas and Python stages, taken from ``explain("formatted")`` (before AQE).
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")


def summarise(text: str) -> dict:
    ops = re.findall(r"^\(\d+\) (\w[\w ]*?)(?: \[codegen id : \d+\])?$", text, re.M)
    exch = re.findall(r"Arguments: (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)[^,]*", text)
    pushed = [p for p in re.findall(r"PushedFilters: \[(.*)\]", text) if p]
    schemas = re.findall(r"ReadSchema: (struct<.*>)", text)
    joins = [o for o in ops if "Join" in o]
    py = [o for o in ops if "Python" in o or "Pandas" in o or "ArrowEval" in o]
    return {"exchanges": exch, "joins": joins, "pushed": pushed, "schemas": schemas, "python": py,
            "broadcasts": sum(1 for o in ops if o.startswith("BroadcastExchange"))}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from quern.plans.registry import batch_queries
    from quern.session import get_session
    spark = get_session("local[8]", shuffle_partitions=16)
    print(f"# Physical plans of the registered batch queries\n\nGenerated by `tools/plan_report.py {sf}` "
          "from `explain(\"formatted\")` (initial plan; AQE may still coalesce partitions, "
          "turn a sort-merge join into a broadcast join under the runtime size threshold, "
          "or split skewed partitions).\n")
    print("| query | shuffles | joins | broadcasts | pushed filters | Python stages | scan columns |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in batch_queries().items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf).explain("formatted")
        s = summarise(buf.getvalue())
        cols = "; ".join(sorted({re.sub(r"struct<(.*)>", r"\1", x) for x in s["schemas"]}))
        cols = re.sub(r":[a-z_]+(<[^>]*>)?", "", cols)
        print(f"| `{name}` | {', '.join(s['exchanges']) or '–'} | {', '.join(s['joins']) or '–'} | "
              f"{s['broadcasts']} | {'; '.join(s['pushed']) or '–'} | {', '.join(s['python']) or '–'} | {cols} |")


if __name__ == "__main__":
    main()
