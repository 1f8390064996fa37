"""Summarise the executed (final AQE) plans of the headline queries into PLANS.md.

    python tools/plan_report.py [/root/testdata/sf0.1]

For each query: counts of scans, shuffles, broadcast / sort-merge joins,
reused exchanges and aggregates, and every distinct scan with its pushed
filters and read columns.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from shelfcost.operators import sales, transfers  # noqa: E402
from shelfcost.plans.monthly import tidy_rows  # noqa: E402
from shelfcost.plans.registry import QUERIES, WINDOW  # noqa: E402
from shelfcost.sources import from_star  # noqa: E402
from shelfcost.session import build_session  # noqa: E402

NODES = ("Scan parquet", "Exchange", "BroadcastExchange", "ReusedExchange", "SortMergeJoin", "BroadcastHashJoin",
         "ShuffledHashJoin", "HashAggregate", "Scan ExistingRDD", "InMemoryTableScan", "Generate")


def summarise(name: str, df) -> list[str]:
    df.collect()  # execute, so the adaptive plan is final
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    counts = {n: len(re.findall(r"\(\d+\) " + re.escape(n) + r"\b", text)) for n in NODES}
    out = [f"## {name}", "", "| node | count |", "| --- | --- |"]
    out += [f"| {n} | {c} |" for n, c in counts.items() if c]
    scans = set()
    for block in re.split(r"\n\(\d+\) ", text):
        if block.startswith("Scan parquet"):
            loc = re.search(r"Location: \w+ \[([^\]]+)\]", block)
            pushed = re.search(r"PushedFilters: \[(.*)\]", block)
            schema = re.search(r"ReadSchema: struct<(.*)>", block)
            part = re.search(r"PartitionFilters: \[(.*)\]", block)
            scans.add((os.path.basename(loc.group(1)) if loc else "?",
                       (pushed.group(1) if pushed else "")[:300],
                       (part.group(1) if part else "")[:200],
                       ", ".join(c.split(":")[0] for c in (schema.group(1).split(",") if schema else []))))
    out += ["", "| table | pushed filters | partition filters | columns read |", "| --- | --- | --- | --- |"]
    out += [f"| {t} | {p or '—'} | {pf or '—'} | {c} |" for t, p, pf, c in sorted(scans)]
    return out + [""]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    lines = ["# Executed plans of the headline queries", "",
             f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8], AQE on). Counts are nodes of the",
             "final adaptive plan of the returned DataFrame (materialised inputs such as the checkpointed",
             "tidy table appear as `Scan ExistingRDD`; their own jobs ran before).", ""]
    for name in HEADLINE:
        lines += summarise(name, QUERIES[name](spark, sf_dir))
    # the job behind the rollup's checkpoint: all branches
    src = from_star(spark, sf_dir)
    tidy = tidy_rows(sales.sales_tidy(src, WINDOW), transfers.xfers_tidy(src, WINDOW))
    lines += summarise("rollup — materialised tidy table (the checkpointed job)", tidy)
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines))


if __name__ == "__main__":
    main()
