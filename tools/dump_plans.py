"""Write the physical plans of the headline queries to docs/PLANS.md.

usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quincena.plans.catalog import QUERIES  # noqa: E402
from quincena.session import build_session  # noqa: E402

NOTES = {
    "snapshot_latest": "One bronze scan; three joins with written dimensions, broadcast when their "
                       "bytes are below the threshold; the version bound reaches the scan as pushed filters "
                       "(partition filters when bronze is partitioned by version).",
    "scd2_history": "Partial (map-side) aggregate de-duplicates events before the first exchange; one "
                    "more exchange on the six keys serves all windows and the version collapse.",
    "inactive_employees": "Anti join with the snapshot's distinct keys; AQE broadcasts them when their "
                          "measured bytes are below the threshold.",
    "gold_position": "Two-level aggregation (partial before each exchange) for the distinct id count.",
    "gold_employee": "Spark's Expand rewrite of three distinct counts with partial aggregation at both "
                     "levels; the position list is an object-hash aggregate.",
    "report_clean": "Header and banner rows are written first; data rows join one-row-a-sheet and "
                    "one-row-a-report tables; a second scan makes the failures, one flag a row.",
    "pending_reports": "Request plan by an equi-join on hashed groups of statuses, then one anti join against the up-to-date polls.",
    "page_options": "Single scan reading only page_id and html; regex extraction and explode per page.",
}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = re.sub(r"/tmp/checkpoints/[^,\]\s]*", "<checkpoint>/...", buf.getvalue())
    text = re.sub(r"#\d+L?", "", text)
    return "\n".join(line[:220] for line in text.splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(shuffle_partitions=16)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/dump_plans.py` on `{sf_dir}` (local[8], AQE on; plans before "
           "adaptive re-optimisation). Expression ids and scratch paths are elided.", ""]
    for name, note in NOTES.items():
        out += [f"## {name}", "", note, "", "```", plan_text(QUERIES[name](spark, sf_dir)), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
