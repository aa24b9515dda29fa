"""Write PLANS.md: the key lines of ``explain("formatted")`` for chosen
metrics (scans with pushed filters and read schemas, joins, exchanges,
windows, aggregates) at $PLANS_SF_DIR (default sf0.1).

    python explain_plans.py [name ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from metricforge.plans import QUERIES  # noqa: E402
from metricforge.session import build_session  # noqa: E402

DEFAULT = ["dau_purchase", "monthly_avg_check", "ltv_nested_top5", "retention_daily", "item_popularity",
           "activity_by_group", "amount_stats", "dup_rows", "rollup_country_conf", "completeness_years_bucketed",
           "dashboard_selected", "trim_p99"]
KEEP = re.compile(r"^\(\d+\) (Scan|.*Join|Exchange|Window|HashAggregate|TakeOrderedAndProject|Generate|Filter)"
                  r"|PushedFilters|ReadSchema|Join type|Join condition|Arguments: (hashpartitioning|rangepartitioning|SinglePartition)")


def key_lines(txt: str) -> list[str]:
    body = txt.split("\n\n", 1)[-1]
    out = []
    for line in body.splitlines():
        if KEEP.search(line.strip()):
            out.append(line.rstrip())
    return out


def main() -> None:
    sf = os.environ.get("PLANS_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or DEFAULT
    spark = build_session(cpus=8, app="metricforge-plans")
    parts = ["# Physical plans (key lines)\n",
             f"Generated by `explain_plans.py` at `{sf}` on `local[8]` (initial AQE plans; AQE may turn a",
             "sort-merge join into a broadcast join at runtime once it has measured the side).\n"]
    for name in names:
        df = QUERIES[name](spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        doc = " ".join(line.strip() for line in (QUERIES[name].__doc__ or "").strip().splitlines())
        parts.append(f"## {name}\n\n{doc}\n\n```\n" + "\n".join(key_lines(buf.getvalue())) + "\n```\n")
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
