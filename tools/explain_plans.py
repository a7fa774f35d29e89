"""Write the formatted physical plans of the key queries to docs/PLANS.md.

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEY = {
    "count_filtered": "filter and column pruning reach the parquet scan",
    "page_listing_stats": "flagship: native regex over HTML, partial + final aggregation by host",
    "normalise_listing": "typed listing: staged projections, one codegen stage, no Python",
    "new_links": "dedup (map-side) then anti join with the store",
    "upsert_latest": "latest-per-key with max_by (no per-key window), store anti join + union",
    "progress_by_source": "two aggregates; per-source side left to AQE's size-checked broadcast",
    "rule_dispatch": "rule table broadcast; one Python node (mapInPandas) for the parse",
    "enrich_batches": "skew-safe batch numbering read from a reliable checkpoint",
    "response_merge": "reply values normalised on the reply side across the latest-reply aggregation",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from listingflow.session import get_spark
    from listingflow.plans.catalog import QUERIES
    spark = get_spark("local[8]", 8)
    out = ["# Physical plans of key queries", "",
           f"Generated by `tools/explain_plans.py` on `{sf_dir}` with `explain(\"formatted\")` "
           "(plans before adaptive re-planning; AQE may coalesce partitions or switch joins at run time).", ""]
    for name, why in KEY.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n(1)")[0]
        details = [ln for ln in text.splitlines()
                   if ln.startswith(("PushedFilters", "ReadSchema", "Arguments: [plan_id", "Join type"))]
        out += [f"## {name}", "", why + ".", "", "```", tree.strip(), "", *details[:12], "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
