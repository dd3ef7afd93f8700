"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: tables (default /root/testdata/sf0.1); BENCH_CPUS: cores of the local session.
"""

from __future__ import annotations

import json
import os
import time

from foliant.plans.queries import QUERIES
from foliant.session import local_session

HEADLINE = (
    "src3_listing", "txt8_tokens", "txt11_modal_roles", "txt14_quantities", "txt15_parameters", "txt26_xrefs", "txt27_triage",
    "tree1_build", "tree10_nest_by_clause", "tree12_header_paths", "tree16_restamp", "agg1_running_headers", "agg4_coverage",
    "agg5_text_votes", "agg14_profile", "agg16_coverage", "agg20_kendall", "jn1_cross_reference", "win1_numbering", "win2_continuation",
)


def headline() -> dict:
    """The headline queries, and the training-data operators where they are installed."""
    found = {name: QUERIES[name] for name in HEADLINE}
    try:
        from foliant.llm.queries import queries
    except ImportError:
        return found
    return found | queries()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(cores=int(os.environ.get("BENCH_CPUS", "8")), memory="16g")
    run = lambda query: query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    run(QUERIES["txt27_triage"])  # start the session's machinery
    took = {}
    for name, query in headline().items():
        began = time.perf_counter()
        run(query)
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, wall time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
