"""Headline timings: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores; prints one JSON line.

Every phase starts from stage tables of the phase before it, so its time covers
that phase only; ``build_total`` is the sum.  Nothing is cached between phases
other than those tables.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kerbline.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    # one machine: its own folder is the shared one
    spark = local_session(cpus, shuffle_partitions=cpus, checkpoint_dir=Path(tempfile.mkdtemp(prefix="spark-bench-")).as_uri())

    from queries import all_queries
    from queries.registry import City
    queries = all_queries()
    c = City.of(spark, sf_dir)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before the clock

    times: dict[str, float] = {}

    def clock(name: str, fn) -> None:
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)

    def run(name: str):
        def go() -> None:
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return go

    clock("load", lambda: (c.nodes, c.edges, c.lines, c.facility_lines, c.crossings, c.calming, c.elev))
    clock("foundation", lambda: c.straight)
    clock("split_foundation", lambda: c.split)
    clock("facilities", lambda: (c.facs, c.placed, c.offset_rows, c.late, c.facilities))
    clock("junctions", lambda: (c.sidewalks, c.arms, c.ramp_points, c.ramps, c.zones, c.hull_arms, c.slots))
    clock("crosswalks", lambda: c.crosswalks)
    for name in ("slopes", "join_calming_vertex", "neighbours", "snap_endpoints", "gov_match_ramp", "gov_nearest_road", "nearby_segments",
                 "snap_to_segment", "viewport_features", "undo_compact", "edit_attr"):
        clock(name, run(name))
    clock("build_network", run("build_network"))

    n_edges = c.edges.count()
    print(json.dumps({
        "metric": "network build and queries, total seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "edges": n_edges,
        "build_edges_per_sec": round(n_edges / times["build_network"], 1)}))


if __name__ == "__main__":
    main()
