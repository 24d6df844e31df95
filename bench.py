"""Headline queries at one scale; prints one JSON line.

Each query is drained into a sink that keeps nothing. Parses are shared between
queries of one session, as they are between the steps of a run, so the parse and
the edges have entries of their own, which come first.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from treeloom import schemas
from treeloom.operators import derive
from treeloom.operators.flatten import flatten
from treeloom.session import build_session
from treeloom.sources import eventlog
from workloads import catalog

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# One file of about 188 KB.
LARGE_FILE_PART = """def f_<n>(a, b=None):
    total = a
    for item in b or ():
        total = total + item.value * f_<n>(item.parts, None)
    return {"name": "f_<n>", "total": total}
"""
LARGE_FILE_PARTS = 1127

QUERIES = [
    "discovery_listing", "discovery_totals", "discovery_top_dirs", "discovery_largest",
    "ast_nodes", "cfg_edges", "dfg_edges", "file_metadata",
    "cfg_edges_branches", "dfg_edges_branches", "call_edges", "call_resolves",
    "file_metadata_texts", "parse_errors", "topic_counts", "vertices", "relationships",
    "vertex_merge", "relationship_merge", "type_histogram", "subtree_paths", "call_paths",
    "region_paths", "stream_documents", "stream_resume", "stream_vertices",
]


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": str(2 * int(CPUS)),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="treeloom-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the Python workers, which otherwise happens inside the first query.
    spark.range(1000).mapInArrow(lambda batches: batches, "id BIGINT").write.format("noop").mode(
        "overwrite"
    ).save()

    seconds: dict[str, float] = {}

    def timed(name, action):
        started = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - started, 3)
        return result

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    for name in ("ledger", "branches", "routines"):
        timed(f"parse_{name}", lambda: catalog.syntax(spark, SF_DIR, name))
        timed(f"edges_{name}", lambda: catalog.edges(spark, SF_DIR, name))
    emitted = {}
    for name in ("ledger", "branches"):
        nodes = derive.ast_nodes(catalog.syntax(spark, SF_DIR, name)).count()
        edges = catalog.edges(spark, SF_DIR, name).count()
        spent = seconds[f"parse_{name}"] + seconds[f"edges_{name}"]
        emitted[name] = {
            "nodes": nodes,
            "edges": edges,
            "derived_per_second": round((nodes + edges) / spent),
        }
    # The builds that later queries share have entries of their own, so those show themselves only.
    log = timed("build_log", lambda: catalog.routines_log(spark, SF_DIR))
    timed("build_graph", lambda: catalog.routines_graph(spark, SF_DIR))
    events = eventlog.read_all(spark, log).count()
    spent = sum(seconds[n] for n in ("parse_routines", "edges_routines", "build_log"))
    emitted["routines"] = {"events": events, "parsed_and_emitted_per_second": round(events / spent)}
    text = "".join(LARGE_FILE_PART.replace("<n>", str(n)) for n in range(LARGE_FILE_PARTS))
    large = spark.createDataFrame([("large.py", text.encode(), None)], schemas.SOURCE)
    timed("parse_large_file", lambda: drain(flatten(large)))
    emitted["large_file"] = {"bytes": len(text), "nodes": flatten(large).count()}
    registered = catalog.queries()
    for name in QUERIES:
        timed(name, lambda: drain(registered[name](spark, SF_DIR)))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "emitted": emitted,
            }
        )
    )


if __name__ == "__main__":
    main()
