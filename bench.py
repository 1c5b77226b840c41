"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric": "total_sec", "value": N, "unit": "sec",
"queries": {name: sec}, "sf": ...}.  Every query is forced to completion
with the ``noop`` sink (all rows computed, nothing collected).  An untimed
first pass over a smaller scale (sf0.01 when present) compiles the
generated code and warms the JVM, so the timed pass measures steady-state
execution, as on a long-running cluster.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pactline.operators import segments  # noqa: E402
from pactline.operators.lines import split_lines  # noqa: E402
from pactline.plans import catalog  # noqa: E402
from pactline.session import get_session  # noqa: E402
from pactline.sources.contracts import contracts  # noqa: E402
from pactline.sources.tables import documents  # noqa: E402

HEADLINE = [
    "tag_positions",             # C8 on contracts
    "tag_summary",               # F9 on contracts (flagship)
    "tag_summary_documents",     # F9 on documents
    "parse_raw_text_documents",  # C11 on documents
    "build_tree",                # C12 on contracts
    "tfidf",                     # J2 on documents
    "naive_bayes",               # J7 on documents
    "kmeans_sweep",              # J6, all 21 k from 25 to 45
]


def run(spark, name: str, sf: str) -> float:
    t = time.time()
    catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    segments.release()
    return round(time.time() - t, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", conf={"spark.ui.showConsoleProgress": "false",
                                               "spark.sql.shuffle.partitions": str(max(8, int(cpus)))})
    warm = next((os.path.join(os.path.dirname(sf), w) for w in ("sf0.01", "sf0.001")
                 if os.path.isdir(os.path.join(os.path.dirname(sf), w))
                 and os.path.join(os.path.dirname(sf), w) != sf), None)
    if warm:
        for n in names:
            run(spark, n, warm)
    times = {n: run(spark, n, sf) for n in names}
    # Input sizes for a throughput view (counted after the timed pass).
    n_lines = {"contracts": contracts(spark, sf).count(),
               "documents": split_lines(documents(spark, sf)).count()}
    rate = {f"{n}_lines_per_sec": round(n_lines[src] / times[n]) for n, src in
            (("tag_positions", "contracts"), ("tag_summary", "contracts"), ("build_tree", "contracts"),
             ("tag_summary_documents", "documents"), ("parse_raw_text_documents", "documents"))
            if n in times and times[n] > 0}
    m = re.search(r"sf([0-9.]+)$", sf)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf,
                      "input_lines": n_lines, "throughput": rate}))
    spark.stop()


if __name__ == "__main__":
    main()
