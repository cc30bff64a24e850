"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from sievemark.plans import catalog, q_files, q_groups, q_relations, q_scalars, q_tracks  # noqa: F401
from sievemark.session import local_session

HEADLINE = ["residues_to_epitopes", "assign_ids", "dedup_epitopes", "validate_record", "kmer_exact_join", "screen_autoimmunity", "sweep", "evaluate_rule", "conservancy_agg", "combine_screens", "join_final", "attrition", "final_rank"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in HEADLINE:
        began = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
