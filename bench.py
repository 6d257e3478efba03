"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_QUERIES
a choice of queries. Every query runs to its last row into a sink that drops
them, twice: the value is the total of the second runs, "cold" has the first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.all_queries import QUERIES  # noqa: E402
from fieldstar.session import get_session  # noqa: E402

HEADLINES = """
slice_targets slice_json checklist_count slice_top100 species_list missing_names audit_species audit_totals
bbox_extract_strict quality_gate effort_events json_key_join lookup_composite flag_members backfill_scalar
collapse_attempts first_per_key dup_mask factorize assign_ids check_constraints melt_counts star_places star_events
star_counts json_pack json_merge date_formats time_wrap geohash7 html_rows quote_repair record_assembly bad_width
dataset_volumes replace_dataset stream_first_seen
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    wanted = os.environ.get("BENCH_QUERIES", "").split() or [q for q in HEADLINES if q in QUERIES]
    spark = get_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds, cold = {}, {}
    for name in wanted:
        for times in (cold, seconds):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries, second run",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
