"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Each result is written in
full to a sink that discards it, so that no column is pruned away. ``wide_features`` reads
the events once; ``wide_nine_scans`` builds the same table from nine feature tables, the
way the feature scripts are written, as the comparison.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import reduce

from pyspark.sql import DataFrame

from wardline.functions import items
from wardline.operators.features import feature_table
from wardline.plans.bindings import Ward
from wardline.plans.queries import QUERIES
from wardline.session import builder

HEADLINE = (
    "bp_dia_hourly", "item_hourly_mean", "wide_features", "hourly_grid", "fill_both",
    "labelled_matrix", "infection_pairs", "score_windows", "onset_by_subject", "onset_by_stay",
    "item_counts", "flag_counts", "code_range_counts", "cohort_overlap", "sequence_index",
    "sample_strata", "split_sequences", "graph_edges", "jaccard_all", "jaccard_top10",
    "random_walk", "pic_clusters", "seq_loglik", "viterbi_path", "posterior", "fit_multi", "baum_welch",
    "hmm_kmeans", "kmeans", "elastic_net", "parse_tuples",
)


def nine_scans(w: Ward) -> DataFrame:
    tables = [feature_table(w.chart, w.adults, ladder, name, d_items=w.d_items) for name, ladder in items.WIDE_FEATURES.items()]
    return reduce(lambda a, b: a.join(b, ["subject_id", "icustay_id", "charttime"], "full"), tables)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:]
    spark = (
        builder("bench").master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: QUERIES[name] for name in HEADLINE}
    runs["wide_nine_scans"] = nine_scans
    Ward(spark, folder).events.count()  # start the executor before the clock does

    seconds = {}
    for name, query in runs.items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        query(Ward(spark, folder)).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = sum(s for n, s in seconds.items() if n != "wide_nine_scans")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
