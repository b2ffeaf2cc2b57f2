"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)

Every query fits its own features: nothing fitted for one is reused by another.
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from catalog import QUERIES, data  # noqa: E402
from compare import local_session  # noqa: E402
from nearlex.session import remove_stages  # noqa: E402

HEADLINE = (
    "t1_simple_tokens", "t12_raw_word_stream", "t14_char_grams", "a3_document_frequency",
    "a13_fitted_vocabulary", "w1_bm25_weights", "x1_chi2_scores", "x3_select_and_renormalise",
    "k3_dense_cosine", "k4_top_k", "r2_weighted_feedback", "e2_weighted_soft_vote",
    "v4_macro_f1", "v6_k_sweep", "v7_bm25_grid", "m3_scores",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    data.table(spark, folder, "documents").count()
    wanted = sys.argv[1:] or HEADLINE
    took = {}
    for name in wanted:
        data.forget()
        remove_stages(spark)
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": pathlib.Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
