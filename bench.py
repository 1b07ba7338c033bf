"""Timings of the headline queries. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data, BENCH_CPUS the local cores,
BENCH_QUERIES an optional comma list of query names.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexweave.plans import registry, views  # noqa: E402
from lexweave.session import local_session  # noqa: E402

HEADLINE = [
    "scan_corpus",
    "normalize_text",
    "pretokenize",
    "word_histogram",
    "pair_counts",
    "bpe_merges",
    "encode_corpus",
    "encode_bytes",
    "token_offsets",
    "contiguous_split",
    "lm_windows",
    "eval_windows",
    "eval_window_tokens",
    "batch_score_uniform",
    "score_corpus",
    "encode_instruction",
    "instruction_stats",
    "fit_few_shot",
    "continuation_scores",
    "mmlu_predictions",
    "batch_generate",
    "stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    queries = registry.queries()
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    times = {}
    start = time.perf_counter()
    views.story_stream(spark, sf_dir)  # the token table later queries read
    times["token_table"] = round(time.perf_counter() - start, 3)
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall clock",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
