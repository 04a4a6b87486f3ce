"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the cores; BENCH_ALL=1 times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from labelloom.catalog.all import REGISTRY  # noqa: E402
from labelloom.session import build_session  # noqa: E402

HEADLINE = [
    "clean_text",
    "build_messages",
    "split_three_way",
    "prepare_conversations",
    "gen_texts",
    "gen_quota_shared_base",
    "enrich_translate",
    "retry_outcome",
    "llm_parse_delimited",
    "llm_quota_cap",
    "render_chat_train",
    "tokenize_pad",
    "tokenize_batch_longest",
    "train_classifier",
    "batch_predict",
    "normalize_predictions",
    "class_report",
    "confusion_matrix",
    "evaluation_summary",
    "log_regex_metrics",
    "progress_metrics",
    "stream_train_metrics",
    "global_shuffle",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(REGISTRY) if os.environ.get("BENCH_ALL") else HEADLINE
    REGISTRY["clean_text"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time" if names is HEADLINE else "all queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
