"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from entlens.plans import all_queries
from entlens.session import build_session

HEADLINE = [
    "entity_overview", "b12_clean_classical", "c04_match_names", "c06_fuzzy_alias", "c18_context_job", "d05_valence_scores",
    "d13_preprocessed_pairs", "d14_encode_texts", "e01_word_tfidf", "e02_char_tfidf", "e05_scale_columns", "p01_grouped_folds",
    "a01_read_multiline_csv", "a04_record_count_and_a05_nulls", "h01_scores", "h04_auc_one_vs_rest", "h08_slice_scores",
    "i01_table_profile", "i11_describe_numeric", "i15_entities_per_text", "i17_distinctive_terms", "g04_knn_classifier",
    "e09_sparse_representation", "g02_linear_svm_one_vs_rest", "g09_cross_validation",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    wanted = os.environ.get("BENCH_QUERIES")
    seconds: dict[str, float] = {}
    for name in wanted.split(",") if wanted else HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
