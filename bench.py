"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from opinia.plans import catalog

HEADLINE = [
    "doc_length_box",
    "tokens_clean",
    "top_words_by_class",
    "frequent_itemsets",
    "ngram_counts",
    "tfidf_weights",
    "chi2_top_terms",
    "mnb_predict",
    "cnb_predict",
    "cv_f1_weighted",
    "stemmed_vocab",
    "scored_export",
    "linear_svm_predict",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    # Start-up of JVM and Python workers is not what is measured.
    catalog.queries()["class_counts"](spark, folder).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        catalog.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf")}))


if __name__ == "__main__":
    main()
