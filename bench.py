"""Time the headline queries: one JSON line with seconds per query.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores, BENCH_ONLY some queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from prepkit.registry import all_queries  # noqa: E402

HEADLINE = (
    "table_kpis", "top_missing_columns", "describe_numeric", "describe_text", "top_values",
    "stat_mean_grouped", "stat_median_grouped", "stat_mode_grouped", "stat_nunique_grouped",
    "stat_skew_grouped", "stat_kurtosis",
    "bin_equal_width", "bin_equal_freq", "onehot_many", "impute_median", "impute_most_frequent",
    "kbest_f_classif", "kbest_f_regression", "kbest_mi_classif", "correlation_filter", "rf_importance",
    "sample_random", "sample_stratified", "sample_balanced", "sample_clustered",
    "split_random", "split_stratified", "split_time",
    "metrics_classification", "metrics_auc", "metrics_auc_ovr",
    "train_linear", "train_rf_classifier", "train_gbt_regressor", "train_logistic", "train_svm",
    "describe_percentiles", "kbest_mi_regression", "kbest_mi_knn",
    "transcript_last_n", "suppress_repeats", "csv_round_trip",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("prepkit-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    names = os.environ.get("BENCH_ONLY", "").split() or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        known[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("stat_mean_grouped")  # start the JVM's compiler and the file cache
    seconds = {name: round(run(name), 3) for name in names}
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
