"""Times headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

HEADLINE = ("p08_cell_waterfall", "a05_ambient_score", "w01_control_percentiles", "a09_escaper_stats", "p31_gene_triage", "a12_mean_shift", "j03_zero_shot", "n02_log1p", "n03_scale_clip", "a16_metacell_mean", "n19_knn_delta", "n04_hvg")


def main() -> None:
    from pyspark.sql import SparkSession

    from screenspark.plans.catalog import QUERIES

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            began = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        times[name] = round(median(runs[1:]), 3)
    print(json.dumps({"metric": "warm seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
