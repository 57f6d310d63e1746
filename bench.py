"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and once for the record, into the `noop` sink, so every row and column is produced.
The `_450k` entries run over the events repeated to at least the row count of one published full load. The `csv_` and
`stored_` entries time the product itself: raw CSV files through the pipeline into the stored table, and counts and
features from that table.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks.queries import QUERIES  # noqa: E402
from hexwatch.operators import aggregates, features  # noqa: E402
from hexwatch.plans import incident, testview  # noqa: E402
from hexwatch.session import build_session, shared_dir  # noqa: E402
from hexwatch.settings import RAW_KEY  # noqa: E402
from hexwatch.sources.bronze import ROW_POS, SOURCE_FILE  # noqa: E402
from hexwatch.sources.gold import scan_gold, write_gold  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FULL_LOAD_ROWS = 450_000
HEADLINES = [
    "a1_counts_by_cell_hour", "a6_type_distribution", "a9_daily_counts", "a15_stage_funnel", "h1_hexagon_cell",
    "j6_score_requests", "l2_l3_l4_fold", "m1_features_dense", "m1_features_sparse", "m4_curve_areas",
    "p11_silver_schema", "p12_gold_schema", "s6_write_gold", "v2_v3_validate_raw", "v5_verify_gold", "w1_dedup_first",
]


def repeated_events(spark, sf_dir: str, rows: int):
    events = testview.table(spark, sf_dir, "events")
    n = events.count()
    copies = max(1, math.ceil(rows / max(n, 1)))
    k = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    shifted = events.select("*", k.alias("k"))
    return shifted.withColumn("event_id", F.col("event_id") + F.col("k") * n).drop("k"), n * copies


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    events, full_rows = repeated_events(spark, SF_DIR, FULL_LOAD_ROWS)
    raw = testview.raw_from(events, testview.table(spark, SF_DIR, "nation"))
    silver = incident.silver(raw)
    gold = incident.gold(silver)
    landing, loaded = shared_dir(spark, "bench-raw"), []
    files = raw.withColumn(RAW_KEY, F.concat_ws("-", RAW_KEY, F.col(ROW_POS).cast("string"))).drop(SOURCE_FILE, ROW_POS)
    files.repartition(8).write.option("header", "true").option("escape", '"').csv(landing)

    def load():
        loaded.append(shared_dir(spark, "bench-gold"))
        write_gold(incident.pipeline(spark, landing), loaded[-1])
        return scan_gold(spark, loaded[-1]).limit(0)

    runs = {name: (lambda q=QUERIES[name]: q(spark, SF_DIR)) for name in HEADLINES}
    runs |= {
        "silver_450k": lambda: silver,
        "gold_450k": lambda: gold,
        "cell_hours_450k": lambda: aggregates.counts_by_cell_hour(gold),
        "features_450k": lambda: features.build_features(gold),
        "csv_to_stored_450k": load,
        "stored_cell_hours_450k": lambda: aggregates.counts_by_cell_hour(scan_gold(spark, loaded[-1])),
        "stored_features_450k": lambda: features.build_features(scan_gold(spark, loaded[-1])),
    }
    seconds = {}
    for name, make in runs.items():
        for _ in range(2):
            start = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "rows_450k": full_rows, "gold_rows_per_sec": round(full_rows / seconds["gold_450k"]),
    }))


if __name__ == "__main__":
    main()
