"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from geosync import contract
from geosync.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "flagship_districts", "property_flatten", "infer_types", "parse_text_date", "purge_by_date", "wkt_parse", "geom_split",
    "line_to_polygon", "geodesic_area", "spatial_intersects", "area_keys", "best_cover_district", "area_numbering",
    "mirror_merge", "keyed_upsert", "match_upsert", "restore_links", "link_one_to_one", "latest_per_key", "link_audit",
    "free_number_alloc", "job_sync_layer_items", "job_sync_photo_items",
)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = contract.queries()
    spark.read.parquet(f"{FOLDER}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
