"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. ``queries`` holds first-run seconds in a warmed
JVM; ``BENCH_WARM=1`` adds a second run as ``warm``. Every query is run to the end into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import time

import pyspark

from heightgrid.catalog import load
from heightgrid.catalog.registry import QUERIES
from heightgrid.session import build_session

HEADLINE = [
    "height_by_stratum", "d1_p95_grid", "d2_statistic_grid", "d7_describe", "d12_cv_scores", "d14_band_correlation", "d19_mosaic",
    "d20_pyramid", "d21_zone_labels", "c1_tiles_sites", "c1_water_sites", "c3_overlay_tiles_blocks", "c4_points_in_polygons",
    "c5_tiles_minus_water", "c6_zonal_cover", "c8_join_embeddings", "c10_sample_bands", "c11_clip_raster", "i1_stratified_points",
    "i4_random_points", "i6_resample", "j7_tile_cleanup", "j9_ground_filter", "j10_height_above_ground", "j11_dilate", "b18_clamp_predictions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    load()
    spark = build_session("bench", cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", cpus)))
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run("b11_open_height_filter")
    first: dict[str, float] = {}
    warm: dict[str, float] = {}
    for name in HEADLINE:
        for seconds in (first, warm)[: 2 if os.environ.get("BENCH_WARM") else 1]:
            start = time.perf_counter()
            run(name)
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_first_run_seconds", "value": round(sum(first.values()), 3), "unit": "sec", "queries": first, "warm": warm,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cores": int(cpus), "spark": pyspark.__version__,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
