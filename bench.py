"""Headline timings: one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import base, compare  # noqa: E402
from seriesprep.layout import KEY  # noqa: E402
from seriesprep.operators import decompose, divergence, order, repair, screen, spectrum, stats, unitroot  # noqa: E402
from seriesprep.params import Params  # noqa: E402
from seriesprep.plans import pipeline, report  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
LOOSE = Params(seasonality_threshold=0.3, trend_threshold=0.0, shifting_threshold=0.6, transition_threshold=0.2)


def main():
    spark = compare.session(CPUS)
    scratch = base.scratch_dir(spark, "bench")
    points = pipeline.stage_points(base.weekly(spark, SF_DIR), scratch)
    long = {"longest": base.WEEKS}
    periods = lambda: spectrum.tested_periods(spectrum.candidate_periods(spectrum.spectrum(points, **long)))
    queries = {
        "build_points": lambda: base.weekly(spark, SF_DIR),
        "zero_flags": lambda: screen.zero_flags(points),
        "simple_bundle": lambda: stats.other_features(points, **long),
        "inversions": lambda: order.inversions(points, **long),
        "repair": lambda: repair.repair(points, **long),
        "divergence": lambda: divergence.series_divergence(points),
        "candidate_periods": periods,
        "strengths": lambda: decompose.strengths(points, periods()),
        "adf": lambda: unitroot.adf(points, **long),
        "profile_core": lambda: report.core_report(points, **long),
        "profile_core_hourly": lambda: report.core_report(base.hourly(spark, SF_DIR), longest=base.HOURS),
        "screen": lambda: pipeline.screen(points, report.core_report(points, **long)),
        "clean": lambda: pipeline.clean(points, LOOSE, **long),
        "profile_full": lambda: pipeline.profile(points, **long),
    }
    points.groupBy(*KEY).count().write.format("noop").mode("overwrite").save()
    timings = {}
    for name, build in queries.items():
        start = time.time()
        build().write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                # the same queries as in earlier rounds; all 29 feature groups are timed beside them
                "value": round(sum(t for name, t in timings.items() if name != "profile_full"), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
