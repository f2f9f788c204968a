"""User entry points (P1-P4) and sinks (SNK1-SNK3)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrange import Part, arrange, co_located
from ..layout import BLOCK_LEN, KEY, attach, cut_lineage, split_blocks, to_blocks
from ..operators import channels, screen as screening, stats
from ..operators.repair import repair
from ..params import Params
from . import features as library
from .report import core_report, rejects, short_report

CONCURRENT_GROUPS = 4


def _only(points: DataFrame, keep: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """Points of the series in ``keep`` (KEY, n); joined per block, so no key is hot."""
    rows = attach(split_blocks(points, block_len=block_len), keep.select(*KEY, "n"), block_len)
    return rows.select(*KEY, "t", "v")


def stage_points(points: DataFrame, path: str) -> DataFrame:
    """Write points once and read them back: features scan the source many times, so a
    source that is itself a costly query should be staged in shared storage first."""
    points.select(*KEY, "t", "v").write.mode("overwrite").parquet(path)
    return points.sparkSession.read.parquet(path)


def complete_series(points: DataFrame) -> DataFrame:
    """Points of the series without missing observations; the others are in ``rejects``."""
    if points.filter(F.col("v").isNull()).isEmpty():
        return points
    sizes = points.groupBy(*KEY).agg(F.count("*").alias("n"), F.count("v").alias("present"))
    return _only(points, sizes.filter("present = n"))


def profile(
    points: DataFrame,
    features: list[str] | None = None,
    params: Params = Params(),
    longest: int | None = None,
) -> DataFrame:
    """P2/MATH14/REP1: one row of features per complete series and channel.

    ``features`` names columns or groups of ``plans.features``; only the groups
    that own a requested column are computed.  ``None`` asks for everything.
    The points are arranged once and every group reads that arrangement; the groups with a one-row
    form share one pass over series of at most a block.  Each is one job whose result, one row per
    series, is stored before the join; the final join only meets those small tables.
    """
    report = None
    with co_located(points.sparkSession):
        for part in arrange(points, longest):
            rows = _profiled(part, features, params)
            report = rows if report is None else report.unionByName(rows)
    if features is None:
        return report
    wanted = library.columns_of(features)
    return report.select(*[c for c in report.columns if c in KEY or c in wanted or c in library.CORE])


def _profiled(part: Part, features: list[str] | None, params: Params) -> DataFrame:
    report = core_report(part.points, params, longest=part.longest, placed=part.placed)
    parts = library.computed(part.points, features, part.longest, part.placed)
    if parts:
        # independent jobs, a few at a time, so that the tail of one does not idle the cluster
        with ThreadPoolExecutor(CONCURRENT_GROUPS) as pool:
            report, *parts = pool.map(cut_lineage, [report, *parts])
    for columns in parts:
        report = report.join(columns, KEY, "left")
    return report


def screen(points: DataFrame, report: DataFrame, params: Params = Params()) -> DataFrame:
    """Verdict per series from a stored or fresh report and the raw points."""
    table = report if "Trend" in report.columns else short_report(report)
    return screening.with_verdict(table, screening.zero_flags(points, params), params)


def survivors(points: DataFrame, verdict: DataFrame) -> DataFrame:
    """Raw points of the kept series."""
    sizes = points.groupBy(*KEY).agg(F.count("*").alias("n"))
    kept = cut_lineage(verdict.filter("keep").select(*KEY))
    return _only(points, sizes.join(kept, KEY, "left_semi"))


def clean(points: DataFrame, params: Params = Params(), longest: int | None = None) -> DataFrame:
    """Profile, screen and repair; points of the survivors with ``v`` repaired.

    The zero check is an AND with the screen, so it runs first and only live
    series are profiled.
    """
    with co_located(points.sparkSession):
        cleaned = [_cleaned(part, params) for part in arrange(points, longest)]
    return reduce(DataFrame.unionByName, cleaned)


def _cleaned(part: Part, params: Params) -> DataFrame:
    points = part.points
    zeros = screening.zero_flags(points, params)
    sizes = points.groupBy(*KEY).agg(F.count("*").alias("n"))
    live = _only(points, sizes.join(zeros.filter("NOT zero_or_constant").select(*KEY), KEY, "left_semi"))
    # the report is written once: the screen and repair read it, the profile must not run again
    report = cut_lineage(short_report(core_report(live, params, longest=part.longest, placed=part.placed)))
    kept = report.filter(screening.passes_quality(params)).select(*KEY)
    alive = _only(points, sizes.join(kept, KEY, "left_semi"))
    return repair(alive, params, longest=part.longest).select(*KEY, "t", F.col("repaired").alias("v"))


def profile_groups(points: DataFrame, params: Params = Params(), longest: int | None = None) -> DataFrame:
    """One row per series set with more than one channel: feature means and correlation.

    The score sees the signed outlier timing, the mean row its absolute value.
    """
    report = profile(points, None, params, longest)
    return group_means(report)


def group_means(report: DataFrame) -> DataFrame:
    """AGG9 and AGG10 on a full report, multi-channel sets only."""
    score = channels.correlation_score(report)
    absolute = report.withColumn("DN_OutlierInclude_p_001_mdrmd", F.abs("DN_OutlierInclude_p_001_mdrmd"))
    many = report.groupBy("series_id").agg(F.count("*").alias("_channels")).filter("_channels > 1")
    return (
        stats.mean_rows(absolute)
        .join(score, "series_id", "left")
        .join(many.select("series_id"), "series_id", "left_semi")
    )


def write_report(report: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """SNK1: the full table and the eight-column table, side by side."""
    for name, table in (("all", report), ("short", short_report(report))):
        writer = table.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{name}")


def write_group_report(means: DataFrame, path: str) -> None:
    """SNK2: mean rows of multi-channel sets, full and eight columns."""
    means.write.mode("overwrite").parquet(f"{path}/mean_all")
    short_report(means).write.mode("overwrite").parquet(f"{path}/mean_short")


def cleaned_blocks(cleaned: DataFrame, block_len: int = BLOCK_LEN) -> DataFrame:
    """SNK3 layout: one row per survivor with its values; a series longer than a
    block takes one row per block, so no row is unbounded."""
    return to_blocks(cleaned, block_len=block_len)


def write_cleaned(cleaned: DataFrame, path: str) -> None:
    """SNK3: an empty result writes an empty table."""
    cleaned_blocks(cleaned).write.mode("overwrite").parquet(path)
