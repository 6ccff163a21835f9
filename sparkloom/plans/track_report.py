"""The nine analyses of a track table, from CSV to written results.

The CSV is parsed once and written as Parquet, so that quality counts and
cleaning see the same rows. The cleaned rows are written as well, and every
analysis reads only the columns it needs from there.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cohort, collab, consistency, outlier, profile, quality, sweetspot, topk
from ..sources import reports
from ..sources.tables import (
    TRACK_PROBE_KEYS,
    TRACK_REQUIRED,
    TRACK_UNIT_FEATURES,
    read_tracks,
)

Parts = dict[str, DataFrame]

GENRE, SCORE, ARTISTS = "track_genre", "popularity", "artists"


def distribution(tracks: DataFrame) -> Parts:
    return {
        "columns": profile.profile_counts(tracks),
        "numeric": profile.profile_numeric(tracks),
        "top_values": profile.profile_top_values(tracks),
        "boolean": profile.profile_boolean(tracks),
    }


def collaborations(tracks: DataFrame) -> Parts:
    roles = dict(members=ARTISTS, score=SCORE)
    return {
        "top_groups": collab.boost(tracks, **roles),
        "summary": collab.summary(tracks, **roles),
    }


def breakthroughs(tracks: DataFrame) -> Parts:
    features = ["energy", "danceability", "valence"]
    hits = outlier.items_vs_group(
        tracks, by="album_name", score=SCORE, keep=["track_name", ARTISTS, *features]
    )
    tie = [name for name in hits.columns if name != SCORE]
    gap = outlier.feature_gap(tracks, by="album_name", score=SCORE, features=features)
    return {
        "top_items": topk.top_k(hits, [F.desc(SCORE)], 20, tie),
        "count": hits.agg(F.count(F.lit(1)).alias("breakthrough_count")),
        "features": gap,
    }


def tempo_sweet_spot(tracks: DataFrame) -> Parts:
    roles = dict(by=GENRE, score=SCORE, x="tempo")
    best = sweetspot.best_bucket(tracks, **roles)
    return {
        "ranges": sweetspot.bucket_stats(tracks, **roles),
        "best": best,
        "summary": sweetspot.summary(best),
    }


def explicit_content(tracks: DataFrame) -> Parts:
    impact = cohort.flag_impact(tracks, by=GENRE, flag="explicit", score=SCORE)
    return {
        "genres": impact,
        "counts": cohort.flag_impact_counts(impact),
        "top": cohort.flag_impact_top(impact, by=GENRE),
    }


def long_danceable(tracks: DataFrame) -> Parts:
    roles = dict(
        by=GENRE,
        score=SCORE,
        rank_by="duration_ms",
        feature="danceability",
        keep=["track_name", ARTISTS],
    )
    return {
        "top": topk.top_vs_group(tracks, **roles),
        "summary": topk.top_vs_all(tracks, **roles),
    }


def explicit_valence(tracks: DataFrame) -> Parts:
    buckets = cohort.flag_by_bucket(tracks, score=SCORE, flag="explicit", value="valence")
    return {"ranges": buckets, "pattern": cohort.dominant_pattern(buckets)}


def artist_consistency(tracks: DataFrame) -> Parts:
    artists = consistency.diversity(tracks, entity=ARTISTS, score=SCORE, category=GENRE)
    return {"artists": artists, "summary": consistency.diversity_summary(artists)}


def acoustic_vs_vocal(tracks: DataFrame) -> Parts:
    groups = cohort.two_cohorts(
        tracks, by=GENRE, features=["acousticness", "instrumentalness"], score=SCORE
    )
    return {"genres": groups, "summary": cohort.two_cohorts_summary(groups)}


# The analyses in report order.
ANALYSES: Mapping[str, tuple[str, Callable[[DataFrame], Parts]]] = {
    "01_distribution": ("Statistics of every column", distribution),
    "02_collaborations": ("Most frequent collaborations", collaborations),
    "03_breakthroughs": ("Hits on weak albums", breakthroughs),
    "04_tempo_ranges": ("Best tempo range of the top genres", tempo_sweet_spot),
    "05_explicit_by_genre": ("Explicit content by genre", explicit_content),
    "06_long_danceable": ("Longest danceable tracks", long_danceable),
    "07_explicit_valence": ("Explicit content and valence", explicit_valence),
    "08_artist_spread": ("Steadiest artists and their genres", artist_consistency),
    "09_acoustic_vocal": ("Acoustic against vocal genres", acoustic_vs_vocal),
}


def analyze(tracks: DataFrame) -> dict[str, Parts]:
    """All analyses of a clean track table, as lazy frames by name."""
    return {name: run(tracks) for name, (_, run) in ANALYSES.items()}


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write as Parquet and return the written copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run(
    spark: SparkSession,
    csv_path: str,
    out_dir: str,
    extra: Mapping[str, Callable[[DataFrame], Parts]] | None = None,
    rfc4180: bool = True,
) -> DataFrame:
    """Load, probe, clean, analyse and write; returns the run times per analysis.

    ``extra`` adds analyses of one's own: functions from the clean table to
    named frames. Results go to ``out_dir/<analysis>/<part>`` and the run times
    to ``out_dir/run_metrics``. An analysis that fails ends the run.
    """
    began = time.perf_counter()
    raw = stored(read_tracks(spark, csv_path, rfc4180=rfc4180), f"{out_dir}/parsed_tracks")
    ranges = quality.unit_ranges(TRACK_UNIT_FEATURES)
    cleaning = {
        "probe": quality.probe(raw, TRACK_PROBE_KEYS, ranges),
        "report": quality.clean_report(raw, TRACK_REQUIRED, ranges),
    }
    reports.write_result(out_dir, "00_cleaning", "Data quality", cleaning)
    clean = quality.clean(raw, TRACK_REQUIRED, ranges)
    tracks = stored(clean, f"{out_dir}/clean_tracks")

    jobs = {name: (text, build) for name, (text, build) in ANALYSES.items()}
    jobs.update({name: (name, build) for name, build in (extra or {}).items()})
    timings = []
    for name, (text, build) in jobs.items():
        started = time.perf_counter()
        reports.write_result(out_dir, name, text, build(tracks))
        timings.append((name, 1000 * (time.perf_counter() - started)))
    metrics = reports.run_metrics(spark, timings, 1000 * (time.perf_counter() - began))
    metrics.write.mode("overwrite").json(f"{out_dir}/run_metrics")
    return metrics
